"""Operators for preparing training data.

Nothing else in the library imports this package.  Its functions travel to the
executors by value, so workers need numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
