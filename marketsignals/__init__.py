"""Market-signal analytics on Spark.

Tables of press announcements, web pages, model responses, stored price
signals and token usage, processed with DataFrame / SQL operators.
"""

__version__ = "0.1.0"
