"""Benchmark: time every registered query on one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is evaluated in full through the ``noop`` sink (no collect to
the driver).  Prints one JSON line: total seconds and seconds per query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marketsignals.plans import QUERIES, load_all  # noqa: E402
from marketsignals.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus * 2)
    load_all()
    # warm-up (JIT, Python workers) outside the measurement
    QUERIES["usage_summary"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
