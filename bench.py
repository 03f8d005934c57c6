"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores. Each query
runs once to warm up and is then timed writing all its rows to the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import catalog  # noqa: E402
from riskwatch.session import build_session  # noqa: E402

HEADLINE = (
    "fea1", "fea2", "fea3", "fea4", "fea5", "fea6", "fea7", "fea9", "fea10", "fea11", "fea12", "fea13",
    "pip1", "pip2", "pip3", "pip4", "pip5", "pip6", "pip7", "pip8", "pip9",
)


def run(spark, key: str, sf_dir: str) -> float:
    start = time.perf_counter()
    catalog.QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for key in HEADLINE:
        run(spark, key, sf_dir)
        times[key] = round(run(spark, key, sf_dir), 3)
    print(json.dumps({
        "metric": "total_seconds_headline_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").split("sf")[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
