"""Times every query; prints one JSON line.

Results are forced through a ``noop`` write. All queries run once, which gives
the ``first`` times, and then several times more; each time is the median of
these warm runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tallybrook.plans.catalog import QUERIES
from tallybrook.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def _timed(spark, query) -> float:
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "tallybrook-bench",
        f"local[{CPUS}]",
        extra={
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or list(QUERIES)
    passes = [
        {name: _timed(spark, QUERIES[name]) for name in chosen} for _ in range(RUNS + 1)
    ]
    first = {name: round(seconds, 3) for name, seconds in passes[0].items()}
    warm = {
        name: round(statistics.median(run[name] for run in passes[1:] or passes), 3)
        for name in chosen
    }
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    version = spark.version
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median warm query seconds",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "first": first,
                "sf": SF_DIR.rsplit("sf", 1)[-1].strip("/"),
                "runs": RUNS,
                "cpus": CPUS,
                "rows": {"events": events, "lineitem": lines},
                "stream_rows_per_second": {
                    name: round(events / seconds)
                    for name, seconds in warm.items()
                    if name.startswith("stream_")
                },
                "spark": version,
            }
        )
    )


if __name__ == "__main__":
    main()
