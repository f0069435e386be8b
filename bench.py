"""Time the queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query runs once untimed, then ``BENCH_RUNS`` times; the fastest run counts. Results go
to Spark's no-op sink, so every row is computed and none is collected. Pages (``d_*``) read a cube
that the untimed run stores; ``d_cube_*`` time its making.
"""

from __future__ import annotations

import json
import os
import time

from linkloom.checks.registry import QUERIES
from linkloom.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

# These write files, so they are timed once and have no untimed run.
WRITES = {name for name in QUERIES if name.startswith(("job_", "s_"))}


def seconds(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session("bench", local_cores=CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in QUERIES:
        if name not in WRITES:
            seconds(spark, name)
        runs = 1 if name in WRITES else RUNS
        timings[name] = round(min(seconds(spark, name) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
