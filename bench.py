"""Wall times of all queries; prints one JSON line.

BENCH_SF_DIR: folder of the tables, BENCH_CPUS: local cores, BENCH_RUNS: timed runs per query after
a first one (the median counts), BENCH_QUERIES: names, comma separated.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from wayfare.plans.queries import QUERIES
from wayfare.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
CHOSEN = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name]


def run(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "bench",
        master=f"local[{CPUS}]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    first: dict[str, float] = {}
    times: dict[str, float] = {}
    for name in CHOSEN or QUERIES:
        first[name] = round(run(spark, name), 3)
        times[name] = round(statistics.median(run(spark, name) for _ in range(RUNS)), 3)
        print(f"{name:28s} first {first[name]:8.3f} then {times[name]:8.3f}", file=sys.stderr)
    result = {
        "metric": "total_wall_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "first_run": first,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
        "spark": spark.version,
        "runs": RUNS,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
