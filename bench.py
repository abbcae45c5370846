"""Times the registered queries on ``$BENCH_SF_DIR`` and prints one JSON line.

Each query runs to the end into Spark's ``noop`` sink, which computes every
column of every row. The first query after the warm-up pays no JIT cost; each
figure is the better of two runs, planning and eager steps included.
"""

from __future__ import annotations

import json
import os
import sys
import time

from registered.queries import QUERIES
from tallyshelf.session import get_spark

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def seconds(spark, query) -> float:
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main(names: list[str]) -> None:
    spark = get_spark(
        "bench",
        CPUS,
        conf={
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.showConsoleProgress": "false",
        },
    )
    seconds(spark, QUERIES["genre_stats"])
    timings = {
        name: round(min(seconds(spark, QUERIES[name]) for _ in range(RUNS)), 3) for name in names
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:] or list(QUERIES))
