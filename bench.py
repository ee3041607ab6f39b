"""Time every registered query and print one JSON line.

Each query is planned and executed into a sink that discards rows: once to warm the
JVM up, then ``BENCH_RUNS`` timed runs, of which the fastest counts. ``value`` is the
sum over all queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from spanfeat.plans import QUERIES
from spanfeat.session import build_session


def run(fn, spark, folder: str) -> float:
    began = time.perf_counter()
    fn(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or list(QUERIES)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        run(QUERIES[name], spark, folder)
        times[name] = round(min(run(QUERIES[name], spark, folder) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds_all_queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
