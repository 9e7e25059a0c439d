"""Seconds per registered query on local[$BENCH_CPUS] at $BENCH_SF_DIR; one JSON line on stdout."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from leadloom.plans import runs  # noqa: E402, F401 - registers the queries over whole runs
from leadloom.plans.queries import QUERIES  # noqa: E402
from leadloom.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    only = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else list(QUERIES)
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "leadloom-bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads
    seconds = {}
    for name in only:
        start = time.perf_counter()
        # full execution of every output column, without moving the rows to Python
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name:28s} {seconds[name]:8.2f}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
