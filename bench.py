"""Wall time of the registered queries; prints one JSON line.

BENCH_SF_DIR names the test data, BENCH_CPUS the local cores, BENCH_QUERIES (comma-separated) limits
the run to some queries.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.catalog import QUERIES  # noqa: E402
from millrace.session import RECOMMENDED  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(QUERIES)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("millrace-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "20g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    )
    for name, value in RECOMMENDED.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # Start-up of the session and of the code generator is not any query's own time.
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_suppkey").count().write.format(
        "noop"
    ).mode("overwrite").save()
    times: dict[str, float] = {}
    for name in chosen:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
    }))


if __name__ == "__main__":
    main()
