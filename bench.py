"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line.

Every query is built from the raw tables and fully materialised through the noop sink: one warm-up at the same
scale, then $BENCH_RUNS timed runs (default 1), of which the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from checks.catalog import run
from peernet.config import clear_shared_dir

HEADLINE = [
    "fact_transaction",
    "dim_peers",
    "sessionize",
    "fact_peer_session",
    "fact_mempool",
    "preconfirmation_join",
    "hour_slices",
    "hourly_performance",
    "peer_performance",
    "fact_hash",
    "session_unique_hash",
    "undersampled",
]


def timed(name: str, spark: SparkSession, sf_dir: str) -> float:
    start = time.perf_counter()
    run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_RUNS", "1"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        # Call-site capture costs a round trip per column expression and only serves error messages.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        timed(name, spark, sf_dir)
        seconds[name] = round(statistics.median(timed(name, spark, sf_dir) for _ in range(repeats)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    clear_shared_dir(spark)
    spark.stop()


if __name__ == "__main__":
    main()
