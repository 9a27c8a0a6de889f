"""Times the headline queries on local cores and prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the timed runs per query
(median reported, after one untimed run).  A run includes deriving and writing the samples.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from workload.queries import QUERIES

HEADLINE = (
    "snapshot_sequence",
    "counter_rate",
    "perf_snap",
    "wait_interval",
    "wait_share_report",
    "io_interval",
    "io_summary_all",
    "throughput_pivot",
    "summary_ratio",
    "performance_report",
    "config_change_log",
    "table_usage",
    "capacity_message",
    "stream_counter_delta",
    "stream_report_window",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED_DIR", tempfile.mkdtemp(prefix="bench-")))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        timed = []
        for attempt in range(runs + 1):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if attempt:
                timed.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(timed), 3)
        print(name, seconds[name], file=sys.stderr)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
