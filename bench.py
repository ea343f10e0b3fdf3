"""Headline queries, timed: one JSON line with the median seconds of each.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 1 timed run after one warm-up; the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "speed_trend_share",
    "hauling_silver",
    "asof_backward",
    "asof_forward",
    "trip_reconciliation",
    "production_timeseries",
    "stock_balance",
    "counter_delta",
    "drop_repeats",
    "plant_output",
    "robust_z",
    "latest_per_key",
    "top_per_group",
    "merge_newer",
    "vehicle_summary_daily",
    "truck_pairs",
    "spacing_windows_gps",
    "pair_similarity",
    "table_overlap",
    "kpi_snapshot",
    "price_quantiles",
    "stream_spacing",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tonflow-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        # Call sites of Columns are only needed for error messages; collecting them costs
        # several calls into the JVM for every expression built.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from verification.cases import QUERIES

    names = [a for a in sys.argv[1:]] or HEADLINE
    seconds = {}
    for name in names:
        timed = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            # Writes every row and column nowhere, so the whole result is computed.
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            timed.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(timed[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(folder)),
                "cpus": int(cpus),
                "shuffle_partitions": int(cpus),
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
