"""Time the headline queries and print one JSON line.

Each query is built and run to the end (rows are dropped by a no-op sink). The first
run of a query compiles its code and is not counted; the second is.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wayfact.plans.registry import registered  # noqa: E402

HEADLINES = (
    "condition_summary",
    "borough_condition_summary",
    "hourly_demand",
    "zone_condition_summary",
    "monthly_condition_summary",
    "seasonal_condition_summary",
    "monthly_borough_summary",
    "monthly_tipping_summary",
    "joined_trips",
    "condition_summary_daily",
    "daily_demand",
    "report_hourly",
    "report_top_zones",
    "check_consistency",
    "label_high_demand",
    "best_record_per_hour",
    "fill_neighbors",
    "clean_trips_hourly",
    "revenue_by_method",
    "iqr_outliers",
    "word_count",
    "event_log_metrics",
)


def main() -> None:
    with tempfile.TemporaryDirectory(prefix="bench-") as shared:
        run(shared)


def run(shared: str) -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.checkpoint.dir", shared)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()
    seconds = {}
    for name in HEADLINES:
        for _ in range(2):
            started = time.perf_counter()
            queries[name](spark, directory).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": directory.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
