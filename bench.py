"""Seconds per headline query; prints one JSON line.

Every query runs once to warm up and is then timed over BENCH_RUNS runs, of which
the fastest counts. Results are computed in full and discarded, not collected.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from checks.queries import all_queries

HEADLINE = [
    "bronze_payments",
    "bronze_user_events",
    "bronze_system_logs",
    "silver_payments",
    "silver_user_events",
    "silver_system_logs",
    "dq_payments",
    "dq_user_events",
    "dq_system_logs",
    "gold_payments_hourly",
    "gold_user_events_hourly",
    "gold_system_logs_hourly",
    "payments_baseline",
    "payments_flagged_hours",
    "layers_flagged_hours",
    "payments_top_failure_hours",
    "system_logs_top_error_hours",
    "report_total_events",
    "report_failures_by_merchant",
    "report_volume_by_currency",
    "report_status_breakdown",
    "unified_timeline",
    "unified_log_timeline",
    "entity_sequence",
    "encode_roundtrip_payments",
    "layers_roundtrip_payments",
    "stream_bronze_payments",
    "stream_bronze_payments_resume",
    "payments_versus_last_week",
    "payments_by_currency_versus_last_week",
    "payments_by_currency_flagged_hours",
    "payments_daily",
    "user_events_weekly",
    "system_logs_daily",
    "payments_flagged_hours_with_history",
    "payments_stored_flagged_hours",
    "payments_percentile_thresholds",
    "service_escalations",
    "user_funnel",
    "abandoned_carts",
    "incident_hours",
    "user_key_load",
    "merchant_dated_keys",
    "payments_half_minutes",
    "retained_payments",
    "retained_system_logs",
    "orders_quality",
    "customer_order_spikes",
    "part_refund_spikes",
    "refund_rates_by_brand",
    "refunds_of_open_orders",
    "customers_without_good_order",
]


def seconds(query, spark: SparkSession, sf_dir: str) -> float:
    started = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()
    timings = {}
    for name in HEADLINE:
        query = registered[name]
        seconds(query, spark, sf_dir)
        timings[name] = round(min(seconds(query, spark, sf_dir) for _ in range(runs)), 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
