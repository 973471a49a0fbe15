"""Every registered query: a function of (session, folder of test tables)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import TimestampType

from checks import shop
from checks.mapping import bronze_rows, with_bad_records
from tidemark.functions.rounding import round2
from tidemark.operators import report
from tidemark.operators.baseline import (
    baseline,
    flagged_hours_in_one_pass,
    percentile_baseline,
    worst_first,
)
from tidemark.operators.cleaning import clean
from tidemark.operators.envelope import LOG_DATE, decode, encode, log_records
from tidemark.operators.hourly import highest, hourly
from tidemark.operators.incidents import incidents
from tidemark.operators.journeys import abandoned_carts, expired_carts, funnel, journeys
from tidemark.operators.keys import dated_key, key_load, load_of_volumes
from tidemark.operators.patterns import escalations
from tidemark.operators.quality import quality
from tidemark.operators.retention import retained
from tidemark.operators.sequence import CHUNK_OFFSETS, entity_sequence
from tidemark.operators.timeline import payment_trace, timeline, timeline_of_log
from tidemark.operators.trends import coarser, versus_last_week
from tidemark.plans.incremental import IncrementalSilver
from tidemark.plans.layers import EVENT_DATE, Lakehouse
from tidemark.plans.streams import HOUR, PAYMENTS, STREAMS, SYSTEM_LOGS, USER_EVENTS, StreamSpec
from tidemark.session import scratch_path
from tidemark.sources.tables import read_table, replace_table
from tidemark.sources.topics import append_log_files, stream_log_files
from tidemark.streaming.ingest import start_bronze
from tidemark.streaming.watch import ingested_quality, noting_steps, start_key_counts
from tidemark.streaming.windows import windowed

Query = Callable[[SparkSession, str], DataFrame]


def zoneless(rows: DataFrame) -> DataFrame:
    """Timestamps as wall-clock values, the type that the test tables use."""
    columns = [
        F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, TimestampType)
        else F.col(f.name)
        for f in rows.schema
    ]
    return rows.select(*columns)


def rows_of(spark: SparkSession, sf_dir: str, spec: StreamSpec) -> DataFrame:
    return bronze_rows(spark, sf_dir, spec.name)


def log_of(spark: SparkSession, sf_dir: str, spec: StreamSpec) -> DataFrame:
    return with_bad_records(log_records(rows_of(spark, sf_dir, spec), spec), spec.name)


def bronze(spark: SparkSession, sf_dir: str, spec: StreamSpec) -> DataFrame:
    return zoneless(decode(log_of(spark, sf_dir, spec), spec))


def silver(spark: SparkSession, sf_dir: str, spec: StreamSpec) -> DataFrame:
    return zoneless(clean(rows_of(spark, sf_dir, spec), spec))


def step_quality(spark: SparkSession, sf_dir: str, spec: StreamSpec) -> DataFrame:
    return quality(rows_of(spark, sf_dir, spec), spec)


def gold_of(spark: SparkSession, sf_dir: str, spec: StreamSpec) -> DataFrame:
    return hourly(clean(rows_of(spark, sf_dir, spec), spec), spec)


def comparable(gold: DataFrame) -> DataFrame:
    """Gold for comparison: its one unrounded sum is brought to two decimals."""
    if "completed_volume" in gold.columns:
        gold = gold.withColumn("completed_volume", F.expr(round2("completed_volume")))
    return zoneless(gold)


def gold(spark: SparkSession, sf_dir: str, spec: StreamSpec) -> DataFrame:
    return comparable(gold_of(spark, sf_dir, spec))


def payments_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baseline(gold_of(spark, sf_dir, PAYMENTS), PAYMENTS)


def payments_flagged_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = gold_of(spark, sf_dir, PAYMENTS)
    return zoneless(worst_first(flagged_hours_in_one_pass(hours, PAYMENTS), PAYMENTS))


def layers_flagged_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged hours from a written Gold table, joined with its own thresholds."""
    lake = Lakehouse(spark, scratch_path(spark, "flagged"))
    replace_table(gold_of(spark, sf_dir, PAYMENTS), lake.gold_path(PAYMENTS))
    return zoneless(worst_first(lake.flagged(PAYMENTS), PAYMENTS))


def top_hours(spark: SparkSession, sf_dir: str, spec: StreamSpec) -> DataFrame:
    return comparable(highest(gold_of(spark, sf_dir, spec), spec))


def payments_report(spark: SparkSession, sf_dir: str, question) -> DataFrame:
    return question(rows_of(spark, sf_dir, PAYMENTS))


def unified_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: rows_of(spark, sf_dir, spec) for name, spec in STREAMS.items()}
    return zoneless(timeline(tables))


def unified_log_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    payments, users, logs = (log_of(spark, sf_dir, spec) for spec in STREAMS.values())
    return zoneless(timeline_of_log(payments.unionByName(users).unionByName(logs)))


def payments_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zoneless(payment_trace(rows_of(spark, sf_dir, PAYMENTS)))


def sequence(
    spark: SparkSession, sf_dir: str, spec: StreamSpec, chunk_offsets: int = CHUNK_OFFSETS
) -> DataFrame:
    keyed = rows_of(spark, sf_dir, spec).select(spec.key, "partition", "offset")
    return entity_sequence(keyed, spec.key, chunk_offsets)


def encode_roundtrip(spark: SparkSession, sf_dir: str, spec: StreamSpec) -> DataFrame:
    """Publishes events and reads the messages back, with the key they got."""
    messages = encode(rows_of(spark, sf_dir, spec), spec)
    event = F.from_json(F.col("value").cast("string"), spec.ddl)
    return messages.select(
        F.col("key").cast("string").alias("key"), "topic", event.alias("event")
    ).select("key", "topic", "event.*")


def layers_roundtrip(spark: SparkSession, sf_dir: str, spec: StreamSpec) -> DataFrame:
    """Writes Bronze, Silver and Gold tables and reads Gold back."""
    lake = Lakehouse(spark, scratch_path(spark, "layers"))
    replace_table(rows_of(spark, sf_dir, spec), lake.bronze_path(spec))
    lake.refresh_silver(spec)
    return comparable(lake.refresh_gold(spec))


def stream_bronze(spark: SparkSession, sf_dir: str, spec: StreamSpec) -> DataFrame:
    """Bronze table of a streaming ingest over the whole log."""
    root = scratch_path(spark, "stream")
    lake = Lakehouse(spark, root)
    log = f"{root}/log"
    append_log_files(log_of(spark, sf_dir, spec), log)
    _ingest(lake, log, spec)
    return zoneless(lake.bronze(spec))


def stream_bronze_resume(spark: SparkSession, sf_dir: str, spec: StreamSpec) -> DataFrame:
    """The same, with the log arriving in two parts and the job run three times."""
    root = scratch_path(spark, "resume")
    lake = Lakehouse(spark, root)
    log = f"{root}/log"
    records = log_of(spark, sf_dir, spec)
    append_log_files(records.where("partition = 0"), log)
    _ingest(lake, log, spec)
    _ingest(lake, log, spec)
    append_log_files(records.where("partition <> 0"), log)
    _ingest(lake, log, spec)
    return zoneless(lake.bronze(spec))


def _ingest(
    lake: Lakehouse, log: str, spec: StreamSpec, count_steps: bool = False
) -> None:
    start_bronze(
        stream_log_files(lake.spark, log),
        spec,
        lake.bronze_path(spec),
        lake.checkpoint(spec),
        lake.table_format,
        interval=None,
        count_steps=count_steps,
    ).awaitTermination()


def incremental_silver(
    spark: SparkSession, sf_dir: str, spec: StreamSpec, buckets: int
) -> DataFrame:
    """Silver kept up with a Bronze table whose days come in three parts, out of order."""
    lake = Lakehouse(spark, scratch_path(spark, "incremental"))
    rows = rows_of(spark, sf_dir, spec).withColumn(LOG_DATE, F.to_date("kafka_timestamp"))
    part = F.dayofmonth(LOG_DATE) * 2 % 3
    for number in range(3):
        days = rows.where(part == number).hint("rebalance", LOG_DATE)
        days.write.mode("append").partitionBy(LOG_DATE).parquet(lake.bronze_path(spec))
        IncrementalSilver(lake, spec, buckets).refresh()
    return zoneless(lake.silver(spec))


# The end of the test tables' month, seen from which retention is measured.
AS_OF = "2024-01-31 00:00:00"
WEEK_OF_HOURS = 168


def silver_of(spark: SparkSession, sf_dir: str, spec: StreamSpec) -> DataFrame:
    return clean(rows_of(spark, sf_dir, spec), spec)


def last_week(spark: SparkSession, sf_dir: str, spec: StreamSpec) -> DataFrame:
    return zoneless(versus_last_week(gold_of(spark, sf_dir, spec), spec))


def rolled_up(spark: SparkSession, sf_dir: str, spec: StreamSpec, unit: str) -> DataFrame:
    return comparable(coarser(gold_of(spark, sf_dir, spec), spec, unit))


def flagged_with_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = gold_of(spark, sf_dir, PAYMENTS)
    return zoneless(flagged_hours_in_one_pass(hours, PAYMENTS, min_hours=WEEK_OF_HOURS))


def percentile_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return percentile_baseline(gold_of(spark, sf_dir, PAYMENTS), PAYMENTS)


def stored_silver(spark: SparkSession, sf_dir: str, spec: StreamSpec) -> DataFrame:
    """Silver as a table, for operators that read it more than once."""
    lake = Lakehouse(spark, scratch_path(spark, "silver"))
    return lake.store(silver_of(spark, sf_dir, spec), "silver", spec.name)


def service_escalations(
    spark: SparkSession, sf_dir: str, chunk_rows: int = CHUNK_OFFSETS
) -> DataFrame:
    logs = stored_silver(spark, sf_dir, SYSTEM_LOGS)
    ordered = logs.select("event_id", "service", "level", "partition", "offset")
    return escalations(ordered, chunk_rows)


def user_journeys(spark: SparkSession, sf_dir: str, summary) -> DataFrame:
    return zoneless(summary(stored_silver(spark, sf_dir, USER_EVENTS)))


def system_logs_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zoneless(hourly(silver_of(spark, sf_dir, SYSTEM_LOGS), SYSTEM_LOGS, "day"))


def daily_from_gold(spark: SparkSession, sf_dir: str, spec: StreamSpec) -> DataFrame:
    """Days merged from a stored Gold table, averages included."""
    lake = Lakehouse(spark, scratch_path(spark, "daily"))
    replace_table(silver_of(spark, sf_dir, spec), lake.silver_path(spec))
    lake.refresh_gold(spec)
    return zoneless(coarser(lake.gold_states(spec), spec, "day"))


def baseline_by_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The baseline after Gold's days have come in three parts, each read once."""
    lake = Lakehouse(spark, scratch_path(spark, "baseline-days"))
    hours = gold_of(spark, sf_dir, PAYMENTS).withColumn(EVENT_DATE, F.to_date(HOUR))
    replace_table(hours, lake.gold_path(PAYMENTS), partition_by=[EVENT_DATE])
    lake.refresh_baseline_days(PAYMENTS)
    lake.refresh_baseline_days(PAYMENTS, "2024-01-03", "2024-01-09")
    return lake.refresh_baseline_days(PAYMENTS, "2024-01-10", None)


def percentiles_by_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentile thresholds after Gold's days have come in two parts, each read once."""
    lake = Lakehouse(spark, scratch_path(spark, "percentile-days"))
    hours = gold_of(spark, sf_dir, PAYMENTS).withColumn(EVENT_DATE, F.to_date(HOUR))
    replace_table(hours, lake.gold_path(PAYMENTS), partition_by=[EVENT_DATE])
    lake.refresh_percentile_days(PAYMENTS)
    return lake.refresh_percentile_days(PAYMENTS, "2024-01-10", None)


# Payments with two columns that name the entity.
BY_CURRENCY = replace(
    PAYMENTS, name="payments_by_currency", grain=("merchant_id", "currency", HOUR)
)


def by_currency(spark: SparkSession, sf_dir: str, question) -> DataFrame:
    silver = silver_of(spark, sf_dir, PAYMENTS)
    return zoneless(question(hourly(silver, BY_CURRENCY), BY_CURRENCY))


def stored_flagged_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged hours as a baseline run stores them, with a week of history asked for."""
    lake = Lakehouse(spark, scratch_path(spark, "baseline"))
    replace_table(gold_of(spark, sf_dir, PAYMENTS), lake.gold_path(PAYMENTS))
    _, flagged = lake.refresh_baseline(PAYMENTS, min_hours=WEEK_OF_HOURS)
    return zoneless(flagged)


def dated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rows_of(spark, sf_dir, PAYMENTS)
    keys = rows.select(dated_key(PAYMENTS, "kafka_timestamp").alias("dated_key"))
    return keys.groupBy("dated_key").agg(F.count("*").alias("events"))


def incident_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    payments, users, logs = (
        gold_of(spark, sf_dir, spec) for spec in (PAYMENTS, USER_EVENTS, SYSTEM_LOGS)
    )
    return zoneless(incidents(payments, users, logs))


def load_of_keys(spark: SparkSession, sf_dir: str, spec: StreamSpec) -> DataFrame:
    return key_load(rows_of(spark, sf_dir, spec), spec)


def live_busy_keys(spark: SparkSession, sf_dir: str, spec: StreamSpec) -> DataFrame:
    """Keys above the mean of a streaming log that arrives in two parts, counted exactly.

    The multiple is one: at ten the smallest test table has no such key.
    """
    root = scratch_path(spark, "busy-keys")
    records = log_records(rows_of(spark, sf_dir, spec), spec)
    for part in ("partition = 0", "partition <> 0"):
        append_log_files(records.where(part), f"{root}/log")
        stream = decode(stream_log_files(spark, f"{root}/log"), spec)
        start_key_counts(
            stream, spec, f"{root}/keys", f"{root}/checkpoint", interval=None
        ).awaitTermination()
    volumes = read_table(spark, f"{root}/keys")
    return load_of_volumes(volumes, spec, factor=1).where("hot").drop("hot")


def observed_quality(spark: SparkSession, sf_dir: str, spec: StreamSpec) -> DataFrame:
    """Step counts that a streaming ingest of two runs has noted batch by batch."""
    root = scratch_path(spark, "batch-quality")
    lake = Lakehouse(spark, root)
    records = log_records(rows_of(spark, sf_dir, spec), spec)
    for part in ("partition = 0", "partition <> 0"):
        append_log_files(records.where(part), f"{root}/log")
        with noting_steps(spark, spec, f"{root}/notes"):
            _ingest(lake, f"{root}/log", spec, count_steps=True)
    return ingested_quality(spark, f"{root}/notes")


def half_minutes(spark: SparkSession, sf_dir: str, spec: StreamSpec) -> DataFrame:
    return comparable(windowed(rows_of(spark, sf_dir, spec), spec))


def retained_rows(spark: SparkSession, sf_dir: str, spec: StreamSpec) -> DataFrame:
    return zoneless(retained(rows_of(spark, sf_dir, spec), spec.name, AS_OF))


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for name, spec in STREAMS.items():
        found[f"bronze_{name}"] = partial(bronze, spec=spec)
        found[f"silver_{name}"] = partial(silver, spec=spec)
        found[f"dq_{name}"] = partial(step_quality, spec=spec)
        found[f"gold_{name}_hourly"] = partial(gold, spec=spec)
        found[f"encode_roundtrip_{name}"] = partial(encode_roundtrip, spec=spec)
        found[f"layers_roundtrip_{name}"] = partial(layers_roundtrip, spec=spec)
        found[f"stream_bronze_{name}"] = partial(stream_bronze, spec=spec)
    found["stream_bronze_payments_resume"] = partial(stream_bronze_resume, spec=PAYMENTS)
    for spec in (PAYMENTS, USER_EVENTS):
        found[f"silver_{spec.name}_incremental"] = partial(incremental_silver, spec=spec, buckets=8)
    found["payments_baseline"] = payments_baseline
    found["payments_flagged_hours"] = payments_flagged_hours
    found["layers_flagged_hours"] = layers_flagged_hours
    found["payments_top_failure_hours"] = partial(top_hours, spec=PAYMENTS)
    found["system_logs_top_error_hours"] = partial(top_hours, spec=SYSTEM_LOGS)
    found["report_total_events"] = partial(payments_report, question=report.total_events)
    found["report_failures_by_merchant"] = partial(
        payments_report, question=report.failures_by_merchant
    )
    found["report_volume_by_currency"] = partial(
        payments_report, question=report.volume_by_currency
    )
    found["report_status_breakdown"] = partial(
        payments_report, question=report.status_breakdown
    )
    found["unified_timeline"] = unified_timeline
    found["unified_log_timeline"] = unified_log_timeline
    found["payments_trace"] = payments_trace
    found["entity_sequence"] = partial(sequence, spec=PAYMENTS)
    found["entity_sequence_user_events"] = partial(sequence, spec=USER_EVENTS)
    found["entity_sequence_system_logs"] = partial(sequence, spec=SYSTEM_LOGS)
    found["payments_versus_last_week"] = partial(last_week, spec=PAYMENTS)
    found["payments_daily"] = partial(rolled_up, spec=PAYMENTS, unit="day")
    found["user_events_weekly"] = partial(rolled_up, spec=USER_EVENTS, unit="week")
    found["payments_flagged_hours_with_history"] = flagged_with_history
    found["payments_percentile_thresholds"] = percentile_thresholds
    found["service_escalations"] = service_escalations
    found["service_escalations_in_chunks"] = partial(service_escalations, chunk_rows=100)
    found["entity_sequence_in_runs"] = partial(sequence, spec=USER_EVENTS, chunk_offsets=150)
    found["system_logs_daily"] = system_logs_daily
    found["system_logs_daily_from_gold"] = partial(daily_from_gold, spec=SYSTEM_LOGS)
    found["payments_baseline_by_days"] = baseline_by_days
    found["payments_by_currency_versus_last_week"] = partial(
        by_currency, question=versus_last_week
    )
    found["payments_by_currency_flagged_hours"] = partial(
        by_currency, question=flagged_hours_in_one_pass
    )
    found["payments_stored_flagged_hours"] = stored_flagged_hours
    found["merchant_dated_keys"] = dated_keys
    found |= shop.all_queries()
    found["user_funnel"] = partial(user_journeys, summary=funnel)
    found["abandoned_carts"] = partial(user_journeys, summary=abandoned_carts)
    found["user_journeys"] = partial(user_journeys, summary=journeys)
    found["expired_carts"] = partial(user_journeys, summary=partial(expired_carts, until=AS_OF))
    found["incident_hours"] = incident_hours
    found["payments_percentile_by_days"] = percentiles_by_days
    found["user_busy_keys_live"] = partial(live_busy_keys, spec=USER_EVENTS)
    for name, spec in STREAMS.items():
        found[f"dq_{name}_observed"] = partial(observed_quality, spec=spec)
    found["user_key_load"] = partial(load_of_keys, spec=USER_EVENTS)
    found["payments_half_minutes"] = partial(half_minutes, spec=PAYMENTS)
    found["retained_payments"] = partial(retained_rows, spec=PAYMENTS)
    found["retained_system_logs"] = partial(retained_rows, spec=SYSTEM_LOGS)
    return found
