"""Every registered query against its SQL counterpart."""

import pytest

import __spark_entry__ as driver
from checks.compare import differences
from checks.oracles import all_oracles
from checks.queries import all_queries
from tests.conftest import SMALL

QUERIES = all_queries()


def test_every_query_has_a_counterpart():
    assert set(all_oracles()) == set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, name):
    rows, only_spark, only_sql = differences(spark, SMALL, name)
    assert (only_spark, only_sql) == ([], [])
    assert rows > 0


def test_entry_is_the_flagship(spark):
    assert driver.entry(spark).columns == [
        "merchant_id", "hour", "failure_rate_pct", "anomaly_threshold_pct", "total_transactions"
    ]


# Rows after each step and Gold rows, on record for the mapped test tables.
COUNTS = {
    "payments": (1000, 970, 919, 827, 719),
    "user_events": (1000, 981, 948, 855, 569),
    "system_logs": (1000, 970, 909, 818, 724),
}


@pytest.mark.parametrize("stream", COUNTS)
def test_recorded_counts(spark, stream):
    quality = QUERIES[f"dq_{stream}"](spark, SMALL).first()
    gold = QUERIES[f"gold_{stream}_hourly"](spark, SMALL)
    steps = ("total", "after_nulls", "after_validation", "after_dedup")
    assert (*[quality[step] for step in steps], gold.count()) == COUNTS[stream]


@pytest.mark.parametrize("stream", COUNTS)
def test_invariants(spark, stream):
    silver = QUERIES[f"silver_{stream}"](spark, SMALL)
    assert silver.select("event_id").distinct().count() == silver.count()
    gold = QUERIES[f"gold_{stream}_hourly"](spark, SMALL)
    total = {"payments": "total_transactions", "user_events": "total_events"}.get(
        stream, "total_logs"
    )
    assert gold.selectExpr(f"sum({total})").first()[0] == silver.count()
    if stream == "system_logs":
        assert gold.where("info_count + warn_count + error_count <> total_logs").count() == 0
    for rate in [column for column in gold.columns if column.endswith("rate_pct")]:
        assert gold.where(f"{rate} not between 0 and 100").count() == 0


# Cases that the mapped tables must hold, so that a query without them would differ.
EVIDENCE = {
    "incident_hours": "dropping_devices > 0",
    "user_key_load": "hot",
    "payments_flagged_hours": "merchant_id = 'store-few'",
    "bronze_payments": "event_id is null and merchant_id is null and status is null",
    "stream_bronze_payments": "amount is null and event_id is not null",
    "gold_payments_hourly": "hour is null",
    "service_escalations_in_chunks": "position > 100",
    "entity_sequence_in_runs": "position > 150",
    "payments_by_currency_flagged_hours": "currency = 'GBP'",
    "merchant_dated_keys": "dated_key like 'unknown_%'",
}


@pytest.mark.parametrize("name", EVIDENCE)
def test_mapped_tables_reach_the_branches(spark, name):
    found = QUERIES[name](spark, SMALL.replace("0.001", "0.01"))
    assert found.where(EVIDENCE[name]).count() > 0


def test_history_asked_for_drops_a_merchant(spark):
    folder = SMALL.replace("0.001", "0.01")
    flagged = QUERIES["payments_flagged_hours_with_history"](spark, folder)
    assert flagged.where("merchant_id = 'store-few'").count() == 0


def test_windows_add_up_to_silver(spark):
    folder = SMALL.replace("0.001", "0.01")
    windows = QUERIES["payments_half_minutes"](spark, folder)
    silver = QUERIES["silver_payments"](spark, folder)
    counted = windows.selectExpr("sum(total_transactions)").first()[0]
    assert counted == silver.where("event_timestamp is not null").count() == 8177


def test_records_of_a_key_lie_in_one_partition(spark):
    for name, key in (("payments", "merchant_id"), ("user_events", "user_id"), ("system_logs", "service")):
        rows = QUERIES[f"silver_{name}"](spark, SMALL)
        assert rows.select(key, "partition").distinct().count() == rows.select(key).distinct().count()
