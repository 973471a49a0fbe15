import math
import statistics
from datetime import datetime

import pytest

from tests.rows import bronze, gold
from tidemark.operators.baseline import (
    baseline,
    flagged_hours,
    flagged_hours_in_one_pass,
    worst_first,
)
from tidemark.operators.cleaning import clean
from tidemark.operators.hourly import highest, hourly
from tidemark.plans.streams import PAYMENTS, STREAMS, SYSTEM_LOGS, USER_EVENTS


def hourly_of(spark, spec, changes):
    return hourly(clean(bronze(spark, spec, changes), spec), spec)


def test_payments_hourly(spark):
    changes = [
        {"amount": 10.25},
        {"amount": 5.5, "timestamp": "2024-05-01T12:59:59.999999+00:00"},
        {"status": "failed", "amount": 99.0},
        {"status": "pending"},
        {"timestamp": "2024-05-01T13:00:00+00:00", "status": "failed"},
        {"merchant_id": "merchant_002"},
        {"timestamp": "garbage"},
    ]
    rows = hourly_of(spark, PAYMENTS, changes)
    assert rows.columns == [
        "merchant_id", "hour", "total_transactions", "completed_count", "failed_count",
        "completed_volume", "failure_rate_pct",
    ]
    assert dict(rows.dtypes)["completed_volume"] == "double"
    assert [tuple(r) for r in rows.orderBy("merchant_id", "hour").collect()] == [
        ("merchant_001", None, 1, 1, 0, 10.0, 0.0),
        ("merchant_001", datetime(2024, 5, 1, 12), 4, 2, 1, 15.75, 25.0),
        ("merchant_001", datetime(2024, 5, 1, 13), 1, 0, 1, 0.0, 100.0),
        ("merchant_002", datetime(2024, 5, 1, 12), 1, 1, 0, 10.0, 0.0),
    ]


def test_user_events_hourly(spark):
    kinds = ["page_view", "page_view", "click", "signup", "add_to_cart", "checkout", "purchase"]
    rows = hourly_of(
        spark, USER_EVENTS, [*[{"event_type": k} for k in kinds], {"device": "tablet"}]
    )
    assert rows.columns == [
        "hour", "device", "total_events", "page_views", "add_to_carts", "checkouts", "purchases"
    ]
    assert [tuple(r)[1:] for r in rows.orderBy("device").collect()] == [
        ("mobile", 7, 2, 1, 1, 1), ("tablet", 1, 1, 0, 0, 0)
    ]


def test_system_logs_hourly(spark):
    changes = [
        {"latency_ms": 1.0, "cpu_percent": 10.0},
        {"latency_ms": 1.01, "cpu_percent": 10.0, "level": "WARN"},
        {"latency_ms": 7.456, "cpu_percent": 10.01, "level": "ERROR"},
    ]
    rows = hourly_of(spark, SYSTEM_LOGS, changes)
    assert rows.columns == [
        "service", "hour", "total_logs", "info_count", "warn_count", "error_count",
        "avg_latency_ms", "max_latency_ms", "avg_cpu_percent", "error_rate_pct",
    ]
    assert tuple(rows.first())[2:] == (3, 1, 1, 1, 3.16, 7.46, 10.0, 33.33)


def test_mean_on_a_rounding_boundary_rounds_half_up(spark):
    # The mean is 0.155, which no double holds: a plain round may give 0.15.
    changes = [{"latency_ms": value} for value in (0.1, 0.2, 0.15, 0.17)]
    assert hourly_of(spark, SYSTEM_LOGS, changes).first()["avg_latency_ms"] == 0.16


def test_non_finite_values_pass_through(spark):
    nan = hourly_of(spark, SYSTEM_LOGS, [{"latency_ms": float("nan")}, {}]).first()
    assert math.isnan(nan["avg_latency_ms"]) and math.isnan(nan["max_latency_ms"])
    inf = hourly_of(spark, SYSTEM_LOGS, [{"latency_ms": float("inf")}, {}]).first()
    assert inf["max_latency_ms"] == math.inf
    huge = hourly_of(spark, SYSTEM_LOGS, [{"latency_ms": 1e300}]).first()
    assert huge["max_latency_ms"] == 1e300


@pytest.mark.parametrize("spec", STREAMS.values(), ids=STREAMS)
def test_gold_of_nothing_is_empty(spark, spec):
    assert hourly_of(spark, spec, []).count() == 0


def test_highest_breaks_ties_by_entity_and_hour(spark):
    rates = {"m2": [50.0, 50.0, 10.0], "m1": [50.0, 1.0], "m3": [90.0, 5.0, 50.0]}
    top = highest(gold(spark, rates), PAYMENTS, 4)
    assert [(r["merchant_id"], r["hour"].hour) for r in top.collect()] == [
        ("m3", 12), ("m1", 12), ("m2", 12), ("m2", 13)
    ]


def test_baseline_uses_sample_deviation_of_rounded_figures(spark):
    rates = [10.0, 20.0, 25.0, 12.34]
    row = baseline(gold(spark, {"m": rates}), PAYMENTS).first()
    mean, spread = round(statistics.mean(rates), 2), round(statistics.stdev(rates), 2)
    assert tuple(row) == ("m", mean, spread, round(mean + 2 * spread, 2))


def test_one_hour_of_history_is_never_flagged(spark):
    hours = gold(spark, {"m": [100.0]})
    row = baseline(hours, PAYMENTS).first()
    assert (row["stddev_failure_rate"], row["anomaly_threshold_pct"]) == (None, None)
    assert flagged_hours(hours, baseline(hours, PAYMENTS), PAYMENTS).count() == 0
    assert flagged_hours_in_one_pass(hours, PAYMENTS).count() == 0


RATES = {
    "calm": [5.0] * 8,
    "spiky": [10.0, 12.0, 11.0, 9.0, 10.0, 11.0, 10.0, 60.0],
    "low": [0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 8.0, 0.0, 0.0],
}


def test_flagged_hours_exceed_their_own_threshold(spark):
    hours = gold(spark, RATES)
    flagged = worst_first(flagged_hours(hours, baseline(hours, PAYMENTS), PAYMENTS), PAYMENTS)
    assert flagged.columns == [
        "merchant_id", "hour", "failure_rate_pct", "anomaly_threshold_pct", "total_transactions"
    ]
    # A rate equal to the threshold (calm: deviation 0) is not flagged.
    assert [(r["merchant_id"], r["failure_rate_pct"]) for r in flagged.collect()] == [
        ("spiky", 60.0), ("low", 8.0)
    ]


def test_both_ways_of_flagging_agree(spark):
    hours = gold(spark, RATES)
    joined = flagged_hours(hours, baseline(hours, PAYMENTS), PAYMENTS)
    assert sorted(flagged_hours_in_one_pass(hours, PAYMENTS).collect()) == sorted(joined.collect())


def test_baseline_of_another_stream(spark):
    rows = hourly_of(spark, SYSTEM_LOGS, [{}, {"level": "ERROR"}])
    assert baseline(rows, SYSTEM_LOGS).columns == [
        "service", "avg_error_rate", "stddev_error_rate", "anomaly_threshold_pct"
    ]


def test_stream_without_rate_has_no_baseline(spark):
    with pytest.raises(ValueError, match="no single rate"):
        baseline(hourly_of(spark, USER_EVENTS, [{}]), USER_EVENTS)
