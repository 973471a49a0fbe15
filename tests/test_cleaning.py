from dataclasses import replace
from datetime import timedelta

import pytest

from tests.rows import NOON, bronze
from tidemark.operators.cleaning import clean
from tidemark.operators.quality import quality
from tidemark.plans.streams import PAYMENTS, STREAMS, SYSTEM_LOGS, USER_EVENTS, finite

NULLS, INVALID, DUPLICATE, KEPT = "dropped_nulls", "dropped_invalid", "dropped_duplicates", None

FAULTS = [
    (PAYMENTS, {"amount": None}, NULLS),
    (PAYMENTS, {"merchant_id": None}, NULLS),
    (PAYMENTS, {"event_id": None}, NULLS),
    (PAYMENTS, {"status": None}, NULLS),
    (PAYMENTS, {"amount": -1.0}, INVALID),
    (PAYMENTS, {"amount": 0.0}, INVALID),
    *[
        (PAYMENTS, {"status": status}, INVALID)
        for status in ("settled", "refused", " completed", "", "Completed")
    ],
    *[
        (PAYMENTS, {"currency": currency}, INVALID)
        for currency in ("ZZZ", "SEK", "$", "", "usd", None)
    ],
    (PAYMENTS, {"user_id": None}, KEPT),
    (PAYMENTS, {"amount": float("nan")}, KEPT),
    (PAYMENTS, {"amount": float("inf")}, KEPT),
    (PAYMENTS, {"timestamp": "garbage"}, KEPT),
    (PAYMENTS, {"timestamp": None}, KEPT),
    (USER_EVENTS, {"user_id": None}, NULLS),
    (USER_EVENTS, {"event_type": None}, NULLS),
    (USER_EVENTS, {"event_type": "scroll"}, INVALID),
    (USER_EVENTS, {"device": "tv"}, INVALID),
    (USER_EVENTS, {"device": None}, INVALID),
    (USER_EVENTS, {"page": None}, KEPT),
    (SYSTEM_LOGS, {"service": None}, NULLS),
    (SYSTEM_LOGS, {"level": None}, NULLS),
    (SYSTEM_LOGS, {"latency_ms": None}, NULLS),
    (SYSTEM_LOGS, {"level": "DEBUG"}, INVALID),
    (SYSTEM_LOGS, {"latency_ms": -0.1}, INVALID),
    (SYSTEM_LOGS, {"latency_ms": 0.0}, KEPT),
    (SYSTEM_LOGS, {"cpu_percent": 100.1}, INVALID),
    (SYSTEM_LOGS, {"cpu_percent": 100.0, "memory_percent": 0.0}, KEPT),
    (SYSTEM_LOGS, {"cpu_percent": None}, INVALID),
    (SYSTEM_LOGS, {"memory_percent": -1.0}, INVALID),
    (SYSTEM_LOGS, {"memory_percent": None}, INVALID),
]


@pytest.mark.parametrize("spec", STREAMS.values(), ids=STREAMS)
def test_faults_go_at_their_step(spark, spec):
    """All faults of a stream beside one good event."""
    faults = [(change, step) for owner, change, step in FAULTS if owner is spec]
    rows = bronze(spark, spec, [{}, *[change for change, _ in faults]])
    counts = quality(rows, spec).first()
    for step in (NULLS, INVALID):
        assert counts[step] == sum(1 for _, expected in faults if expected == step), step
    kept = {f"evt_{n}" for n, (_, step) in enumerate(faults, 1) if step is KEPT} | {"evt_0"}
    assert {row["event_id"] for row in clean(rows, spec).collect()} == kept


@pytest.mark.parametrize("spec", STREAMS.values(), ids=STREAMS)
def test_silver_columns(spark, spec):
    expected = [n for n in spec.field_names if n != "timestamp"]
    silver = clean(bronze(spark, spec, [{}]), spec)
    assert silver.columns == [
        *expected, "partition", "offset", "kafka_timestamp", "event_timestamp"
    ]
    assert dict(silver.dtypes)["event_timestamp"] == "timestamp"


def kept_offsets(spark, changes):
    rows = bronze(spark, PAYMENTS, [{"event_id": "evt_same", **c} for c in changes])
    return [row["offset"] for row in clean(rows, PAYMENTS).collect()]


def test_latest_copy_survives(spark):
    assert kept_offsets(spark, [{}, {"kafka_timestamp": NOON + timedelta(1)}, {}]) == [1]


def test_invalid_late_copy_does_not_hide_a_valid_one(spark):
    assert kept_offsets(spark, [{}, {"amount": -1.0}]) == [0]


def test_ties_go_to_the_last_log_position(spark):
    tied = {"kafka_timestamp": NOON}
    changes = [
        {**tied, "partition": 0, "offset": 9},
        {**tied, "partition": 1, "offset": 3},
        {**tied, "partition": 1, "offset": 4},
    ]
    assert kept_offsets(spark, changes) == [4]


def test_event_time_is_parsed_or_null(spark):
    texts = [
        "2024-05-01T12:30:00.000001+00:00",
        "2024-05-01T14:30:00+02:00",
        "2024-05-01 12:30:00",
        "garbage",
        "",
        None,
    ]
    rows = bronze(spark, PAYMENTS, [{"timestamp": text} for text in texts])
    found = clean(rows, PAYMENTS).orderBy("offset").selectExpr("cast(event_timestamp as string)")
    assert [row[0] for row in found.collect()] == [
        "2024-05-01 12:30:00.000001",
        "2024-05-01 12:30:00",
        "2024-05-01 12:30:00",
        None,
        None,
        None,
    ]


def test_cleaning_is_idempotent(spark):
    rows = bronze(spark, PAYMENTS, [{}, {}, {"event_id": "evt_0"}, {"amount": None}])
    once = clean(rows, PAYMENTS)
    again = clean(once.selectExpr("*", "cast(event_timestamp as string) as timestamp"), PAYMENTS)
    assert sorted(again.collect()) == sorted(once.collect())


def test_finite_is_an_optional_rule(spark):
    strict = replace(PAYMENTS, rules=(*PAYMENTS.rules, finite("amount")))
    amounts = [1.0, float("nan"), float("inf")]
    rows = bronze(spark, PAYMENTS, [{"amount": amount} for amount in amounts])
    assert [r["amount"] for r in clean(rows, strict).collect()] == [1.0]


def test_quality_of_empty_table(spark):
    row = quality(bronze(spark, PAYMENTS, []), PAYMENTS).first()
    assert row["total"] == row["after_dedup"] == row["dropped_total"] == 0
    assert row["quality_score"] is None


def test_quality_counts_and_score(spark):
    rows = bronze(
        spark, PAYMENTS, [{}, {"event_id": "evt_0"}, {"amount": None}, {"amount": -2.0}, {}, {}]
    )
    assert quality(rows, PAYMENTS).first().asDict() == {
        "total": 6,
        "after_nulls": 5,
        "after_validation": 4,
        "after_dedup": 3,
        "dropped_nulls": 1,
        "dropped_invalid": 1,
        "dropped_duplicates": 1,
        "dropped_total": 3,
        "quality_score": 50.0,
    }
