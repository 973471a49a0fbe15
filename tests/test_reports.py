import pytest
from pyspark.sql import functions as F

from tests.rows import GOOD, bronze
from tidemark.functions.lines import number_text
from tidemark.operators import report
from tidemark.operators.envelope import log_records
from tidemark.operators.sequence import entity_sequence
from tidemark.operators.timeline import payment_trace, timeline, timeline_of_log
from tidemark.plans.streams import PAYMENTS, STREAMS, SYSTEM_LOGS, USER_EVENTS


def test_reports_count_dirty_rows(spark):
    rows = bronze(
        spark,
        PAYMENTS,
        [
            {"amount": 1.5},
            {"amount": -0.25, "event_id": "evt_0"},
            {"currency": "EUR", "amount": 2.0},
            {"status": "failed"},
            {"status": "failed", "merchant_id": "merchant_009"},
            {"status": "failed", "merchant_id": "merchant_009"},
            {"status": None, "merchant_id": None},
        ],
    )
    assert report.total_events(rows).first()[0] == 7
    assert [tuple(r) for r in report.failures_by_merchant(rows).collect()] == [
        ("merchant_009", 2), ("merchant_001", 1)
    ]
    assert [tuple(r) for r in report.volume_by_currency(rows).collect()] == [
        ("EUR", 1, 2.0, 2.0), ("USD", 2, 1.25, 0.63)
    ]
    assert [tuple(r) for r in report.status_breakdown(rows).collect()] == [
        (None, None, 1),
        ("merchant_001", "completed", 3),
        ("merchant_001", "failed", 1),
        ("merchant_009", "failed", 2),
    ]


LINES = [
    (PAYMENTS, {}, "💳 PAYMENT   | merchant_001 | $10.0 USD | COMPLETED"),
    (PAYMENTS, {"amount": 12345678.9}, "💳 PAYMENT   | merchant_001 | $12345678.9 USD | COMPLETED"),
    (PAYMENTS, {"status": None, "amount": None}, "💳 PAYMENT   | merchant_001 | $None USD | None"),
    (USER_EVENTS, {}, "👤 USER      | user_1 | page_view | /home | mobile"),
    (SYSTEM_LOGS, {}, "🟢 SYSTEM    | payments-service | INFO | ok | latency=12.5ms"),
    (SYSTEM_LOGS, {"level": "WARN"}, "🟡 SYSTEM    | payments-service | WARN | ok | latency=12.5ms"),
    (SYSTEM_LOGS, {"level": "ERROR"}, "🔴 SYSTEM    | payments-service | ERROR | ok | latency=12.5ms"),
    (SYSTEM_LOGS, {"level": "DEBUG"}, "⚪ SYSTEM    | payments-service | DEBUG | ok | latency=12.5ms"),
]


def changes_of(spec):
    return [change for owner, change, _ in LINES if owner is spec]


def test_timeline_of_tables(spark):
    tables = {name: bronze(spark, spec, changes_of(spec)) for name, spec in STREAMS.items()}
    feed = timeline(tables)
    assert feed.columns == ["topic", "entity", "kafka_timestamp", "line"]
    assert sorted(r["line"] for r in feed.collect()) == sorted(line for *_, line in LINES)
    assert {(r["topic"], r["entity"]) for r in feed.collect()} == {
        (spec.topic, GOOD[name][spec.key]) for name, spec in STREAMS.items()
    }


def test_timeline_of_one_log(spark):
    logs = [log_records(bronze(spark, s, changes_of(s)), s) for s in STREAMS.values()]
    other = logs[0].limit(1).withColumn("topic", F.lit("raw-other"))
    log = logs[0].union(logs[1]).union(logs[2]).union(other)
    feed = timeline_of_log(log).collect()
    assert sorted(r["line"] for r in feed if r["line"]) == sorted(line for *_, line in LINES)
    assert [(r["entity"], r["line"]) for r in feed if r["topic"] == "raw-other"] == [(None, None)]


def test_trace_names_the_log_position(spark):
    rows = bronze(spark, PAYMENTS, [{"partition": 2, "offset": 7}, {"amount": None, "status": None}])
    assert [r["line"] for r in payment_trace(rows).collect()] == [
        "← partition=2 offset=7 | merchant_001 | $10.0 USD | completed",
        "← partition=0 offset=1 | merchant_001 | $None USD | None",
    ]


NUMBERS = [
    0.0, 0.001, 0.0005, 1.0, 12.34, -7.5, 9999999.0, 10000000.0, 123456789.25, 4.5e15,
    5e-05, -1.25e-7, 1e16, 2.5e16, -3e22, 1e300, 1.5e-300, float("inf"), float("-inf"),
]


def test_number_text(spark):
    numbers = spark.createDataFrame([(x,) for x in [*NUMBERS, float("nan"), None]], "x double")
    found = [r[0] for r in numbers.select(number_text(F.col("x"))).collect()]
    assert found == [*[repr(x) for x in NUMBERS], "nan", None]


@pytest.mark.parametrize("chunk_offsets", [1, 3, 7, 1_000_000])
def test_entity_sequence_equals_brute_force(spark, chunk_offsets):
    log = [
        ("hot" if place % 3 else [None, "a", "b"][place % 9 // 3], place % 2, place * 5)
        for place in range(60)
    ]
    rows = spark.createDataFrame(log, "entity string, partition int, offset bigint")
    seen, expected = {}, []
    for entity, partition, offset in sorted(log, key=lambda r: r[1:]):
        seen[entity] = seen.get(entity, 0) + 1
        expected.append((entity, partition, offset, seen[entity]))
    found = entity_sequence(rows, "entity", chunk_offsets).orderBy("partition", "offset")
    assert [tuple(row) for row in found.collect()] == expected


def test_rows_without_a_place_stay_without_a_position(spark):
    log = [("a", 0, 5), ("a", None, 6), ("a", 1, None), (None, None, None), ("a", 0, 7), ("", 2, 1)]
    rows = spark.createDataFrame(log, "entity string, partition int, offset bigint")
    found = sorted((tuple(r) for r in entity_sequence(rows, "entity", 2).collect()), key=repr)
    assert found == sorted(
        [("a", 0, 5, 1), ("a", 0, 7, 2), ("a", None, 6, None), ("a", 1, None, None),
         (None, None, None, None), ("", 2, 1, 1)],
        key=repr,
    )
