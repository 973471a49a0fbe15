"""Operators for what the design of the streams intends beyond the core layers."""

import json
import random
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window, functions as F

from checks.queries import all_queries
from tests.conftest import SMALL
from tests.rows import NOON, PAYMENT, bronze, gold, log
from tidemark.operators.baseline import (
    baseline,
    flagged_hours,
    flagged_hours_in_one_pass,
    percentile_baseline,
)
from tidemark.operators.cleaning import clean
from tidemark.operators.envelope import decode
from tidemark.operators.hourly import hourly
from tidemark.operators.incidents import checkout_drops, incidents, with_silent_hours
from tidemark.operators.journeys import STAGES, abandoned_carts, funnel, journeys
from tidemark.operators.keys import dated_key, key_load
from tidemark.operators.patterns import ends_of_pattern, escalations
from tidemark.operators.retention import retained
from tidemark.operators.trends import coarser, versus_last_week
from tidemark.plans.streams import HOUR, PAYMENTS, SYSTEM_LOGS, USER_EVENTS, Measure, rows
from tidemark.sources.topics import append_log_files, stream_log_files
from tidemark.streaming.windows import windowed


def at(text):
    return {"timestamp": f"2024-05-{text}:00+00:00"}


def test_last_week_is_found_by_time(spark):
    changes = [
        at("01T10:05"),
        {**at("08T10:55"), "status": "failed"},
        at("08T11:00"),
        {"timestamp": "garbage"},
    ]
    hours = hourly(clean(bronze(spark, PAYMENTS, changes), PAYMENTS), PAYMENTS)
    found = versus_last_week(hours, PAYMENTS).orderBy("hour").collect()
    assert [(r["failure_rate_pct"], r["last_week_pct"], r["change_pct"]) for r in found] == [
        (0.0, None, None), (0.0, None, None), (100.0, 0.0, 100.0), (0.0, None, None)
    ]


def test_daily_rates_come_from_counts(spark):
    changes = [
        {**at("01T10:00"), "status": "failed"},
        *[at("01T11:00")] * 3,
        at("02T00:00"),
    ]
    hours = hourly(clean(bronze(spark, PAYMENTS, changes), PAYMENTS), PAYMENTS)
    days = coarser(hours, PAYMENTS, "day").orderBy("day").collect()
    assert [(r["day"].day, r["total_transactions"], r["failure_rate_pct"]) for r in days] == [
        (1, 4, 25.0), (2, 1, 0.0)
    ]
    assert coarser(hours, PAYMENTS, "week").count() == 1


def test_longer_spans_of_averages_come_from_silver(spark):
    changes = [
        {**at("01T10:00"), "latency_ms": 1.0},
        *[{**at("01T11:00"), "latency_ms": 4.0}] * 2,
        {**at("02T11:00"), "latency_ms": 9.0},
    ]
    silver = clean(bronze(spark, SYSTEM_LOGS, changes), SYSTEM_LOGS)
    with pytest.raises(ValueError, match="avg_latency_ms"):
        coarser(hourly(silver, SYSTEM_LOGS), SYSTEM_LOGS, "day")
    days = hourly(silver, SYSTEM_LOGS, "day").orderBy("day").collect()
    assert [(r["total_logs"], r["avg_latency_ms"], r["max_latency_ms"]) for r in days] == [
        (3, 3.0, 4.0), (1, 9.0, 9.0)
    ]


def test_measures_merge_as_they_declare(spark):
    measures = {
        "events": rows(),
        "users": Measure("count(distinct user_id)"),
        "longest": Measure("max(length(page))", "max"),
        "rounded": Measure("round(sum(length(page)), 2)", "sum"),
    }
    spec = replace(USER_EVENTS, measures=measures)
    assert spec.unmergeable == ["users"]
    merged = replace(spec, measures={k: v for k, v in measures.items() if k != "users"})
    changes = [{**at("01T10:00"), "page": "/a"}, {**at("01T11:00"), "page": "/abc"}]
    silver = clean(bronze(spark, spec, changes), spec)
    row = coarser(hourly(silver, merged), merged, "day").first()
    assert (row["events"], row["longest"], row["rounded"]) == (2, 4, 6)


BY_CURRENCY = replace(PAYMENTS, grain=("merchant_id", "currency", HOUR))


def test_an_entity_may_have_several_columns(spark):
    changes = [
        {**at("01T10:05"), "currency": "USD"},
        {**at("08T10:05"), "currency": "EUR", "status": "failed"},
        {**at("08T10:15"), "currency": "USD", "status": "failed"},
    ]
    hours = hourly(clean(bronze(spark, BY_CURRENCY, changes), BY_CURRENCY), BY_CURRENCY)
    found = versus_last_week(hours, BY_CURRENCY).collect()
    assert {(r["currency"], r["hour"].day): r["last_week_pct"] for r in found} == {
        ("USD", 1): None, ("EUR", 8): None, ("USD", 8): 0.0
    }
    assert baseline(hours, BY_CURRENCY).columns[:2] == ["merchant_id", "currency"]
    assert baseline(hours, BY_CURRENCY).count() == 2
    for flagged in (
        flagged_hours(hours, baseline(hours, BY_CURRENCY), BY_CURRENCY),
        flagged_hours_in_one_pass(hours, BY_CURRENCY),
    ):
        assert flagged.columns[:3] == ["merchant_id", "currency", "hour"]


@pytest.mark.parametrize("name", ["versus_last_week", "flagged_hours"])
def test_rows_by_currency_have_unique_keys(spark, name):
    found = all_queries()[f"payments_by_currency_{name}"](spark, SMALL)
    keys = found.select("merchant_id", "currency", "hour").distinct()
    assert found.count() == keys.count() > 0


RATES = {"new": [1.0, 1.0, 1.0, 1.0, 1.0, 50.0], "old": [1.0] * 20 + [50.0]}


def test_short_history_is_not_flagged(spark):
    hours = gold(spark, RATES)
    for flagged in (
        flagged_hours(hours, baseline(hours, PAYMENTS, min_hours=10), PAYMENTS),
        flagged_hours_in_one_pass(hours, PAYMENTS, min_hours=10),
    ):
        assert [r["merchant_id"] for r in flagged.collect()] == ["old"]
    assert flagged_hours_in_one_pass(hours, PAYMENTS).count() == 2


def test_percentile_threshold_interpolates(spark):
    hours = gold(spark, {"m": [float(n) for n in range(11)]})
    thresholds = percentile_baseline(hours, PAYMENTS)
    assert thresholds.first()["anomaly_threshold_pct"] == 9.5
    assert [r["failure_rate_pct"] for r in flagged_hours(hours, thresholds, PAYMENTS).collect()] == [
        10.0
    ]


@pytest.mark.parametrize("chunk_rows", [4, 5, 8, 1000])
def test_pattern_equals_brute_force(spark, chunk_rows):
    draw = random.Random(7)
    events, expected, seen = [], [], {}
    for place in range(400):
        service = draw.choice(["hot", "hot", "hot", "a", "b"])
        level = draw.choice(["WARN", "WARN", "WARN", "ERROR", "INFO"])
        events.append((service, level, 0, place))
        seen.setdefault(service, []).append(level)
        if seen[service][-4:] == ["WARN", "WARN", "WARN", "ERROR"]:
            expected.append((service, "ERROR", 0, place, len(seen[service])))
    logs = spark.createDataFrame(events, "service string, level string, partition int, offset bigint")
    found = escalations(logs, chunk_rows).orderBy("offset").collect()
    assert len(expected) > 10
    assert [tuple(row) for row in found] == expected


def test_patterns_do_not_run_into_another_partition(spark):
    levels = ["WARN", "WARN", "WARN", "ERROR"]
    logs = [("s", level, place // 2, place) for place, level in enumerate(levels)]
    logs += [("t", level, 1, 10 + place) for place, level in enumerate(levels)]
    logs += [("t", "WARN", None, 20), ("t", "ERROR", 1, None)]
    rows = spark.createDataFrame(logs, "service string, level string, partition int, offset bigint")
    for chunk_rows in (4, 1000):
        assert [r["service"] for r in escalations(rows, chunk_rows).collect()] == ["t"]


def test_chunk_must_hold_the_context(spark):
    logs = spark.createDataFrame([], "service string, level string, partition int, offset bigint")
    with pytest.raises(ValueError, match="cannot hold"):
        ends_of_pattern(logs, "service", "level", ["a", "b", "c"], chunk_rows=2)


def visits(spark, path):
    """User events of (user, type, minute)."""
    changes = [
        {"user_id": user, "event_type": kind, **at(f"01T10:{minute:02}")}
        for user, kind, minute in path
    ]
    return clean(bronze(spark, USER_EVENTS, changes), USER_EVENTS)


PATH = [
    *[("buyer", kind, n) for n, kind in enumerate(("page_view", "add_to_cart", "checkout", "purchase"))],
    ("buyer", "add_to_cart", 0),
    ("looker", "page_view", 5),
    ("leaver", "page_view", 1),
    ("leaver", "add_to_cart", 2),
    ("leaver", "click", 3),
    ("odd", "purchase", 1),
    ("odd", "page_view", 2),
    ("odd", "add_to_cart", 3),
    ("odd", "checkout", 4),
    ("again", "add_to_cart", 1),
    ("again", "purchase", 2),
    ("again", "add_to_cart", 3),
    ("early", "purchase", 0),
    *[("early", kind, n) for n, kind in enumerate(("page_view", "add_to_cart", "checkout", "purchase"), 1)],
    ("same", "page_view", 7),
    ("same", "add_to_cart", 7),
    ("back", "add_to_cart", 8),
    ("back", "page_view", 8),
]


def test_journeys_reach_stages_in_order(spark):
    found = {r["user_id"]: r["stages_reached"] for r in journeys(visits(spark, PATH)).collect()}
    assert found == {
        "buyer": 4, "looker": 1, "leaver": 2, "odd": 3, "again": 0, "early": 4, "same": 2, "back": 1
    }
    assert tuple(funnel(visits(spark, PATH)).first()) == (8, 7, 5, 3, 2)


def test_journeys_equal_brute_force(spark):
    draw = random.Random(11)
    path = [
        (f"u{draw.randrange(12)}", draw.choice([*STAGES, "click"]), draw.randrange(20))
        for _ in range(120)
    ]
    expected = {}
    for user in {user for user, _, _ in path}:
        mine = [(minute, place, kind) for place, (u, kind, minute) in enumerate(path) if u == user]
        stage = 0
        for _, _, kind in sorted(mine):
            stage += stage < len(STAGES) and kind == STAGES[stage]
        expected[user] = stage
    found = {r["user_id"]: r["stages_reached"] for r in journeys(visits(spark, path)).collect()}
    assert found == expected and len(set(expected.values())) > 2


def test_abandoned_carts_have_no_later_purchase(spark):
    found = abandoned_carts(visits(spark, PATH)).collect()
    assert {r["user_id"] for r in found} == {"leaver", "odd", "again", "same", "back"}


def test_incidents_join_streams_by_hour(spark):
    start = datetime(2024, 5, 1)
    hours = [start + timedelta(hours=n) for n in range(20)]
    trouble = hours[7]
    payments = spark.createDataFrame(
        [("m", h, 10, 90.0 if h == trouble else 5.0) for h in hours],
        "merchant_id string, hour timestamp, total_transactions bigint, failure_rate_pct double",
    )
    logs = spark.createDataFrame(
        [("s", h, 10, 90.0 if h in (trouble, hours[9]) else 5.0) for h in hours],
        "service string, hour timestamp, total_logs bigint, error_rate_pct double",
    )
    users = spark.createDataFrame(
        [("mobile", h, 0 if h == trouble else 100) for h in hours],
        "device string, hour timestamp, checkouts bigint",
    )
    assert [r["hour"] for r in checkout_drops(users).collect()] == [trouble]
    found = incidents(payments, users, logs).orderBy("hour").collect()
    assert [tuple(r) for r in found] == [(trouble, 1, 1, 1, 3), (hours[9], 0, 1, 0, 1)]


def test_silent_hours_are_drops(spark):
    start = datetime(2024, 5, 1)
    hours = [start + timedelta(hours=n) for n in range(30)]
    rows_ = [("mobile", h, 100) for h in hours if h != hours[7]]
    rows_ += [("tablet", h, 100) for h in (hours[0], hours[29])] + [("tablet", None, 5)]
    users = spark.createDataFrame(rows_, "device string, hour timestamp, checkouts bigint")
    assert with_silent_hours(users).count() == 60
    drops = [(r["device"], r["hour"], r["checkouts"]) for r in checkout_drops(users).collect()]
    assert drops == [("mobile", hours[7], 0)]
    assert checkout_drops(users.where("device is null")).count() == 0


def test_key_load_marks_outgrown_keys(spark):
    changes = [{"merchant_id": "big"}] * 60 + [{"merchant_id": f"m{n}"} for n in range(20)]
    load = key_load(bronze(spark, PAYMENTS, [*changes, {"merchant_id": None}]), PAYMENTS)
    assert load.count() == 21
    [hot] = load.where("hot").collect()
    assert (hot["merchant_id"], hot["events"], hot["mean_events"]) == ("big", 60, 3.81)


def test_dated_key_splits_by_day(spark):
    rows = bronze(spark, PAYMENTS, [{}, {"kafka_timestamp": NOON + timedelta(1)}])
    keys = rows.select(dated_key(PAYMENTS, "kafka_timestamp")).collect()
    assert [r[0] for r in keys] == ["merchant_001_2024-05-01", "merchant_001_2024-05-02"]
    rows = bronze(spark, PAYMENTS, [{"merchant_id": None}, {"kafka_timestamp": None}])
    keys = rows.select(dated_key(PAYMENTS, "kafka_timestamp")).collect()
    assert [r[0] for r in keys] == ["unknown_2024-05-01", "merchant_001_unknown"]


def test_retention_per_stream(spark):
    ages = [timedelta(hours=h) for h in (1, 24, 25, 24 * 7, 24 * 7 + 1)]
    for spec, kept in ((PAYMENTS, 4), (SYSTEM_LOGS, 2), (USER_EVENTS, 5)):
        rows = bronze(spark, spec, [{"kafka_timestamp": NOON - age} for age in ages])
        assert retained(rows, spec.name, str(NOON)).count() == kept


def test_retention_cut_reaches_the_scan(spark, tmp_path):
    bronze(spark, PAYMENTS, [{}]).write.parquet(f"{tmp_path}/t")
    rows = retained(spark.read.parquet(f"{tmp_path}/t"), "payments", str(NOON))
    assert "GreaterThanOrEqual(kafka_timestamp" in (
        rows._jdf.queryExecution().executedPlan().toString()
    )


def test_windows_on_a_stream_equal_those_on_a_table(spark, tmp_path):
    """Closed windows only: later ones wait for the watermark."""
    draw = random.Random(3)
    values = []
    late = set()
    for place in range(300):
        time = NOON + timedelta(seconds=place * 5)
        event = {
            **PAYMENT,
            "event_id": f"evt_{place}",
            "merchant_id": draw.choice(["m1", "m2"]),
            "status": draw.choice(["failed", "completed"]),
            "amount": draw.choice([10.0, 20.0, -1.0]),
            "timestamp": time.isoformat() + "+00:00",
        }
        values += [json.dumps(event)] * draw.choice([1, 1, 2])
        if event["amount"] > 0 and draw.random() < 0.1:
            # A later copy beyond the window's edge: it must not count again.
            late.add(event["event_id"])
            moved = (time + timedelta(seconds=30)).isoformat() + "+00:00"
            values.append(json.dumps({**event, "timestamp": moved}))
    records = log(spark, values)
    append_log_files(records, f"{tmp_path}/log")
    stream = decode(stream_log_files(spark, f"{tmp_path}/log"), PAYMENTS)
    query = (
        windowed(stream, PAYMENTS, lateness="1 minute")
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{tmp_path}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{tmp_path}/out")
    )
    query.awaitTermination()
    closed = spark.read.parquet(f"{tmp_path}/out")
    table = windowed(decode(records, PAYMENTS), PAYMENTS)
    last = closed.agg(F.max("window_end")).first()[0]
    assert last is not None and closed.count() > 20 and len(late) > 5
    # The table counts the latest copy, the stream the first one, so they are compared with
    # tables in which only that copy is left.
    rows_ = decode(records, PAYMENTS)
    firsts = Window.partitionBy("event_id").orderBy("offset")
    first = rows_.withColumn("n", F.row_number().over(firsts)).where("n = 1").drop("n")
    expected = windowed(first, PAYMENTS).where(F.col("window_end") <= last)
    assert sorted(closed.collect()) == sorted(expected.collect())
    counted = table.agg(F.sum("total_transactions")).first()[0]
    assert counted == clean(rows_, PAYMENTS).where("event_timestamp is not null").count()
