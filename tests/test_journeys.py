"""Journeys composed of stretches, and carts that time out, beside plain walks of each log."""

import json
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.rows import NOON, USER_EVENT, bronze, log
from tidemark.operators.cleaning import clean
from tidemark.operators.envelope import decode
from tidemark.operators.journeys import STAGES, expired_carts, journeys
from tidemark.plans.streams import USER_EVENTS
from tidemark.sources.topics import append_log_files, stream_log_files
from tidemark.streaming.live import live_expired_carts

TYPES = [*STAGES, "click"]


def events(draw, n=400, span=5000):
    out = []
    for _ in range(n):
        # One user has most of the events, many of them at the same second.
        user = draw.choice(["hot"] * 4 + [f"u{k}" for k in range(30)])
        at = NOON + timedelta(seconds=draw.randrange(span), microseconds=draw.choice([0, 0, 500]))
        stamp = draw.choice([at.isoformat() + "+00:00"] * 9 + ["garbage"])
        kind = draw.choice(TYPES if user == "hot" else ["page_view", *TYPES])
        out.append({"user_id": user, "event_type": kind, "timestamp": stamp})
    return out


def walked(rows):
    found = {}
    for row in sorted(rows, key=lambda r: (r["event_timestamp"] or NOON, r["kafka_timestamp"], r["offset"])):
        times = found.setdefault(row["user_id"], [])
        if row["event_timestamp"] and len(times) < 4 and row["event_type"] == STAGES[len(times)]:
            times.append(row["event_timestamp"])
    return sorted((u, *t, *[None] * (4 - len(t)), len(t)) for u, t in found.items())


@pytest.mark.parametrize("spans", [(1, 3600), (1,), (7, 60, 900)])
def test_journeys_equal_a_walk(spark, spans):
    silver = clean(bronze(spark, USER_EVENTS, events(random.Random(len(spans)))), USER_EVENTS)
    found = sorted(map(tuple, journeys(silver, spans).collect()))
    assert found == walked(silver.collect())
    assert {row[-1] for row in found} >= {1, 2, 4}


def test_journeys_read_silver_once(spark, tmp_path):
    clean(bronze(spark, USER_EVENTS, events(random.Random(1))), USER_EVENTS).write.parquet(f"{tmp_path}/s")
    plan = journeys(spark.read.parquet(f"{tmp_path}/s"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan and "Python" not in plan
    assert journeys(spark.read.parquet(f"{tmp_path}/s").limit(0)).collect() == []


def left_behind(rows, wait, until):
    out = set()
    for row in rows:
        at = row["event_timestamp"]
        if row["event_type"] != "add_to_cart" or at is None or at + wait > until:
            continue
        own = [r for r in rows if r["user_id"] == row["user_id"] and r["event_timestamp"]
               and r["event_type"] in ("add_to_cart", "purchase")]
        paid = any(r["event_timestamp"] == at and r["event_type"] == "purchase" for r in own)
        if not paid and not any(at < r["event_timestamp"] <= at + wait for r in own):
            out.add((row["user_id"], at))
    return sorted(out)


@pytest.mark.parametrize("wait", [60, 300, 2000])
def test_expired_carts_equal_a_walk(spark, wait):
    silver = clean(bronze(spark, USER_EVENTS, events(random.Random(wait))), USER_EVENTS)
    until = NOON + timedelta(seconds=4000)
    found = sorted(map(tuple, expired_carts(silver, str(until), wait).collect()))
    assert found == left_behind(silver.collect(), timedelta(seconds=wait), until)
    assert found or wait == 2000


@pytest.mark.parametrize("cuts", [(399, 400), (60, 130, 400)])
def test_carts_of_a_stream_equal_those_of_a_table(spark, tmp_path, cuts):
    draw = random.Random(5)
    rows = [e for e in events(draw) if e["timestamp"] != "garbage"]
    # About in order of time, late by up to some minutes.
    rows.sort(key=lambda e: e["timestamp"] + "")
    late = sorted(range(len(rows)), key=lambda k: k + draw.randrange(30))
    values = [json.dumps({**USER_EVENT, **rows[k], "event_id": f"e{k}"}) for k in late]
    records = log(spark, values, "raw-user-events")
    low = 0
    for high in cuts:
        part = records.where((F.col("offset") >= low) & (F.col("offset") < high))
        append_log_files(part.coalesce(1), f"{tmp_path}/log")
        stream = decode(stream_log_files(spark, f"{tmp_path}/log"), USER_EVENTS)
        found = live_expired_carts(stream, 300, lateness="20 minutes")
        found.writeStream.format("parquet").outputMode("append").option(
            "checkpointLocation", f"{tmp_path}/checkpoint"
        ).trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination()
        low = high
    silver = clean(decode(records, USER_EVENTS), USER_EVENTS)
    last = silver.where("event_type in ('add_to_cart', 'purchase')").agg(F.max("event_timestamp")).first()[0]
    latest = silver.agg(F.max("event_timestamp")).first()[0]
    watermark = latest - timedelta(minutes=20)
    out = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect()))
    assert last and out == sorted(map(tuple, expired_carts(silver, str(watermark), 300).collect()))
    assert len(out) > 3
