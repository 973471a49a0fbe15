"""Incidents of three streams beside those of their tables."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.rows import NOON, bronze
from tidemark.operators.baseline import baseline
from tidemark.operators.cleaning import clean
from tidemark.operators.envelope import decode, log_records
from tidemark.operators.hourly import hourly
from tidemark.operators.incidents import checkout_drops, checkout_floors, incidents
from tidemark.plans.streams import PAYMENTS, SYSTEM_LOGS, USER_EVENTS
from tidemark.sources.topics import append_log_files, stream_log_files
from tidemark.streaming.incidents import live_incidents

SPECS = (PAYMENTS, USER_EVENTS, SYSTEM_LOGS)
HOURS, LATENESS = 60, 4


def events(draw, spec):
    out = []
    for hour in range(HOURS):
        often = draw.choice([20, 22]) if spec is USER_EVENTS else draw.choice([6, 8])
        for _ in range(0 if spec is USER_EVENTS and hour == 33 else often):
            minutes = hour * 60 + draw.randrange(60)
            change = {"timestamp": (NOON + timedelta(minutes=minutes)).isoformat() + "+00:00"}
            if spec is PAYMENTS:
                bad = draw.random() < (0.9 if hour in (10, 33) else 0.1)
                change |= {"merchant_id": draw.choice("ab"), "status": "failed" if bad else "completed"}
            elif spec is SYSTEM_LOGS:
                bad = draw.random() < (0.9 if hour in (10, 41) else 0.1)
                change |= {"service": draw.choice("xy"), "level": "ERROR" if bad else "INFO"}
            else:
                # Now and then a device has nothing at all in an hour of others.
                mobile = hour not in (10, 44) and draw.random() < 0.9
                change |= {"device": "mobile" if mobile else "desktop", "event_type": "checkout"}
            out.append(change)
    return out


@pytest.mark.parametrize("cuts", [(0.4, 0.7), (0.1, 0.15)])
def test_live_incidents_equal_those_of_tables(spark, tmp_path, cuts):
    draw = random.Random(6)
    close = NOON + timedelta(hours=HOURS + 6)
    tables = {}
    for spec in SPECS:
        rows = events(draw, spec)
        rows.append({"timestamp": close.isoformat() + "+00:00"})
        tables[spec.name] = bronze(spark, spec, rows)
    gold = {spec.name: hourly(clean(tables[spec.name], spec), spec) for spec in SPECS}
    limits = {}
    for name, frame in (("payments", baseline(gold["payments"], PAYMENTS)),
                        ("system_logs", baseline(gold["system_logs"], SYSTEM_LOGS)),
                        ("user_events", checkout_floors(gold["user_events"]))):
        frame.write.parquet(f"{tmp_path}/limits-{name}")
        limits[name] = spark.read.parquet(f"{tmp_path}/limits-{name}")
    expected = incidents(gold["payments"], gold["user_events"], gold["system_logs"])
    closed = close - timedelta(hours=LATENESS + 1)
    expected = expected.where(F.col("hour") <= F.lit(closed)).collect()
    edges = [0.0, *cuts, 1.0]
    for low, high in zip(edges, edges[1:]):
        for spec in SPECS:
            # By time, with some arriving a part later, though not beyond the lateness.
            frame = tables[spec.name]
            n = frame.count()
            late = F.when(F.col("offset") % 7 == 0, F.col("offset") + 20).otherwise(F.col("offset"))
            part = frame.where((late >= low * n) & (late < (high * n if high < 1 else n * 9)))
            append_log_files(log_records(part, spec), f"{tmp_path}/log-{spec.name}")
        streams = [decode(stream_log_files(spark, f"{tmp_path}/log-{s.name}"), s) for s in SPECS]
        found = live_incidents(*streams, limits["payments"], limits["system_logs"],
                               limits["user_events"], lateness=f"{LATENESS} hours")
        found.writeStream.format("parquet").outputMode("append").option(
            "checkpointLocation", f"{tmp_path}/checkpoint"
        ).trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination()
    found = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, expected))
    signals = [tuple(row)[1:4] for row in found]
    assert all(any(counts[k] for counts in signals) for k in range(3))
    assert any(row["streams"] > 1 for row in found)


def device_gold(spark, rows):
    return spark.createDataFrame(
        [(device, NOON + timedelta(hours=hour), n) for device, hour, n in rows],
        "device string, hour timestamp, checkouts long",
    )


def test_an_odd_time_makes_few_hours(spark):
    rows = [("mobile", hour, 10) for hour in range(100) if hour != 50] + [("mobile", 8_700_000, 10)]
    found = checkout_drops(device_gold(spark, rows))
    # The silent hour, and as many after the history as belong to it.
    silent = sorted((row["hour"] - NOON) / timedelta(hours=1) for row in found.collect())
    assert silent in ([], [50.0, *range(100, 124)])
    few = checkout_drops(device_gold(spark, rows[:-1])).collect()
    assert [(row["hour"] - NOON) / timedelta(hours=1) for row in few] == [50.0]


def test_floors_equal_a_full_grid(spark):
    draw = random.Random(3)
    rows = [(device, hour, draw.randrange(9)) for device in ("a", "b") for hour in range(40)
            if draw.random() < 0.8 or hour in (0, 39)]
    grid = {d: [dict((h, n) for e, h, n in rows if e == d).get(h, 0) for h in range(40)] for d in "ab"}
    for row in checkout_floors(device_gold(spark, rows)).collect():
        values = grid[row["device"]]
        mean = sum(values) / 40
        spread = (sum((v - mean) ** 2 for v in values) / 39) ** 0.5
        assert row["low_checkouts"] == pytest.approx(round(mean, 2) - 2 * round(spread, 2), abs=1e-9)
