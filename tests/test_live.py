"""Stateful streams beside their table forms."""

import json
import random
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.rows import NOON, PAYMENT, SYSTEM_LOG, bronze, log
from tidemark.__main__ import main
from tidemark.operators.baseline import THRESHOLD
from tidemark.operators.cleaning import clean
from tidemark.operators.envelope import decode, log_records
from tidemark.operators.patterns import escalations
from tidemark.plans.layers import Lakehouse
from tidemark.plans.streams import PAYMENTS, SYSTEM_LOGS, USER_EVENTS
from tidemark.sources.topics import append_log_files, stream_log_files
from tidemark.streaming.live import live_escalations, live_flagged_hours, live_signals
from tidemark.streaming.windows import windowed


def run(stream, folder, name="out"):
    stream.writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", f"{folder}/checkpoint-{name}"
    ).trigger(availableNow=True).start(f"{folder}/{name}").awaitTermination()


def test_escalations_of_a_stream_equal_those_of_a_table(spark, tmp_path):
    draw = random.Random(2)
    levels = ["WARN", "WARN", "WARN", "ERROR", "INFO"]
    services = {name: place % 2 for place, name in enumerate("abc")}
    changes = []
    for place in range(400):
        service = draw.choice("aab" "c")
        changes.append(
            {"service": service, "partition": services[service], "level": draw.choice(levels)}
        )
    rows = bronze(spark, SYSTEM_LOGS, changes)
    records = log_records(rows, SYSTEM_LOGS)
    for low in (0, 100, 130, 131):
        high = {0: 100, 100: 130, 130: 131, 131: 400}[low]
        append_log_files(records.where(f"offset >= {low} and offset < {high}"), f"{tmp_path}/log")
        stream = decode(stream_log_files(spark, f"{tmp_path}/log"), SYSTEM_LOGS)
        run(live_escalations(stream), tmp_path)
    columns = ["service", "event_id", "partition", "offset"]
    found = spark.read.parquet(f"{tmp_path}/out").select(columns)
    expected = escalations(clean(rows, SYSTEM_LOGS)).select(columns)
    assert expected.count() > 8
    assert sorted(found.collect()) == sorted(expected.collect())


@pytest.fixture
def payments_log(spark, tmp_path):
    draw = random.Random(4)
    values = [
        json.dumps(
            {
                **PAYMENT,
                "event_id": f"evt_{place}",
                "merchant_id": draw.choice(["m1", "m2", "m3"]),
                "status": draw.choice(["failed", "completed", "completed"]),
                "timestamp": (NOON + timedelta(minutes=place * 3)).isoformat() + "+00:00",
            }
        )
        for place in range(300)
    ]
    records = log(spark, values)
    append_log_files(records, f"{tmp_path}/log")
    return records


def test_flagged_hours_of_a_stream(spark, tmp_path, payments_log):
    thresholds = spark.createDataFrame(
        [("m1", 30.0), ("m2", 45.0), ("m4", 0.0)], f"merchant_id string, {THRESHOLD} double"
    )
    stream = decode(stream_log_files(spark, f"{tmp_path}/log"), PAYMENTS)
    run(live_flagged_hours(stream, thresholds, PAYMENTS), tmp_path)
    found = spark.read.parquet(f"{tmp_path}/out")
    hours = windowed(decode(payments_log, PAYMENTS), PAYMENTS, "1 hour")
    expected = (
        hours.join(thresholds, "merchant_id")
        .where(f"failure_rate_pct > {THRESHOLD}")
        .withColumnRenamed("window_start", "hour")
    )
    last = found.agg(F.max("hour")).first()[0]
    expected = expected.where(F.col("hour") <= last).select(found.columns)
    assert found.count() > 5
    assert sorted(found.collect()) == sorted(expected.collect())


def test_signals_of_several_streams(spark, tmp_path, payments_log):
    logs = [
        json.dumps({**SYSTEM_LOG, "event_id": f"l{place}", "level": "ERROR",
                    "timestamp": (NOON + timedelta(hours=place)).isoformat() + "+00:00"})
        for place in range(6)
    ]
    append_log_files(log(spark, logs, "raw-system-logs"), f"{tmp_path}/logs")
    limits = spark.createDataFrame([("m1", 30.0)], f"merchant_id string, {THRESHOLD} double")
    service = spark.createDataFrame(
        [("payments-service", 50.0)], f"service string, {THRESHOLD} double"
    )
    signals = live_signals(
        [
            (decode(stream_log_files(spark, f"{tmp_path}/log"), PAYMENTS), limits, PAYMENTS),
            (decode(stream_log_files(spark, f"{tmp_path}/logs"), SYSTEM_LOGS), service, SYSTEM_LOGS),
        ]
    )
    run(signals, tmp_path)
    found = spark.read.parquet(f"{tmp_path}/out")
    assert {row["stream"] for row in found.collect()} == {"payments", "system_logs"}
    assert found.where("stream = 'system_logs'").count() >= 3


def test_expired_days_of_bronze_are_removed(spark, tmp_path):
    root = f"{tmp_path}/lake"
    changes = [{"kafka_timestamp": NOON - timedelta(days=age)} for age in (0, 1, 7, 8, 30)]
    append_log_files(log_records(bronze(spark, PAYMENTS, changes), PAYMENTS), f"{tmp_path}/log")
    common = ["payments", "--root", root]
    main(["bronze", *common, "--log", f"{tmp_path}/log", "--once"])
    lake = Lakehouse(spark, root)
    assert lake.bronze(PAYMENTS).count() == 5
    main(["expire", *common, "--as-of", str(NOON)])
    assert lake.bronze(PAYMENTS).count() == 3
    assert sorted(p.name for p in Path(lake.bronze_path(PAYMENTS)).glob("log_date=*")) == [
        "log_date=2024-04-24", "log_date=2024-04-30", "log_date=2024-05-01"
    ]
    assert lake.expire_bronze(PAYMENTS, str(NOON)) == []
    assert lake.expire_bronze(USER_EVENTS, str(NOON)) == []
    more = bronze(spark, PAYMENTS, [{"offset": 99}])
    append_log_files(log_records(more, PAYMENTS), f"{tmp_path}/log")
    main(["bronze", *common, "--log", f"{tmp_path}/log", "--once"])
    assert lake.bronze(PAYMENTS).count() == 4
