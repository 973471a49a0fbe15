import json

import pytest

from tests.rows import PAYMENT, bronze, log
from tidemark.operators.envelope import decode, encode, log_records
from tidemark.plans.layers import Lakehouse
from tidemark.plans.streams import PAYMENTS, STREAMS
from tidemark.sources.topics import (
    append_log_files,
    kafka_options,
    publish,
    stream_log_files,
    stream_topics,
)
from tidemark.streaming.ingest import start_bronze


def ingest(lake, spec, log_path, **options):
    start_bronze(
        stream_log_files(lake.spark, log_path),
        spec,
        lake.bronze_path(spec),
        lake.checkpoint(spec),
        interval=None,
        **options,
    ).awaitTermination()


@pytest.mark.parametrize("spec", STREAMS.values(), ids=STREAMS)
def test_stream_equals_batch(spark, tmp_path, spec):
    records = log_records(bronze(spark, spec, [{}, {spec.key: None}, {}]), spec)
    append_log_files(records, f"{tmp_path}/log")
    lake = Lakehouse(spark, str(tmp_path))
    ingest(lake, spec, f"{tmp_path}/log")
    assert sorted(lake.bronze(spec).collect(), key=str) == sorted(
        decode(records, spec).collect(), key=str
    )


def test_restarted_job_neither_loses_nor_repeats(spark, tmp_path):
    lake, path = Lakehouse(spark, str(tmp_path)), f"{tmp_path}/log"
    append_log_files(log(spark, [json.dumps(PAYMENT)] * 10), path)
    counts = []
    for arriving in (0, 0, 15):
        if arriving:
            append_log_files(log(spark, ["not json"] * arriving), path)
        ingest(lake, PAYMENTS, path)
        counts.append(lake.bronze(PAYMENTS).count())
    assert counts == [10, 10, 25]


def test_bounded_batches_cover_the_whole_log(spark, tmp_path):
    path = f"{tmp_path}/log"
    for _ in range(3):
        append_log_files(log(spark, [json.dumps(PAYMENT)] * 4).coalesce(1), path)
    query = start_bronze(
        stream_log_files(spark, path, max_bytes_per_trigger=1),
        PAYMENTS,
        f"{tmp_path}/bronze",
        f"{tmp_path}/checkpoint",
        interval=None,
    )
    query.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/bronze").count() == 12
    assert len({p["batchId"] for p in query.recentProgress if p["numInputRows"]}) == 3


def test_raw_values_are_kept_on_request(spark, tmp_path):
    lake, path = Lakehouse(spark, str(tmp_path)), f"{tmp_path}/log"
    append_log_files(log(spark, ["not json"]), path)
    ingest(lake, PAYMENTS, path, keep_raw=True)
    assert bytes(lake.bronze(PAYMENTS, with_raw=True).first()["raw_value"]) == b"not json"


def test_kafka_options():
    assert kafka_options("broker:9092", "raw-payments") == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "raw-payments",
        "startingOffsets": "earliest",
    }
    several = kafka_options("b", ["x", "y"], "latest", max_offsets_per_trigger=9, min_partitions=4)
    assert several["subscribe"] == "x,y"
    assert several["startingOffsets"] == "latest"
    assert (several["maxOffsetsPerTrigger"], several["minPartitions"]) == ("9", "4")


def test_kafka_scan_needs_its_connector(spark):
    """Reaches the connector look-up; the connector itself is not installed here."""
    with pytest.raises(Exception, match="kafka"):
        stream_topics(spark, kafka_options("localhost:1", "raw-payments"))


def test_publish_needs_its_connector(spark):
    messages = encode(bronze(spark, PAYMENTS, [{}]), PAYMENTS)
    with pytest.raises(Exception, match="kafka"):
        publish(messages, "localhost:1")
