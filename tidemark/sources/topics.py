"""Topics as DataFrames: Kafka, or files of log records in the same shape."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.envelope import ENVELOPE_DDL


def kafka_options(
    servers: str,
    topics: str | Iterable[str],
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of a Kafka scan over one topic or several.

    ``min_partitions`` splits topic partitions into more tasks, which a topic of a
    few partitions needs to be read by many executors.
    """
    names = [topics] if isinstance(topics, str) else list(topics)
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(names),
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def stream_topics(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Unbounded log of Kafka topics, with options from :func:`kafka_options`."""
    return spark.readStream.format("kafka").options(**options).load()


def stream_log_files(
    spark: SparkSession, path: str, max_bytes_per_trigger: int | None = None
) -> DataFrame:
    """Unbounded log of parquet files with log records, oldest files first."""
    reader = spark.readStream.schema(ENVELOPE_DDL)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    return reader.parquet(path)


def append_log_files(records: DataFrame, path: str) -> None:
    """Adds log records as parquet files for :func:`stream_log_files`."""
    records.write.mode("append").parquet(path)


def publish(messages: DataFrame, servers: str) -> None:
    """Sends messages (``key``, ``value``, ``topic``) to Kafka.

    The broker's partitioner hashes the key; no shuffle is needed before the send.
    """
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def publish_stream(messages: DataFrame, servers: str, checkpoint: str) -> StreamingQuery:
    """The streaming form of :func:`publish`."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
        .start()
    )
