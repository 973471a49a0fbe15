"""Continuous ingest of topics: into Bronze tables, and as feeds of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.operators.envelope import LOG_DATE, decode
from tidemark.operators.quality import observed_in_batches
from tidemark.plans.streams import StreamSpec

# Each micro-batch writes one file per task; a pause between batches keeps them few.
DEFAULT_INTERVAL = "1 minute"


def bronze_name(spec: StreamSpec) -> str:
    return f"bronze_{spec.name}"


def start_bronze(
    log: DataFrame,
    spec: StreamSpec,
    path: str,
    checkpoint: str,
    table_format: str = "parquet",
    keep_raw: bool = False,
    interval: str | None = DEFAULT_INTERVAL,
    count_steps: bool = False,
) -> StreamingQuery:
    """Starts appending a streaming log to Bronze.

    The checkpoint records which part of the log is written, so a restarted job goes
    on from there, without loss and without repeats. With ``interval=None`` the job
    takes what is available, in batches, and ends. Bronze lies by day of the log's clock,
    so that old days can be dropped as a whole. With ``count_steps`` the same scan counts
    what Silver will keep, for :func:`tidemark.streaming.watch.noting_steps`.
    """
    rows = decode(log, spec, keep_raw)
    if count_steps:
        rows = observed_in_batches(rows, spec)
    writer = (
        rows.withColumn(LOG_DATE, F.to_date("kafka_timestamp"))
        .writeStream.format(table_format)
        .queryName(bronze_name(spec))
        .partitionBy(LOG_DATE)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    return triggered(writer, interval).start(path)


def start_feed(
    lines: DataFrame,
    name: str,
    path: str,
    checkpoint: str,
    table_format: str = "parquet",
    interval: str | None = DEFAULT_INTERVAL,
) -> StreamingQuery:
    """Starts appending a streaming feed of lines to a table."""
    writer = (
        lines.writeStream.format(table_format)
        .queryName(name)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    return triggered(writer, interval).start(path)


def show_feed(
    lines: DataFrame, name: str, rows: int, interval: str | None = None
) -> StreamingQuery:
    """A preview of a streaming feed on the console, ``rows`` of each batch.

    The console prints on the driver, hence the bound; the feed itself is the table of
    :func:`start_feed`.
    """
    writer = (
        lines.writeStream.format("console")
        .queryName(f"{name}_console")
        .outputMode("append")
        .option("truncate", "false")
        .option("numRows", str(rows))
    )
    return triggered(writer, interval).start()


def triggered(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """A pause between batches, or (``None``) one run over what is available."""
    if interval is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)
