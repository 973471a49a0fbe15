"""Between events and log records.

A log record is the envelope that a topic delivers: ``key``, ``value``, ``topic``,
``partition``, ``offset``, ``timestamp``, ``timestampType``. Both directions are
narrow projections and work on batch and streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.plans.streams import StreamSpec

ENVELOPE_DDL = (
    "key binary, value binary, topic string, partition int, offset bigint, "
    "timestamp timestamp, timestampType int"
)
LOG_POSITION_DDL = "partition int, offset bigint, kafka_timestamp timestamp"
LOG_POSITION = ["partition", "offset", "kafka_timestamp"]

#: Day of a record's log time, by which Bronze is stored.
LOG_DATE = "log_date"

# Fixed value: the key of an event that lacks its entity.
UNKNOWN_KEY = "unknown"


def _message(spec: StreamSpec) -> list[Column]:
    payload = F.to_json(F.struct(*spec.field_names), {"ignoreNullFields": "false"})
    return [
        F.coalesce(F.col(spec.key), F.lit(UNKNOWN_KEY)).cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
        F.lit(spec.topic).alias("topic"),
    ]


def encode(events: DataFrame, spec: StreamSpec) -> DataFrame:
    """Keyed JSON messages (``key``, ``value``, ``topic``), ready for a topic sink."""
    return events.select(*_message(spec))


def log_records(bronze: DataFrame, spec: StreamSpec) -> DataFrame:
    """The envelope of Bronze rows, for replaying a Bronze table as a log."""
    return bronze.select(
        *_message(spec),
        "partition",
        "offset",
        F.col("kafka_timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def decode(log: DataFrame, spec: StreamSpec, keep_raw: bool = False) -> DataFrame:
    """Bronze rows of a log: the declared fields, then the log position.

    No record is dropped. What does not parse becomes NULL: a field of the wrong
    type alone, every field of a record that is no JSON object. ``keep_raw`` adds
    the untouched bytes as ``raw_value``, so that nothing the log delivered is lost.
    """
    text = F.col("value").cast("string")
    columns = [
        F.from_json(text, spec.ddl).alias("event"),
        F.col("partition"),
        F.col("offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    ]
    kept = list(LOG_POSITION)
    if keep_raw:
        columns.append(F.col("value").alias("raw_value"))
        kept.append("raw_value")
    return log.select(*columns).select("event.*", *kept)
