"""All streams as one feed of readable lines."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.lines import (
    Field,
    payment_line,
    payment_trace_line,
    system_log_line,
    user_event_line,
)
from tidemark.plans.streams import PAYMENTS, STREAMS, SYSTEM_LOGS, USER_EVENTS, StreamSpec

LINES: dict[str, Callable[[Field], Column]] = {
    PAYMENTS.name: payment_line,
    USER_EVENTS.name: user_event_line,
    SYSTEM_LOGS.name: system_log_line,
}


def timeline(bronze: Mapping[str, DataFrame]) -> DataFrame:
    """Feed of several Bronze tables, given by stream name. Rows come unsorted."""
    feeds = [
        rows.select(
            F.lit(spec.topic).alias("topic"),
            F.col(spec.key).alias("entity"),
            "kafka_timestamp",
            LINES[name](F.col).alias("line"),
        )
        for name, rows in bronze.items()
        for spec in [STREAMS[name]]
    ]
    return reduce(DataFrame.unionByName, feeds)


def payment_trace(bronze: DataFrame) -> DataFrame:
    """Payments as lines that name their log position, to check what a topic delivers."""
    return bronze.select("kafka_timestamp", payment_trace_line(F.col).alias("line"))


def timeline_of_log(log: DataFrame) -> DataFrame:
    """Feed of a log that carries several topics, read and parsed once.

    Each record is parsed with the schema of its own topic only. Records of topics
    that no stream declares have neither entity nor line.
    """
    events = [_of_topic(spec).alias(spec.name) for spec in STREAMS.values()]
    parsed = log.select("topic", F.col("timestamp").alias("kafka_timestamp"), *events)
    entity, line = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, spec in STREAMS.items():
        field = _field_of(name)
        mine = F.col("topic") == spec.topic
        entity = F.when(mine, field(spec.key)).otherwise(entity)
        line = F.when(mine, LINES[name](field)).otherwise(line)
    return parsed.select(
        "topic", entity.alias("entity"), "kafka_timestamp", line.alias("line")
    )


def _of_topic(spec: StreamSpec) -> Column:
    text = F.col("value").cast("string")
    return F.when(F.col("topic") == spec.topic, F.from_json(text, spec.ddl))


def _field_of(struct: str) -> Field:
    return lambda name: F.col(f"{struct}.{name}")
