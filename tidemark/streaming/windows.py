"""Metrics over windows shorter than Gold's hour, as events arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.times import parse_event_time
from tidemark.operators.cleaning import accepted, keep_latest
from tidemark.plans.streams import StreamSpec

DEFAULT_WIDTH = "30 seconds"
DEFAULT_LATENESS = "10 minutes"


def by_window(
    bronze: DataFrame,
    spec: StreamSpec,
    width: str = DEFAULT_WIDTH,
    lateness: str = DEFAULT_LATENESS,
) -> DataFrame:
    """The stream's measures and rates per entity and ``_window``, valid events only.

    On a stream ``_window`` still carries the watermark, so that further windows and joins
    can follow (:mod:`tidemark.streaming.incidents`).
    """
    timed = accepted(bronze, spec).withColumn("event_timestamp", parse_event_time("timestamp"))
    if bronze.isStreaming:
        unique = (
            timed.where(F.col("event_timestamp").isNotNull())
            .withWatermark("event_timestamp", lateness)
            .dropDuplicatesWithinWatermark(["event_id"])
        )
    else:
        unique = keep_latest(timed).where(F.col("event_timestamp").isNotNull())
    measures = [F.expr(measure.sql).alias(name) for name, measure in spec.measures.items()]
    rates = [F.expr(sql).alias(name) for name, sql in spec.rates.items()]
    found = unique.groupBy(*spec.entities, F.window("event_timestamp", width).alias("_window"))
    return found.agg(*measures).select(*spec.entities, "_window", *spec.measures, *rates)


def windowed(
    bronze: DataFrame,
    spec: StreamSpec,
    width: str = DEFAULT_WIDTH,
    lateness: str = DEFAULT_LATENESS,
) -> DataFrame:
    """The stream's measures and rates per entity and window, valid events only.

    Works on tables and on streams, and an event counts once, in one window. On a table
    that is its latest copy, as in Silver, so the windows add up to Silver's rows with a
    time. A stream cannot wait for a later copy: it counts the copy that arrives first
    and drops those that follow within ``lateness``. A window of a stream is final once
    no event may be late for it by less than that, and its state is then dropped. Events
    without a readable time belong to no window.
    """
    found = by_window(bronze, spec, width, lateness)
    return found.select(
        *spec.entities,
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        *spec.measures,
        *spec.rates,
    )
