"""Incidents of several streams as their hours close.

Each stream is counted by hour and compared with its stored thresholds. An hour in which a
device has no event at all gives no row of its own, so a clock is needed: the hours up to
``SILENCE`` after one with events, a sliding window over the hourly rows. It is joined, on
device and hour, with what the devices did; what finds no partner was silent. All signals are
then counted once more by hour. Every step is one of Spark's stateful operators, and the
watermark, the least of the three streams, runs through all of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.baseline import THRESHOLD
from tidemark.operators.incidents import SIGNALS, SILENCE
from tidemark.plans.streams import (
    DEVICES,
    HOUR,
    PAYMENTS,
    SYSTEM_LOGS,
    USER_EVENTS,
    StreamSpec,
)
from tidemark.streaming.windows import DEFAULT_LATENESS, by_window

WIDTH = "1 hour"


def _at() -> Column:
    return F.window_time("_window").alias("at")


def _troubled(
    bronze: DataFrame, thresholds: DataFrame, spec: StreamSpec, signal: str, lateness: str
) -> DataFrame:
    hours = by_window(bronze, spec, WIDTH, lateness)
    limits = thresholds.select(*spec.entities, THRESHOLD)
    above = hours.join(limits, spec.entities).where(F.col(spec.rate) > F.col(THRESHOLD))
    return above.select(F.lit(signal).alias("signal"), _at())


def live_checkout_drops(bronze: DataFrame, floors: DataFrame, lateness: str) -> DataFrame:
    """``device, at, checkouts``: closed hours below the device's stored floor.

    ``at`` is the last moment of the hour and carries the watermark.
    """
    done = by_window(bronze, USER_EVENTS, WIDTH, lateness).select("device", _at(), "checkouts")
    seen = by_window(bronze, USER_EVENTS, WIDTH, lateness).select(_at())
    # A window of this width ends with each hour that the hours seen cover.
    clock = (
        seen.groupBy(F.window("at", f"{SILENCE + 1} hours", WIDTH).alias("_window"))
        .agg(F.count("*").alias("seen"))
        .select(_at(), F.explode(F.array(*map(F.lit, DEVICES))).alias("device"))
    )
    known = clock.join(floors.select("device", "low_checkouts"), "device")
    met = known.join(done, ["device", "at"], "left")
    checkouts = F.coalesce("checkouts", F.lit(0)).alias("checkouts")
    return met.where(F.coalesce("checkouts", F.lit(0)) < F.col("low_checkouts")).select(
        "device", "at", checkouts
    )


def live_incidents(
    payments: DataFrame,
    users: DataFrame,
    logs: DataFrame,
    payment_thresholds: DataFrame,
    log_thresholds: DataFrame,
    floors: DataFrame,
    lateness: str = DEFAULT_LATENESS,
) -> DataFrame:
    """Hours with trouble in any of the three streams of Bronze rows, as they close.

    The rows of :func:`tidemark.operators.incidents.incidents`, against thresholds that are
    stored tables (``baseline`` and ``checkout_floors``), read anew for every micro-batch. An
    hour is final once all three streams have passed its end by ``lateness``; events as late
    as that still count.
    """
    drops = live_checkout_drops(users, floors, lateness)
    found = (
        _troubled(payments, payment_thresholds, PAYMENTS, SIGNALS[0], lateness)
        .unionByName(_troubled(logs, log_thresholds, SYSTEM_LOGS, SIGNALS[1], lateness))
        .unionByName(drops.select(F.lit(SIGNALS[2]).alias("signal"), "at"))
    )
    counts = [F.count_if(F.col("signal") == signal).alias(signal) for signal in SIGNALS]
    streams = reduce(Column.__add__, [(F.col(signal) > 0).cast("int") for signal in SIGNALS])
    return (
        found.groupBy(F.window("at", WIDTH).alias("_window"))
        .agg(*counts)
        .select(F.col("_window.start").alias(HOUR), *SIGNALS, streams.alias("streams"))
    )
