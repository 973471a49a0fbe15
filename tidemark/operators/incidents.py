"""Hours in which several streams show trouble at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.rounding import round2
from tidemark.operators.baseline import SIGMAS, flagged_hours_in_one_pass
from tidemark.plans.streams import HOUR, PAYMENTS, SYSTEM_LOGS

SIGNALS = ("failing_merchants", "failing_services", "dropping_devices")

#: Hours without any event that still belong to the history after an hour with one.
SILENCE = 24


def _covered(seen: DataFrame, time: str) -> DataFrame:
    """Hours up to the last one seen, with an event in them or in the ``SILENCE`` before.

    An hour far from all others, as an odd event time makes it, adds no more than itself
    and ``SILENCE`` more, wherever it lies.
    """
    hours = seen.select(time).distinct()
    reach = F.sequence(
        F.col(time), F.col(time) + F.expr(f"interval {SILENCE} {time}"), F.expr(f"interval 1 {time}")
    )
    last = hours.agg(F.max(time)).scalar()
    return hours.select(F.explode(reach).alias(time)).where(F.col(time) <= last).distinct()


def with_silent_hours(user_gold: DataFrame, time: str = HOUR) -> DataFrame:
    """``device, hour, checkouts`` of every device and covered hour, zeros where it was silent."""
    seen = user_gold.where(F.col(time).isNotNull()).select("device", time, "checkouts")
    hours = _covered(seen, time).agg(F.collect_list(time)).scalar()
    grid = seen.select("device").distinct().select("device", F.explode(hours).alias(time))
    return grid.join(seen, ["device", time], "left").na.fill(0, ["checkouts"])


def checkout_floors(user_gold: DataFrame, time: str = HOUR) -> DataFrame:
    """``device, low_checkouts``: a device's mean of checkouts less two deviations.

    Covered hours in which a device has no event count as zeros, by their number alone. The
    sums are of whole numbers and exact.
    """
    seen = user_gold.where(F.col(time).isNotNull()).select("device", time, "checkouts")
    hours = _covered(seen, time).agg(F.count("*")).scalar()
    exact = lambda column: column.cast("decimal(38,0)")
    sums = seen.groupBy("device").agg(
        F.sum("checkouts").alias("_sum"),
        F.sum(exact(F.col("checkouts") * F.col("checkouts"))).alias("_squares"),
    )
    spread = exact(hours * F.col("_squares") - exact(F.col("_sum")) * exact(F.col("_sum")))
    figures = sums.withColumns(
        {
            "_mean": F.col("_sum") / hours,
            # One hour has no deviation.
            "_spread": F.when(
                hours > 1, F.sqrt(spread.cast("double") / hours.cast("double") / (hours - 1))
            ),
        }
    )
    floor = F.expr(f"{round2('_mean')} - {SIGMAS} * {round2('_spread')}")
    return figures.select("device", floor.alias("low_checkouts"))


def checkout_drops(user_gold: DataFrame, time: str = HOUR) -> DataFrame:
    """Hours in which a device's checkouts fall short of its mean by two deviations.

    Silent hours count, both as drops and in the mean, where they are covered by hours with
    events (see :func:`_covered`). The hours' list is as long as the history; it is exploded
    for devices whose floor silence can undercut.
    """
    seen = user_gold.where(F.col(time).isNotNull()).select("device", time, "checkouts")
    floors = checkout_floors(user_gold, time)
    hours = _covered(seen, time).agg(F.collect_list(time)).scalar()
    silent = (
        floors.where("low_checkouts > 0")
        .select("device", F.explode(hours).alias(time))
        .join(seen, ["device", time], "left_anti")
        .withColumn("checkouts", F.lit(0).cast("long"))
    )
    low = seen.join(floors, "device").where("checkouts < low_checkouts")
    return low.select("device", time, "checkouts").unionByName(silent)


def incidents(payments_gold: DataFrame, user_gold: DataFrame, logs_gold: DataFrame) -> DataFrame:
    """Hours with trouble in any stream: what is affected, and in how many streams.

    Each side has one row per hour after its own count, so the joins are between
    tables no longer than the history has hours.
    """
    troubled = (
        flagged_hours_in_one_pass(payments_gold, PAYMENTS),
        flagged_hours_in_one_pass(logs_gold, SYSTEM_LOGS),
        checkout_drops(user_gold),
    )
    per_hour = [
        hours.where(F.col(HOUR).isNotNull()).groupBy(HOUR).agg(F.count("*").alias(signal))
        for hours, signal in zip(troubled, SIGNALS, strict=True)
    ]
    joined = reduce(lambda left, right: left.join(right, HOUR, "full"), per_hour)
    counts = joined.na.fill(0, list(SIGNALS))
    streams = reduce(lambda a, b: a + b, [(F.col(s) > 0).cast("int") for s in SIGNALS])
    return counts.select(HOUR, *SIGNALS, streams.alias("streams"))
