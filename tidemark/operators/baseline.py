"""What is normal for an entity, and the hours that are not."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.rounding import round2
from tidemark.plans.streams import HOUR, StreamSpec

THRESHOLD = "anomaly_threshold_pct"
# Fixed value: deviations above the mean from which an hour counts as an anomaly.
SIGMAS = 2


def _columns(spec: StreamSpec) -> tuple[str, str]:
    stem = spec.rate.removesuffix("_pct")
    return f"avg_{stem}", f"stddev_{stem}"


def _with_threshold(rows: DataFrame, spec: StreamSpec, min_hours: int) -> DataFrame:
    """Adds the threshold, NULL where ``_hours`` of history are too few."""
    mean, spread = _columns(spec)
    threshold = F.expr(f"round({mean} + {SIGMAS} * {spread}, 2)")
    return rows.withColumn(THRESHOLD, F.when(F.col("_hours") >= min_hours, threshold))


def _over_threshold(rows: DataFrame, spec: StreamSpec, time: str) -> DataFrame:
    total = next(iter(spec.measures))
    return rows.where(F.col(spec.rate) > F.col(THRESHOLD)).select(
        *spec.entities, time, spec.rate, THRESHOLD, total
    )


def baseline(gold: DataFrame, spec: StreamSpec, min_hours: int = 1) -> DataFrame:
    """Mean and sample deviation of the hourly rate per entity, and the threshold.

    The threshold is built from the rounded figures, so what a reader can see
    reproduces it. One hour of history has no deviation and thus a NULL threshold;
    ``min_hours`` asks for more history before an entity gets one.
    """
    mean, spread = _columns(spec)
    figures = gold.groupBy(*spec.entities).agg(
        F.expr(round2(f"avg({spec.rate})")).alias(mean),
        F.expr(round2(f"stddev_samp({spec.rate})")).alias(spread),
        F.count("*").alias("_hours"),
    )
    return _with_threshold(figures, spec, min_hours).drop("_hours")


def day_figures(gold: DataFrame, spec: StreamSpec, day: str) -> DataFrame:
    """Per entity and day of Gold: hours, mean rate and sum of squared deviations from it."""
    rate = F.col(spec.rate)
    return gold.groupBy(*spec.entities, F.to_date(HOUR).alias(day)).agg(
        F.count(rate).alias("hours"),
        F.avg(rate).alias("mean"),
        (F.var_pop(rate) * F.count(rate)).alias("squares"),
    )


# Figures of two parts of a history, merged pairwise so that no large squares cancel.
_MERGE = """struct(
    whole.hours + part.hours as hours,
    if(part.hours = 0, whole.mean,
        whole.mean + (part.mean - whole.mean) * part.hours / (whole.hours + part.hours)) as mean,
    whole.squares + part.squares + if(part.hours = 0, 0D, (part.mean - whole.mean)
        * (part.mean - whole.mean) * whole.hours * part.hours / (whole.hours + part.hours))
        as squares)"""


def thresholds_of_days(
    figures: DataFrame, spec: StreamSpec, day: str, min_hours: int = 1
) -> DataFrame:
    """:func:`baseline` from the figures of all days of each entity, one short row a day."""
    mean, spread = _columns(spec)
    parts = "sort_array(collect_list(struct({0}, hours, coalesce(mean, 0D) as mean, {1} as squares)))"
    parts = parts.format(day, "coalesce(squares, 0D)")
    nothing = "struct(0L as hours, 0D as mean, 0D as squares)"
    merged = figures.groupBy(*spec.entities).agg(
        F.expr(f"aggregate({parts}, {nothing}, (whole, part) -> {_MERGE})").alias("_whole")
    )
    known = merged.selectExpr(
        *spec.entities,
        "_whole.hours as _hours",
        f"if(_whole.hours > 0, {round2('_whole.mean')}, null) as {mean}",
        f"if(_whole.hours > 1, {round2('sqrt(_whole.squares / (_whole.hours - 1))')}, null)"
        f" as {spread}",
    )
    return _with_threshold(known, spec, min_hours).drop("_hours")


def percentile_baseline(
    gold: DataFrame, spec: StreamSpec, share: float = 0.95, min_hours: int = 1
) -> DataFrame:
    """Thresholds for rates that are far from normal: a percentile of the history.

    The percentile is exact. Its state is one counter per distinct rate, and a rate
    of 0 to 100 with two decimals has at most 10,001 values.
    """
    threshold = F.expr(round2(f"percentile({spec.rate}, {share})"))
    figures = gold.groupBy(*spec.entities).agg(
        threshold.alias(THRESHOLD), F.count("*").alias("_hours")
    )
    known = F.when(F.col("_hours") >= min_hours, F.col(THRESHOLD))
    return figures.withColumn(THRESHOLD, known).drop("_hours")


# Items that a sketch of rates holds in full; beyond it keeps a sample with a bounded error of rank.
SKETCH_ITEMS = 4096


def day_sketches(
    gold: DataFrame, spec: StreamSpec, day: str, items: int = SKETCH_ITEMS
) -> DataFrame:
    """Per entity and day of Gold: its hours, and a sketch of their rates that merges."""
    return gold.groupBy(*spec.entities, F.to_date(HOUR).alias(day)).agg(
        F.count("*").alias("hours"),
        F.kll_sketch_agg_double(F.col(spec.rate), items).alias("rates"),
    )


def thresholds_of_sketches(
    sketches: DataFrame, spec: StreamSpec, share: float = 0.95, min_hours: int = 1
) -> DataFrame:
    """Percentile thresholds from the sketches of all days of each entity.

    The threshold is a rate that occurred, the least one with ``share`` of the hours at or
    below it; :func:`percentile_baseline` takes the value between two rates instead. It is
    exact up to the sketch's number of items, which at 4,096 hours are 170 days; beyond, its
    rank is off by a small share of the history. Hours without a rate count as history only.
    """
    merged = sketches.groupBy(*spec.entities).agg(
        F.kll_merge_agg_double("rates").alias("_rates"), F.sum("hours").alias("_hours")
    )
    known = (F.col("_hours") >= min_hours) & (F.kll_sketch_get_n_double("_rates") > 0)
    found = F.kll_sketch_get_quantile_double("_rates", F.lit(float(share)))
    return merged.select(*spec.entities, F.when(known, found).alias(THRESHOLD))


def flagged_hours(
    gold: DataFrame, thresholds: DataFrame, spec: StreamSpec, time: str = HOUR
) -> DataFrame:
    """Hours whose rate exceeds their entity's threshold, for a stored Gold table.

    There is one threshold row per entity. Whether that side is small enough to
    broadcast is left to its measured size; otherwise the join shuffles on the
    entity, of which Gold holds at most one row per hour of history.
    """
    joined = gold.join(thresholds.select(*spec.entities, THRESHOLD), spec.entities)
    return _over_threshold(joined, spec, time)


def flagged_hours_in_one_pass(
    gold: DataFrame, spec: StreamSpec, min_hours: int = 1, time: str = HOUR
) -> DataFrame:
    """The same hours for a Gold frame that is still to be computed.

    A join would compute Gold once per side. Here each entity's hours meet in one
    window instead: at most one row per hour of history, whatever its traffic.
    ``time`` names the time column of Gold over other spans.
    """
    mean, spread = _columns(spec)
    history = Window.partitionBy(*spec.entities)
    seen = gold.withColumns(
        {
            "_mean": F.avg(spec.rate).over(history),
            "_spread": F.stddev_samp(spec.rate).over(history),
            "_hours": F.count("*").over(history),
        }
    ).withColumns({mean: F.expr(round2("_mean")), spread: F.expr(round2("_spread"))})
    return _over_threshold(_with_threshold(seen, spec, min_hours), spec, time)


def worst_first(flagged: DataFrame, spec: StreamSpec, time: str = HOUR) -> DataFrame:
    """Flagged hours in report order: highest rate first."""
    return flagged.orderBy(F.col(spec.rate).desc(), *spec.entities, time)
