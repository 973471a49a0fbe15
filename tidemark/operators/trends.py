"""Gold over longer spans: the week before, and coarser buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.hourly import finished
from tidemark.plans.streams import HOUR, StreamSpec


def versus_last_week(gold: DataFrame, spec: StreamSpec) -> DataFrame:
    """Each hour's rate beside the same hour seven days earlier, where there is one.

    An interval frame picks the earlier hour by its time, so gaps in the history do
    not shift it, and Gold is read once.
    """
    earlier = F.expr(
        f"last({spec.rate}) over (partition by {', '.join(spec.entities)} order by {HOUR} "
        "range between interval 7 days preceding and interval 7 days preceding)"
    )
    # An hour without a time has only itself in its frame.
    compared = gold.withColumn("last_week_pct", F.when(F.col(HOUR).isNotNull(), earlier))
    return compared.select(
        *spec.entities,
        HOUR,
        spec.rate,
        "last_week_pct",
        F.round(F.col(spec.rate) - F.col("last_week_pct"), 2).alias("change_pct"),
    )


def coarser(gold: DataFrame, spec: StreamSpec, unit: str) -> DataFrame:
    """Gold per entity and ``unit`` ('day', 'week'), from hourly Gold with its states.

    States merge as the spec declares (:func:`tidemark.operators.hourly.hourly_states`) and
    measures and rates are computed from the merged ones: a mean of means or of rates would
    weigh quiet and busy hours alike. For a stream whose measures are their own states,
    finished Gold will do. A measure without states is refused.
    """
    if spec.unmergeable:
        raise ValueError(f"{spec.name} by {unit} needs Silver for {', '.join(spec.unmergeable)}")
    missing = [name for name in spec.states if name not in gold.columns]
    if missing:
        lacking = [
            name
            for name, measure in spec.measures.items()
            if name in missing or any(column in missing for column, _ in measure.states)
        ]
        raise ValueError(
            f"{spec.name} by {unit} needs the states of {', '.join(lacking)}: {', '.join(missing)}"
        )
    grain = [
        F.date_trunc(unit, HOUR).alias(unit) if column == HOUR else F.col(column)
        for column in spec.grain
    ]
    merged = [F.expr(f"{merge}({name})").alias(name) for name, (_, merge) in spec.states.items()]
    return finished(gold.groupBy(*grain).agg(*merged), spec, unit)
