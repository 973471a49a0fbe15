"""Silver to Gold: one row per entity and hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.plans.streams import HOUR, StreamSpec


def hourly(silver: DataFrame, spec: StreamSpec, unit: str = HOUR) -> DataFrame:
    """The stream's measures and rates per entity and hour, in the spec's order.

    All measures have constant-size partial states, so each task sends one row per
    (entity, hour) it saw, however many events a hot entity has. Events whose time
    did not parse form an hour of their own, NULL. ``unit`` (``day``, ``week``, ...)
    asks for a longer span, whose column it names.
    """
    grain = [
        F.date_trunc(unit, "event_timestamp").alias(unit) if column == HOUR else F.col(column)
        for column in spec.grain
    ]
    measures = [F.expr(measure.sql).alias(name) for name, measure in spec.measures.items()]
    rates = {name: F.expr(sql) for name, sql in spec.rates.items()}
    gold = silver.groupBy(*grain).agg(*measures)
    return gold.withColumns(rates) if rates else gold


def hourly_states(silver: DataFrame, spec: StreamSpec, unit: str = HOUR) -> DataFrame:
    """The same groups with states that merge over hours in the measures' place."""
    grain = [
        F.date_trunc(unit, "event_timestamp").alias(unit) if column == HOUR else F.col(column)
        for column in spec.grain
    ]
    states = [F.expr(sql).alias(name) for name, (sql, _) in spec.states.items()]
    return silver.groupBy(*grain).agg(*states)


def finished(states: DataFrame, spec: StreamSpec, unit: str = HOUR) -> DataFrame:
    """Measures and rates of merged states, in the spec's order."""
    grain = [unit if column == HOUR else column for column in spec.grain]
    measures = [
        F.expr(measure.finish).alias(name) if measure.states else F.col(name)
        for name, measure in spec.measures.items()
    ]
    gold = states.select(*grain, *measures)
    rates = {name: F.expr(sql) for name, sql in spec.rates.items()}
    return gold.withColumns(rates) if rates else gold


def hourly_with_states(silver: DataFrame, spec: StreamSpec) -> DataFrame:
    """:func:`hourly` and the states that it follows from, as Gold is stored."""
    states = hourly_states(silver, spec)
    averages = {
        name: F.expr(measure.finish) for name, measure in spec.measures.items() if measure.states
    }
    gold = states.withColumns(averages) if averages else states
    rates = {name: F.expr(sql) for name, sql in spec.rates.items()}
    gold = gold.withColumns(rates) if rates else gold
    extra = [name for name in spec.states if name not in spec.measures]
    return gold.select(*spec.grain, *spec.measures, *spec.rates, *extra)


def highest(gold: DataFrame, spec: StreamSpec, n: int = 5) -> DataFrame:
    """The ``n`` entity hours with the highest rate, ties in entity and hour order."""
    return gold.orderBy(F.col(spec.rate).desc(), *spec.entities, HOUR).limit(n)
