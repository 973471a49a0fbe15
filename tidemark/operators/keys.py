"""Keys that outgrow their log partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.envelope import UNKNOWN_KEY
from tidemark.plans.streams import StreamSpec

# Fixed value: a key is hot above this multiple of the mean volume per key.
HOT_FACTOR = 10


def key_load(rows: DataFrame, spec: StreamSpec, factor: float = HOT_FACTOR) -> DataFrame:
    """Events per key beside the mean over keys; ``hot`` above ``factor`` times that."""
    return load_of_volumes(key_volumes(rows, spec), spec, factor)


def key_volumes(rows: DataFrame, spec: StreamSpec) -> DataFrame:
    """Events per key. Of a stream, the state has one row per key, spread over the tasks."""
    return (
        rows.where(F.col(spec.key).isNotNull())
        .groupBy(spec.key)
        .agg(F.count("*").alias("events"))
    )


def load_of_volumes(
    volumes: DataFrame, spec: StreamSpec, factor: float = HOT_FACTOR
) -> DataFrame:
    """The answer of :func:`key_load` from stored events per key."""
    mean = volumes.agg(F.avg("events")).scalar()
    return volumes.select(
        spec.key,
        "events",
        F.round(mean, 2).alias("mean_events"),
        (F.col("events") > factor * mean).alias("hot"),
    )


# Keys that a summary counts exactly; beyond, its counters go to the keys with most events.
TRACKED_KEYS = 65_536
# Registers of the count of distinct keys, as a power of two, and three times its error.
DISTINCT_BITS = 14
DISTINCT_ERROR = 3 * 1.04 / 2 ** (DISTINCT_BITS / 2)


def key_summary(rows: DataFrame, spec: StreamSpec, tracked: int = TRACKED_KEYS) -> DataFrame:
    """One row of fixed size about the keys of ``rows``: ``frequent, different, events``.

    A frequent-items summary, a sketch of the number of keys and the number of events with a
    key. Tasks summarise their own rows and send one row each, so no key is hot here. The
    summary may be taken of a stream, where it is the whole state.
    """
    key = F.col(spec.key)
    return rows.where(key.isNotNull()).agg(
        F.expr(f"approx_top_k_accumulate({spec.key}, {tracked})").alias("frequent"),
        F.hll_sketch_agg(key, DISTINCT_BITS).alias("different"),
        F.count("*").alias("events"),
    )


def merged_summaries(summaries: DataFrame, tracked: int = TRACKED_KEYS) -> DataFrame:
    """One summary of several, such as those of days or of topics."""
    return summaries.agg(
        F.expr(f"approx_top_k_combine(frequent, {tracked})").alias("frequent"),
        F.hll_union_agg("different").alias("different"),
        F.sum("events").alias("events"),
    )


def hot_keys(
    summary: DataFrame,
    spec: StreamSpec,
    factor: float = HOT_FACTOR,
    tracked: int = TRACKED_KEYS,
) -> DataFrame:
    """Keys above ``factor`` times the mean volume per key, by one summary.

    Columns: the key, ``events``, ``mean_events`` and ``sure_above``. Up to ``tracked`` keys
    the answer is that of :func:`key_load`. Beyond, ``events`` may be too high but not too low,
    the mean is taken as low as the sketch of their number allows, and no hot key with more
    events than ``sure_above`` is left out; some listed keys may lie below the limit.
    :func:`load_of_volumes` is exact for any number of keys, by a state that grows with it.
    """
    # The summary's table is the power of two from 4/3 of its keys on; 3.5 events in a
    # table's length is the error its authors state, and twice that is surely listed.
    slots = 1 << (-(-tracked * 4 // 3) - 1).bit_length()
    most = F.hll_sketch_estimate("different") * (1 + DISTINCT_ERROR)
    known = summary.select(
        F.expr(f"approx_top_k_estimate(frequent, {tracked})").alias("found"),
        "events",
        most.alias("most"),
    )
    exact = F.col("most") <= tracked
    mean = F.col("events") / F.when(exact, F.size("found")).otherwise(F.col("most"))
    return (
        known.select(
            mean.alias("mean"),
            F.when(exact, 0).otherwise(F.ceil(F.col("events") * 7 / slots)).alias("sure_above"),
            F.explode("found").alias("one"),
        )
        .where(F.col("one.count") > factor * F.col("mean"))
        .select(
            F.col("one.item").alias(spec.key),
            F.col("one.count").alias("events"),
            F.round("mean", 2).alias("mean_events"),
            "sure_above",
        )
    )


def dated_key(spec: StreamSpec, time: str) -> Column:
    """The key with its date, which splits a hot key's events by day.

    Order is then kept within a day of a key, across the partitions of its days. An
    event without its key or its time goes to the key for unknown ones.
    """
    key = F.coalesce(F.col(spec.key), F.lit(UNKNOWN_KEY))
    day = F.coalesce(F.date_format(time, "yyyy-MM-dd"), F.lit(UNKNOWN_KEY))
    return F.concat_ws("_", key, day)
