"""How many rows each Silver step keeps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tidemark.operators.cleaning import is_usable, is_valid
from tidemark.plans.streams import StreamSpec


# Name of the step counts in the progress of a stream.
STEPS = "silver_steps"


def _step_counts(spec: StreamSpec) -> list[Column]:
    return [
        F.count("*").alias("total"),
        F.count_if(is_usable(spec)).alias("after_nulls"),
        F.count_if(is_usable(spec) & is_valid(spec)).alias("after_validation"),
    ]


def with_drops_and_score(counts: DataFrame) -> DataFrame:
    """Rows lost per step and the share that survives, in percent to one decimal.

    The score of an empty table is NULL.
    """
    return counts.selectExpr(
        "total",
        "after_nulls",
        "after_validation",
        "after_dedup",
        "total - after_nulls as dropped_nulls",
        "after_nulls - after_validation as dropped_invalid",
        "after_validation - after_dedup as dropped_duplicates",
        "total - after_dedup as dropped_total",
        "round(after_dedup / nullif(total, 0) * 100, 1) as quality_score",
    )


def quality(bronze: DataFrame, spec: StreamSpec) -> DataFrame:
    """One row of step counts, in a single pass over Bronze.

    Deduplication keeps one row per id, hence its count is the number of distinct
    ids among valid rows. Ids are made distinct before the exchange, so a hot id
    travels once per task.
    """
    valid_id = F.when(is_usable(spec) & is_valid(spec), F.col("event_id"))
    counts = bronze.agg(*_step_counts(spec), F.count_distinct(valid_id).alias("after_dedup"))
    return with_drops_and_score(counts)


def observed(rows: DataFrame, spec: StreamSpec) -> tuple[DataFrame, Observation]:
    """``rows`` of Bronze, which count their steps while another job reads them."""
    steps = Observation()
    return rows.observe(steps, *_step_counts(spec)), steps


def observed_in_batches(rows: DataFrame, spec: StreamSpec) -> DataFrame:
    """A stream of Bronze rows that counts its steps in the progress of each micro-batch."""
    return rows.observe(STEPS, *_step_counts(spec))


def quality_of_run(spark: SparkSession, steps: dict, after_dedup: int) -> DataFrame:
    """The same row from the counts that a Silver run has observed."""
    row = (steps["total"], steps["after_nulls"], steps["after_validation"], after_dedup)
    names = "total bigint, after_nulls bigint, after_validation bigint, after_dedup bigint"
    return with_drops_and_score(spark.createDataFrame([row], names))
