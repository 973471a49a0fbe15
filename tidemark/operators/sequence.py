"""The order of an entity's events in its log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# Upper bound on the rows that one task sorts for one entity.
CHUNK_OFFSETS = 1_000_000


def entity_sequence(
    rows: DataFrame, entity: str, chunk_offsets: int = CHUNK_OFFSETS
) -> DataFrame:
    """Adds ``position``: 1, 2, 3, ... per entity, by partition and offset.

    One window per entity would put all events of a hot entity into one task. The
    log is cut into runs of ``chunk_offsets`` offsets instead: rows are numbered
    within their run, and each run starts where the entity's earlier runs end. Runs
    hold at most ``chunk_offsets`` rows, since offsets are unique in a partition,
    and the start positions come from counts, not from rows. Window and join deal the
    rows by the same columns, so the rows move once.

    Rows without a partition or an offset have no place in the log; they stay, with a
    NULL position.
    """
    placed = F.col("partition").isNotNull() & F.col("offset").isNotNull()
    run = F.expr(f"offset div {int(chunk_offsets)}")
    # Rows without a place need no order; a hash keeps them from meeting in one task.
    names = {
        "_entity": F.coalesce(F.col(entity), F.lit("")),
        "_absent": F.col(entity).isNull(),
        "_part": F.when(placed, F.col("partition")),
        "_run": F.when(placed, run).otherwise(F.xxhash64(*rows.columns)),
    }
    cut = rows.withColumns(names)
    earlier = (
        Window.partitionBy("_entity", "_absent")
        .orderBy("_part", "_run")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        cut.where(placed)
        .groupBy(*names)
        .agg(F.count("*").alias("_rows"))
        .withColumn("_start", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .drop("_rows")
    )
    within = Window.partitionBy(*names).orderBy("offset")
    return (
        cut.withColumn("_place", F.row_number().over(within))
        .join(starts, list(names), "left")
        .select(*rows.columns, (F.col("_start") + F.col("_place")).alias("position"))
    )
