"""Patterns in the order of an entity's events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.operators.sequence import CHUNK_OFFSETS, entity_sequence


def ends_of_pattern(
    rows: DataFrame,
    entity: str,
    column: str,
    pattern: Sequence[str],
    chunk_rows: int = CHUNK_OFFSETS,
) -> DataFrame:
    """Rows at which ``column`` has just run through ``pattern``, with their position.

    Rows follow each other by log position within their entity. The sequence is cut
    into chunks of ``chunk_rows`` rows, and the last rows of a chunk are copied into
    the next one as its context, so that no task sorts more than a chunk and matches
    across the cut are found all the same. A pattern does not run from one partition
    into another, between which the log has no order, and rows without a place in the
    log belong to none.
    """
    reach = len(pattern) - 1
    if chunk_rows <= reach:
        raise ValueError(f"a chunk of {chunk_rows} rows cannot hold the context of {pattern}")
    placed = (
        entity_sequence(rows, entity, chunk_rows)
        .where("position is not null")
        .withColumn("_home", F.expr(f"(position - 1) div {int(chunk_rows)}"))
    )
    is_tail = F.expr(f"(position - 1) % {int(chunk_rows)}") >= chunk_rows - reach
    chunks = F.when(is_tail, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))
    spread = placed.withColumn("_chunk", F.explode(chunks))
    order = Window.partitionBy(entity, "_chunk").orderBy("position")
    behind = {f"_behind_{n}": F.lag(column, n).over(order) for n in range(1, reach + 1)}
    behind["_first_partition"] = F.lag("partition", reach).over(order)
    # Partitions follow each other, so equal ends mean one partition throughout.
    matched = (F.col(column) == pattern[-1]) & (F.col("_first_partition") == F.col("partition"))
    for n in range(1, reach + 1):
        matched = matched & (F.col(f"_behind_{n}") == pattern[-1 - n])
    return (
        spread.withColumns(behind)
        .where(matched & (F.col("_chunk") == F.col("_home")))
        .select(*rows.columns, "position")
    )


# Fixed value: the sequence of log levels that announces a failing service.
ESCALATION = ("WARN", "WARN", "WARN", "ERROR")


def escalations(logs: DataFrame, chunk_rows: int = CHUNK_OFFSETS) -> DataFrame:
    """Errors that directly follow three warnings of the same service."""
    return ends_of_pattern(logs, "service", "level", ESCALATION, chunk_rows)
