"""Silver that follows Bronze day by day, without reading what has not changed.

Beside Silver lies an index with one row per event id: the log position of the copy that
Silver holds, and the day it holds it in. The index is cut into buckets of a hash of the id.
A run

1. reads the Bronze days whose files have changed, and keeps the latest valid copy of each id;
2. joins these with the buckets they fall into: copies later than the indexed one win;
3. rewrites the Silver days that win a row, or lose one to another day;
4. rewrites the buckets with winners, and last of all notes the days as read.

The latest copy does not depend on the order of arrival, so after any sequence of appended
days Silver equals a rebuild from all of Bronze. Every step gives the same when it runs twice:
a run that dies is simply repeated, whichever step it died in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.cleaning import RECENCY, clean
from tidemark.operators.envelope import LOG_DATE
from tidemark.plans.layers import EVENT_DATE, Lakehouse
from tidemark.plans.streams import StreamSpec
from tidemark.session import scratch_path
from tidemark.sources.tables import (
    SELF_DESCRIBING,
    current_path,
    partition_values,
    read_table,
    remove_partitions,
    replace_partitions,
    replace_table,
    stored_files,
    table_exists,
)

BUCKET = "bucket"
BUCKETS = 256
LEDGER = f"{LOG_DATE} date, files bigint, bytes bigint, buckets int"
INDEX = "event_id string, kafka_timestamp timestamp, partition int, offset bigint"
SUMMARY = (
    "bronze_days bigint, candidates bigint, added bigint, replaced bigint, "
    "index_buckets bigint, silver_days bigint"
)


class IncrementalSilver:
    """Silver of one stream, kept up with its Bronze table.

    Bronze must lie by day of the log, as the ingest writes it, and only grow: rows of days
    that retention has removed stay in Silver. Plain tables only; Delta has its own merge.
    """

    def __init__(self, lake: Lakehouse, spec: StreamSpec, buckets: int = BUCKETS) -> None:
        if lake.table_format in SELF_DESCRIBING:
            raise ValueError(f"{lake.table_format} tables merge rows themselves")
        self.lake, self.spec, self.spark = lake, spec, lake.spark
        self.index_path = lake.path("silver", f"{spec.name}_index")
        self.ledger_path = lake.path("silver", f"{spec.name}_days_read")
        known = self.ledger().first()
        # An index keeps the number of buckets that it was made with.
        self.buckets = buckets if known is None else known["buckets"]

    def ledger(self) -> DataFrame:
        if not table_exists(self.spark, self.ledger_path):
            return self.spark.createDataFrame([], LEDGER)
        return self._read(self.ledger_path, LEDGER)

    def index(self) -> DataFrame:
        schema = f"{INDEX}, {EVENT_DATE} date, {BUCKET} int"
        if not table_exists(self.spark, self.index_path):
            return self.spark.createDataFrame([], schema)
        return self._read(self.index_path, schema)

    def changed_days(self) -> list[tuple[str, int, int]]:
        """Bronze days with other files than a run has read: day, files, bytes.

        One look at each day's folder; the days number hundreds, not rows.
        """
        path = self.lake.bronze_path(self.spec)
        if not table_exists(self.spark, path):
            return []
        days = partition_values(self.spark, path, LOG_DATE)
        if not days and stored_files(self.spark, path)[0]:
            raise ValueError(f"{path} does not lie by {LOG_DATE}")
        read = {
            (str(row[LOG_DATE]) if row[LOG_DATE] else None): (row["files"], row["bytes"])
            for row in self.ledger().collect()
        }
        folder = current_path(self.spark, path)
        found = []
        for day in sorted(days):
            size = stored_files(self.spark, f"{folder}/{LOG_DATE}={day}")
            name = day if day[:1].isdigit() else None
            if read.get(name) != size:
                found.append((name, *size))
        return found

    def refresh(self) -> DataFrame:
        """Brings Silver up to date; one row that says what was read and written.

        Columns: ``bronze_days`` read, ``candidates`` (ids with a valid copy there), ids
        ``added`` and ``replaced``, ``index_buckets`` and ``silver_days`` rewritten.
        """
        days = self.changed_days()
        if not days:
            return self.spark.createDataFrame([(0, 0, 0, 0, 0, 0)], SUMMARY)
        bronze = self.lake.bronze_of_days(self.spec, [day for day, _, _ in days])
        latest = clean(bronze, self.spec).withColumns(
            {EVENT_DATE: F.to_date("event_timestamp"), BUCKET: self._bucket("event_id")}
        )
        candidates = self._kept(latest, "silver-candidates")
        touched = [row[0] for row in candidates.select(BUCKET).distinct().collect()]
        winners = self._kept(self._winners(candidates, touched), "silver-winners")
        counts = winners.agg(
            F.count("*").alias("rows"), F.count_if("replaces").alias("replaced")
        ).first()
        changed = [row[0] for row in winners.select(BUCKET).distinct().collect()]
        moved = winners.where("replaces").select(F.col("old_date").alias(EVENT_DATE))
        silver_days = [
            row[0] for row in winners.select(EVENT_DATE).union(moved).distinct().collect()
        ]
        rows = winners.drop("replaces", "old_date")
        self._write_silver(rows.drop(BUCKET), silver_days)
        self._write_index(rows, changed)
        self._note(days)
        summary = (
            len(days),
            candidates.count(),
            counts["rows"] - counts["replaced"],
            counts["replaced"],
            len(changed),
            len(silver_days),
        )
        return self.spark.createDataFrame([summary], SUMMARY)

    def _winners(self, candidates: DataFrame, buckets: Sequence[int]) -> DataFrame:
        """Candidates without an indexed copy, or later than it; the day they replace one in."""
        place = F.struct(*RECENCY)
        old = (
            self.index()
            .where(F.col(BUCKET).isin(*buckets))
            .select(
                BUCKET,
                "event_id",
                place.alias("old_place"),
                F.col(EVENT_DATE).alias("old_date"),
                F.lit(True).alias("known"),
            )
        )
        met = candidates.join(old, [BUCKET, "event_id"], "left")
        later = F.col("known").isNull() | (place > F.col("old_place"))
        return met.where(later).withColumn("replaces", F.col("known").isNotNull()).drop(
            "old_place", "known"
        )

    def _write_silver(self, winners: DataFrame, days: list) -> None:
        """Affected days: what they hold of other ids, and the winners that belong to them."""
        path = self.lake.silver_path(self.spec)
        if not table_exists(self.spark, path):
            replace_table(_gathered(winners, EVENT_DATE), path, partition_by=[EVENT_DATE])
            return
        if not days:
            return
        own = self.lake.silver_of_days(self.spec, days)
        others = own.join(winners.select("event_id"), "event_id", "left_anti")
        merged = others.unionByName(winners)
        self._rewrite(merged, path, EVENT_DATE, days)

    def _write_index(self, winners: DataFrame, buckets: list) -> None:
        names = [*(name.split()[0] for name in INDEX.split(", ")), EVENT_DATE, BUCKET]
        new = winners.select(*names)
        if not table_exists(self.spark, self.index_path):
            replace_table(_gathered(new, BUCKET), self.index_path, partition_by=[BUCKET])
            return
        if not buckets:
            return
        own = self.index().where(F.col(BUCKET).isin(*buckets))
        others = own.join(new.select(BUCKET, "event_id"), [BUCKET, "event_id"], "left_anti")
        self._rewrite(others.select(*names).unionByName(new), self.index_path, BUCKET, buckets)

    def _rewrite(self, rows: DataFrame, path: str, column: str, values: list) -> None:
        """Replaces partitions by rows that were read from them, by way of a scratch table."""
        rows = self._kept(_gathered(rows, column), "silver-merged", column)
        left = {row[0] for row in rows.select(column).distinct().collect()}
        replace_partitions(_gathered(rows, column), path, [column])
        remove_partitions(self.spark, path, column, [v for v in values if v not in left])

    def _note(self, days: list[tuple[str, int, int]]) -> None:
        new = self.spark.createDataFrame(
            [(day, files, size, self.buckets) for day, files, size in days],
            "day string, files bigint, bytes bigint, buckets int",
        ).select(F.col("day").cast("date").alias(LOG_DATE), "files", "bytes", "buckets")
        own = self.ledger()
        same = own[LOG_DATE].eqNullSafe(new[LOG_DATE])
        merged = own.join(new, same, "left_anti").unionByName(new)
        replace_table(merged.coalesce(1), self.ledger_path)

    def _bucket(self, column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(self.buckets)).cast("int")

    def _read(self, path: str, schema: str) -> DataFrame:
        return read_table(self.spark, path, schema=schema)

    def _kept(self, rows: DataFrame, purpose: str, by: str | None = None) -> DataFrame:
        path = scratch_path(self.spark, purpose)
        writer = rows.write if by is None else rows.write.partitionBy(by)
        writer.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)


def _gathered(rows: DataFrame, column: str) -> DataFrame:
    """Rows arranged for a write by ``column``; large partitions are spread over tasks."""
    return rows.hint("rebalance", column)
