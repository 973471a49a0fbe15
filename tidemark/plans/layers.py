"""Runs that move a stream from layer to layer, table to table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark.operators.baseline import (
    baseline,
    day_figures,
    day_sketches,
    flagged_hours,
    percentile_baseline,
    thresholds_of_days,
    thresholds_of_sketches,
)
from tidemark.operators.cleaning import clean
from tidemark.operators.envelope import LOG_DATE, LOG_POSITION_DDL
from tidemark.operators.hourly import hourly_with_states
from tidemark.operators.quality import observed, quality_of_run
from tidemark.operators.retention import first_kept_date
from tidemark.plans.streams import HOUR, StreamSpec
from tidemark.session import size_for
from tidemark.sources.tables import (
    SELF_DESCRIBING,
    partition_values,
    read_table,
    remove_partitions,
    replace_partitions,
    replace_table,
    table_exists,
)

EVENT_DATE = "event_date"


@dataclass(frozen=True)
class Lakehouse:
    """The tables of all layers below one root folder."""

    spark: SparkSession
    root: str
    table_format: str = "parquet"

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def checkpoint(self, spec: StreamSpec) -> str:
        return self.path("checkpoints/bronze", spec.name)

    def bronze_path(self, spec: StreamSpec) -> str:
        return self.path("bronze", spec.name)

    def silver_path(self, spec: StreamSpec) -> str:
        return self.path("silver", spec.name)

    def gold_path(self, spec: StreamSpec) -> str:
        return self.path("gold", f"{spec.name}_hourly")

    def bronze(self, spec: StreamSpec, with_raw: bool = False) -> DataFrame:
        """Bronze rows; ``with_raw`` for tables that keep the undecoded bytes."""
        return self._bronze_days(spec, with_raw).drop(LOG_DATE)

    def _bronze_days(self, spec: StreamSpec, with_raw: bool = False) -> DataFrame:
        raw = ", raw_value binary" if with_raw else ""
        schema = f"{spec.ddl}, {LOG_POSITION_DDL}{raw}, {LOG_DATE} date"
        return self._read(self.bronze_path(spec), schema)

    def bronze_of_days(self, spec: StreamSpec, days: list[str | None]) -> DataFrame:
        """Bronze rows of some days of the log; the files of other days are not read."""
        return _on_days(self._bronze_days(spec), LOG_DATE, days).drop(LOG_DATE)

    def silver_of_days(self, spec: StreamSpec, days: list) -> DataFrame:
        """Silver rows of some days, with the day; None stands for rows without a time."""
        return _on_days(self._silver_days(spec), EVENT_DATE, days)

    def expire_bronze(self, spec: StreamSpec, as_of: str) -> list[str]:
        """Removes the days of Bronze that the stream's retention no longer covers.

        Whole partitions go, without a scan of the rest; the days removed are returned.
        """
        first = first_kept_date(spec.name, as_of)
        if first is None or not table_exists(self.spark, self.bronze_path(spec)):
            return []
        path = self.bronze_path(spec)
        if self.table_format in SELF_DESCRIBING:
            old = self._bronze_days(spec).where(F.col(LOG_DATE) < F.lit(first))
            days = [str(row[0]) for row in old.select(LOG_DATE).distinct().collect()]
        else:
            days = [day for day in partition_values(self.spark, path, LOG_DATE) if day < str(first)]
        remove_partitions(self.spark, path, LOG_DATE, days, self.table_format)
        return sorted(days)

    def silver(
        self, spec: StreamSpec, first_date: str | None = None, last_date: str | None = None
    ) -> DataFrame:
        """Silver rows, of all days or of a range of days (both ends included).

        A range reads the files of its days only.
        """
        return self._silver_days(spec, first_date, last_date).drop(EVENT_DATE)

    def gold(
        self, spec: StreamSpec, first_date: str | None = None, last_date: str | None = None
    ) -> DataFrame:
        """Gold rows, of all days or of a range of days."""
        days = self._gold_days(spec, first_date, last_date)
        return days.select(*spec.grain, *spec.measures, *spec.rates)

    def gold_states(
        self, spec: StreamSpec, first_date: str | None = None, last_date: str | None = None
    ) -> DataFrame:
        """The states stored with Gold, which merge over hours and give longer spans."""
        return self._gold_days(spec, first_date, last_date).select(*spec.grain, *spec.states)

    def _read(self, path: str, schema: StructType | str) -> DataFrame:
        return read_table(self.spark, path, self.table_format, schema)

    def _silver_days(
        self, spec: StreamSpec, first_date: str | None = None, last_date: str | None = None
    ) -> DataFrame:
        schema = self._silver_schema(spec).add(EVENT_DATE, "date")
        return _of_days(self._read(self.silver_path(spec), schema), first_date, last_date)

    def _gold_days(
        self, spec: StreamSpec, first_date: str | None = None, last_date: str | None = None
    ) -> DataFrame:
        no_silver = self.spark.createDataFrame([], self._silver_schema(spec))
        schema = hourly_with_states(no_silver, spec).schema.add(EVENT_DATE, "date")
        return _of_days(self._read(self.gold_path(spec), schema), first_date, last_date)

    def _silver_schema(self, spec: StreamSpec) -> StructType:
        no_bronze = self.spark.createDataFrame([], f"{spec.ddl}, {LOG_POSITION_DDL}")
        return clean(no_bronze, spec).schema

    def refresh_silver(self, spec: StreamSpec) -> DataFrame:
        """Rebuilds Silver from all of Bronze; returns the quality row of the run.

        The counts are taken while the one scan of Bronze runs, so they and Silver come
        from the same rows. Shuffles are sized for the Bronze table.
        """
        size_for(self.spark, self.bronze_path(spec))
        bronze, steps = observed(self.bronze(spec), spec)
        written = Observation()
        by_day = _by_day(clean(bronze, spec), "event_timestamp").observe(
            written, F.count("*").alias("rows")
        )
        replace_table(by_day, self.silver_path(spec), self.table_format, [EVENT_DATE])
        return quality_of_run(self.spark, steps.get, written.get["rows"])

    def refresh_gold(self, spec: StreamSpec) -> DataFrame:
        """Rebuilds Gold from all of Silver; returns the written table.

        Gold is not sorted before the write: order belongs to the queries that show it.
        """
        size_for(self.spark, self.silver_path(spec))
        by_day = _by_day(hourly_with_states(self.silver(spec), spec), HOUR)
        replace_table(by_day, self.gold_path(spec), self.table_format, [EVENT_DATE])
        return self.gold(spec)

    def refresh_gold_days(
        self, spec: StreamSpec, first_date: str | None, last_date: str | None
    ) -> DataFrame:
        """Rebuilds Gold for a range of days, from those days of Silver.

        An end left out leaves the range open there. Days of the range that Silver no
        longer has lose their Gold rows, all other days stay as they are. Events without
        a time belong to no day; their hour is rebuilt by :meth:`refresh_gold` alone.
        """
        by_day = _by_day(hourly_with_states(self.silver(spec, first_date, last_date), spec), HOUR)
        if not table_exists(self.spark, self.gold_path(spec)):
            replace_table(by_day, self.gold_path(spec), self.table_format, [EVENT_DATE])
            return self.gold(spec)
        lost = [row[0] for row in self._gold_only_days(spec, first_date, last_date).collect()]
        replace_partitions(by_day, self.gold_path(spec), [EVENT_DATE], self.table_format)
        remove_partitions(
            self.spark, self.gold_path(spec), EVENT_DATE, lost, self.table_format
        )
        return self.gold(spec)

    def _gold_only_days(
        self, spec: StreamSpec, first_date: str | None, last_date: str | None
    ) -> DataFrame:
        """Days of the range, no more than it has, that Gold has and Silver has not."""
        silver = self._silver_days(spec, first_date, last_date).select(EVENT_DATE).distinct()
        gold = self._gold_days(spec, first_date, last_date).select(EVENT_DATE).distinct()
        lost = gold.where(F.col(EVENT_DATE).isNotNull())
        return lost.join(silver, EVENT_DATE, "left_anti")

    def thresholds(self, spec: StreamSpec) -> DataFrame:
        return baseline(self.gold(spec), spec)

    def flagged(self, spec: StreamSpec) -> DataFrame:
        return flagged_hours(self.gold(spec), self.thresholds(spec), spec)

    def refresh_baseline(
        self, spec: StreamSpec, min_hours: int = 1, percentile: float | None = None
    ) -> tuple[DataFrame, DataFrame]:
        """Stores all thresholds and all flagged hours; returns the written tables.

        ``percentile`` (0 to 1) takes that share of the history as the threshold in place
        of mean and deviation; ``min_hours`` asks for that much history.
        """
        size_for(self.spark, self.gold_path(spec))
        hours = self.gold(spec)
        if percentile is None:
            thresholds = baseline(hours, spec, min_hours)
        else:
            thresholds = percentile_baseline(hours, spec, percentile, min_hours)
        path = self.path("baseline", f"{spec.name}_thresholds")
        replace_table(thresholds, path, self.table_format)
        stored = self._read(path, thresholds.schema)
        flagged = flagged_hours(hours, stored, spec)
        return stored, self.store(flagged, "baseline", f"{spec.name}_flagged")

    def _figures_path(self, spec: StreamSpec) -> str:
        return self.path("baseline", f"{spec.name}_days")

    def baseline_days(self, spec: StreamSpec) -> DataFrame:
        """Stored figures of each entity's days, which merge into its baseline."""
        no_gold = self.gold(spec).limit(0)
        schema = day_figures(no_gold, spec, EVENT_DATE).schema
        return self._read(self._figures_path(spec), schema)

    def refresh_baseline_days(
        self,
        spec: StreamSpec,
        first_date: str | None = None,
        last_date: str | None = None,
        min_hours: int = 1,
    ) -> DataFrame:
        """Thresholds after some days of Gold have changed, from those days alone.

        Each entity and day has one stored row (hours, mean, sum of squared deviations); those
        of the range are made anew from Gold's days, all others are only merged. Without a
        range all days are, those without a time among them. Returns the stored thresholds.
        """
        self._refresh_days(spec, first_date, last_date, day_figures, self._figures_path(spec))
        merged = thresholds_of_days(self.baseline_days(spec), spec, EVENT_DATE, min_hours)
        return self.store(merged, "baseline", f"{spec.name}_thresholds")

    def _sketches_path(self, spec: StreamSpec) -> str:
        return self.path("baseline", f"{spec.name}_sketches")

    def percentile_days(self, spec: StreamSpec) -> DataFrame:
        """Stored sketches of each entity's days, which merge into its percentiles."""
        schema = day_sketches(self.gold(spec).limit(0), spec, EVENT_DATE).schema
        return self._read(self._sketches_path(spec), schema)

    def refresh_percentile_days(
        self,
        spec: StreamSpec,
        first_date: str | None = None,
        last_date: str | None = None,
        share: float = 0.95,
        min_hours: int = 1,
    ) -> DataFrame:
        """Percentile thresholds after some days of Gold have changed, from those days alone.

        As :meth:`refresh_baseline_days`, with a sketch of rates per entity and day. Any other
        share of the history comes from the same stored sketches.
        """
        self._refresh_days(spec, first_date, last_date, day_sketches, self._sketches_path(spec))
        merged = thresholds_of_sketches(self.percentile_days(spec), spec, share, min_hours)
        return self.store(merged, "baseline", f"{spec.name}_thresholds")

    def _refresh_days(
        self,
        spec: StreamSpec,
        first_date: str | None,
        last_date: str | None,
        figures_of: Callable[[DataFrame, StreamSpec, str], DataFrame],
        path: str,
    ) -> None:
        """Makes the stored rows of some days of Gold anew; days that Gold has lost go."""
        size_for(self.spark, self.gold_path(spec))
        figures = figures_of(self.gold(spec, first_date, last_date), spec, EVENT_DATE)
        whole = first_date is None and last_date is None
        if whole or not table_exists(self.spark, path):
            replace_table(figures, path, self.table_format, [EVENT_DATE])
            return
        own = self._gold_days(spec, first_date, last_date).select(EVENT_DATE).distinct()
        kept = {str(row[0]) for row in own.collect()}
        stored = _of_days(self._read(path, figures.schema), first_date, last_date)
        days = {str(row[0]) for row in stored.select(EVENT_DATE).distinct().collect()}
        replace_partitions(figures, path, [EVENT_DATE], self.table_format)
        remove_partitions(self.spark, path, EVENT_DATE, days - kept, self.table_format)

    def store(self, rows: DataFrame, layer: str, name: str) -> DataFrame:
        """Replaces a table that holds the complete ``rows``; returns it."""
        path = self.path(layer, name)
        replace_table(rows, path, self.table_format)
        return self._read(path, rows.schema)


def _by_day(rows: DataFrame, time: str) -> DataFrame:
    """Rows with their date, arranged for a write by day.

    The rebalance gathers a day's rows into files of the advisory size and spreads a
    large day over many tasks.
    """
    return rows.withColumn(EVENT_DATE, F.to_date(time)).hint("rebalance", EVENT_DATE)


def _on_days(rows: DataFrame, column: str, days: list) -> DataFrame:
    dated = [F.lit(str(day)).cast("date") for day in days if day is not None]
    on_one = F.col(column).isin(*dated) if dated else F.lit(False)
    return rows.where(on_one | F.col(column).isNull() if None in days else on_one)


def _of_days(rows: DataFrame, first_date: str | None, last_date: str | None) -> DataFrame:
    if first_date is not None:
        rows = rows.where(F.col(EVENT_DATE) >= F.lit(first_date).cast("date"))
    if last_date is not None:
        rows = rows.where(F.col(EVENT_DATE) <= F.lit(last_date).cast("date"))
    return rows
