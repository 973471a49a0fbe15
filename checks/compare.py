"""Runs registered queries beside their SQL counterparts and compares the results.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracles import all_oracles
from checks.queries import all_queries


def sql_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


# Column types of Spark results and their SQL names.
SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


# Queries that promise the order of their rows.
ORDERED = (
    "payments_flagged_hours",
    "layers_flagged_hours",
    "payments_top_failure_hours",
    "system_logs_top_error_hours",
    "report_failures_by_merchant",
    "report_volume_by_currency",
    "report_status_breakdown",
)


def normal_form(rows: pd.DataFrame) -> list[tuple]:
    """Rows as tuples in their order, columns in name order, missing values alike."""
    ordered = rows[sorted(rows.columns)]
    return [
        tuple("NULL" if pd.isna(value) else str(value) for value in row)
        for row in ordered.astype(object).itertuples(index=False, name=None)
    ]


def row_differences(left: list, right: list, in_order: bool = False) -> tuple[list, list]:
    """Rows that only one side has, counting repeats; all from the first one out of order."""
    ours, theirs = Counter(left), Counter(right)
    only_left = sorted((ours - theirs).elements())
    only_right = sorted((theirs - ours).elements())
    if in_order and not only_left and not only_right and left != right:
        first = next(i for i, (a, b) in enumerate(zip(left, right)) if a != b)
        return left[first:], right[first:]
    return only_left, only_right


def differences(spark: SparkSession, sf_dir: str, name: str) -> tuple[int, list, list]:
    """Row count, what only Spark's result has, what only the SQL result has.

    Columns that differ in name or type are reported in place of rows.
    """
    tables, sql = sql_tables(sf_dir), all_oracles()[name]
    ours = all_queries()[name](spark, sf_dir)
    our_types = {(column, SQL_TYPES.get(kind, kind)) for column, kind in ours.dtypes}
    their_types = {row[:2] for row in tables.execute(f"describe {sql}").fetchall()}
    if our_types != their_types:
        return -1, sorted(our_types - their_types), sorted(their_types - our_types)
    left, right = normal_form(ours.toPandas()), normal_form(tables.execute(sql).fetchdf())
    return len(left), *row_differences(left, right, name in ORDERED)


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names or list(all_queries()):
        started = time.time()
        rows, extra, missing = differences(spark, sf_dir, name)
        same = not extra and not missing and rows >= 0
        failed += not same
        print(f"{'ok  ' if same else 'DIFF'} {name} {rows} rows {time.time() - started:.2f}s")
        for label, some in (("spark", extra[:3]), ("sql", missing[:3])):
            for row in some:
                print("   ", label, row)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
