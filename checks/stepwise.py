"""What sharing work is worth: Silver with one job per step, beside Silver in one run.

    python -m checks.stepwise [events folder]

The stepwise form counts after every step and then writes, recomputing the lineage each
time. Both forms end with the same table and the same counts.
"""

from __future__ import annotations

import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from checks.mapping import bronze_rows
from tidemark.operators.cleaning import accepted, clean, is_usable
from tidemark.plans.layers import Lakehouse
from tidemark.plans.streams import STREAMS, StreamSpec
from tidemark.session import build_session, scratch_path
from tidemark.sources.tables import replace_table


def stepwise(lake: Lakehouse, spec: StreamSpec) -> tuple[int, ...]:
    bronze = lake.bronze(spec)
    silver: DataFrame = clean(bronze, spec)
    counts = (
        bronze.count(),
        bronze.where(is_usable(spec)).count(),
        accepted(bronze, spec).count(),
        silver.count(),
    )
    replace_table(silver, f"{lake.silver_path(spec)}_stepwise")
    silver.take(5)
    return counts


def in_one_run(lake: Lakehouse, spec: StreamSpec) -> tuple[int, ...]:
    return tuple(lake.refresh_silver(spec).first())[:4]


def seconds(run, lake: Lakehouse, spec: StreamSpec) -> tuple[float, tuple[int, ...]]:
    started = time.perf_counter()
    counts = run(lake, spec)
    return time.perf_counter() - started, counts


def main(sf_dir: str) -> None:
    spark: SparkSession = build_session(
        "tidemark-stepwise",
        settings={
            "spark.master": f"local[{os.environ.get('BENCH_CPUS', '8')}]",
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": "32",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    lake = Lakehouse(spark, scratch_path(spark, "stepwise"))
    for spec in STREAMS.values():
        replace_table(bronze_rows(spark, sf_dir, spec.name), lake.bronze_path(spec))
        for run in (stepwise, in_one_run):
            seconds(run, lake, spec)
        steps, counts = seconds(stepwise, lake, spec)
        once, same = seconds(in_one_run, lake, spec)
        assert counts == same, (counts, same)
        print(f"{spec.name}: {steps:.2f} s stepwise, {once:.2f} s in one run, rows {counts}")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
