"""Ad-hoc questions about payments, asked of Bronze.

Bronze is unfiltered, so malformed and duplicate records count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.rounding import round2


def total_events(bronze: DataFrame) -> DataFrame:
    return bronze.agg(F.count("*").alias("total_events"))


def failures_by_merchant(bronze: DataFrame) -> DataFrame:
    """Number of failed payments per merchant, most first."""
    return (
        bronze.where("status = 'failed'")
        .groupBy("merchant_id")
        .agg(F.count("*").alias("failures"))
        .orderBy(F.desc("failures"), "merchant_id")
    )


def volume_by_currency(bronze: DataFrame) -> DataFrame:
    """Completed payments per currency, highest volume first."""
    return (
        bronze.where("status = 'completed'")
        .groupBy("currency")
        .agg(
            F.count("*").alias("transactions"),
            F.expr(round2("sum(amount)")).alias("total_volume"),
            F.expr(round2("avg(amount)")).alias("avg_amount"),
        )
        .orderBy(F.desc("total_volume"), "currency")
    )


def status_breakdown(bronze: DataFrame) -> DataFrame:
    """Number of payments per merchant and status."""
    return (
        bronze.groupBy("merchant_id", "status")
        .agg(F.count("*").alias("count"))
        .orderBy("merchant_id", "status")
    )
