"""How long each stream's raw events are kept."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from tidemark.plans.streams import PAYMENTS, SYSTEM_LOGS

# Retention per stream; streams not named are kept.
RETENTION = {PAYMENTS.name: "7 days", SYSTEM_LOGS.name: "24 hours"}


def first_kept_date(stream: str, as_of: str) -> date | None:
    """The day before which no record of the stream is kept any more, if there is one.

    A day of which some hours are still kept stays; :func:`retained` cuts those exactly.
    """
    age = RETENTION.get(stream)
    if age is None:
        return None
    number, unit = age.split()
    return (datetime.fromisoformat(as_of) - timedelta(**{unit: int(number)})).date()


def retained(bronze: DataFrame, stream: str, as_of: str) -> DataFrame:
    """Rows that the log still holds at ``as_of``.

    The cut-off is a constant, so columnar files outside it are skipped by their
    statistics.
    """
    age = RETENTION.get(stream)
    if age is None:
        return bronze
    cut = F.expr(f"timestamp '{as_of}' - interval {age}")
    return bronze.where(F.col("kafka_timestamp") >= cut)
