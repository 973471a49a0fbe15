"""Event time helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_event_time(column: str) -> Column:
    """Timestamp of a text column, NULL where the text is no timestamp.

    ISO-8601 with an offset names an instant; text without one is read in the
    session time zone (UTC in sessions from :mod:`tidemark.session`).
    """
    return F.try_to_timestamp(F.col(column))
