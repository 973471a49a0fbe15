"""One-line, human readable renderings of events for the unified feed.

Every builder takes a ``field`` resolver, so the same line works on top-level
Bronze columns and on the fields of a struct parsed from a log record.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Markers and labels of the feed's lines.
PAYMENT_HEAD = "💳 PAYMENT  "
USER_HEAD = "👤 USER     "
SYSTEM_LABEL = " SYSTEM   "
LEVEL_MARKS = {"INFO": "🟢", "WARN": "🟡", "ERROR": "🔴"}
UNKNOWN_LEVEL_MARK = "⚪"
SEPARATOR = " | "
ABSENT = "None"
PARTITION_LABEL = "← partition="
OFFSET_LABEL = " offset="
LATENCY_LABEL = "latency="

Field = Callable[[str], Column]


def number_text(value: Column) -> Column:
    """Text of a double: positional from 1e-4 up to 1e16, else scientific (``5e-05``).

    A cast to string is positional only from 1e-3 up to 1e7; around that range
    the digits come from a decimal, less its trailing zeros. Beyond 1e-4 .. 1e16
    the cast's exponent gets a sign and two digits at least.
    """
    size = F.abs(value)
    parts = F.split(F.regexp_replace(value.cast("string"), "[.]0E", "E"), "E")
    power = parts[1].cast("int")
    figures = F.abs(power).cast("string")
    exponent = F.concat(
        F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.length(figures) < 2, F.concat(F.lit("0"), figures)).otherwise(figures),
    )
    infinite = F.when(value > 0, F.lit("inf")).otherwise(F.lit("-inf"))
    special = F.when(F.isnan(value), F.lit("nan")).otherwise(infinite)
    digits = F.regexp_replace(value.try_cast("decimal(38,20)").cast("string"), "0+$", "")
    positional = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    return (
        F.when((size == 0) | ((size >= 1e-3) & (size < 1e7)), value.cast("string"))
        .when((size >= 1e-4) & (size < 1e16), positional)
        .when(size < float("inf"), F.concat(parts[0], exponent))
        .when(value.isNotNull(), special)
    )


def _shown(value: Column) -> Column:
    return F.coalesce(value, F.lit(ABSENT))


def _joined(head: Column, *parts: Column) -> Column:
    return F.concat_ws(SEPARATOR, head, *[_shown(part) for part in parts])


def _money(field: Field) -> Column:
    amount = _shown(number_text(field("amount")))
    return F.concat(F.lit("$"), amount, F.lit(" "), _shown(field("currency")))


def payment_line(field: Field) -> Column:
    status = F.upper(field("status"))
    return _joined(F.lit(PAYMENT_HEAD), field("merchant_id"), _money(field), status)


def user_event_line(field: Field) -> Column:
    shown = [field(name) for name in ("user_id", "event_type", "page", "device")]
    return _joined(F.lit(USER_HEAD), *shown)


def system_log_line(field: Field) -> Column:
    level = field("level")
    mark = F.lit(UNKNOWN_LEVEL_MARK)
    for known, symbol in LEVEL_MARKS.items():
        mark = F.when(level == known, F.lit(symbol)).otherwise(mark)
    latency = F.concat(F.lit(LATENCY_LABEL), _shown(number_text(field("latency_ms"))), F.lit("ms"))
    head = F.concat(mark, F.lit(SYSTEM_LABEL))
    return _joined(head, field("service"), level, field("message"), latency)


def payment_trace_line(field: Field) -> Column:
    """A payment with its place in the log, for watching a topic."""
    place = F.concat(
        F.lit(PARTITION_LABEL),
        _shown(field("partition").cast("string")),
        F.lit(OFFSET_LABEL),
        _shown(field("offset").cast("string")),
    )
    return _joined(place, field("merchant_id"), _money(field), field("status"))
