"""Rounding of floating point aggregates.

``avg`` and ``sum`` over doubles carry noise in their last digits, and the noise
depends on the order in which partitions are merged. A mean that lies exactly on
a rounding boundary would therefore round up in one run and down in the next. The
forms here first settle the value to ten decimals, where the noise is gone, and
round that half-up.
"""

from __future__ import annotations


def round2(expression: str) -> str:
    """SQL text that rounds a double half-up to two decimals.

    NaN, infinities and magnitudes beyond 28 integer digits do not fit a decimal;
    ``try_cast`` yields NULL for those and the plain ``round`` takes over, so they
    come through unchanged. The text is valid in Spark SQL and in ANSI engines
    with ``try_cast``.
    """
    settled = f"round(try_cast({expression} as decimal(38, 10)), 2)"
    return f"coalesce(cast({settled} as double), round({expression}, 2))"


def percent(part: str, total: str) -> str:
    """SQL text for ``part`` of ``total`` in percent, two decimals, as a double.

    Both operands are counts, so the quotient does not depend on any order and a
    plain ``round`` is already repeatable.
    """
    return f"round({part} / {total} * 100, 2)"
