"""Shop streams, orders and refunds, as further specs of the same pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions.rounding import percent
from tidemark.plans.streams import HOUR, StreamSpec, one_of, rows, rows_where

ORDER_STATES = ("O", "F", "P")
LINE_STATES = ("R", "A", "N")
#: The state of a line that was sent back.
REFUNDED = "R"

ORDERS = StreamSpec(
    name="orders",
    topic="shop-orders",
    fields=(
        ("event_id", "string"),
        ("customer_id", "bigint"),
        ("state", "string"),
        ("total", "double"),
        ("timestamp", "string"),
    ),
    key="customer_id",
    required=("event_id", "customer_id", "total"),
    # An order over nothing is a fault of the shop, not a sale.
    rules=("total > 0", one_of("state", ORDER_STATES)),
    grain=("customer_id", HOUR),
    measures={"orders": rows()},
    rates={"order_volume": "cast(orders as double)"},
)

REFUNDS = StreamSpec(
    name="refunds",
    topic="shop-lines",
    fields=(
        ("event_id", "string"),
        ("order_id", "bigint"),
        ("part_id", "bigint"),
        ("state", "string"),
        ("quantity", "double"),
        ("timestamp", "string"),
    ),
    key="part_id",
    required=("event_id", "order_id", "part_id", "state"),
    rules=("quantity > 0", one_of("state", LINE_STATES)),
    grain=("part_id", HOUR),
    measures={"lines": rows(), "refunds": rows_where(f"state = '{REFUNDED}'")},
    rates={"refund_rate_pct": percent("refunds", "lines")},
)


def orphans(rows_: DataFrame, parents: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Rows whose ``key`` is no ``parent_key``; a missing key has no parent."""
    return rows_.join(parents, rows_[key] == parents[parent_key], "left_anti")
