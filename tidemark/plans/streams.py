"""What differs between event streams, stated as data.

A :class:`StreamSpec` names a stream's fields, the rows that Silver accepts and the
hourly metrics of Gold. All layers are written once against it; a further stream
needs a further spec and no further pipeline. Rules and metrics are Spark SQL text,
so that a spec can be declared before any session exists.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from tidemark.functions.rounding import percent, round2

HOUR = "hour"


@dataclass(frozen=True)
class Measure:
    """An aggregate of Gold, and what merges its values over parts.

    ``merge`` is the aggregate that makes the whole's value of those of its parts. Where these
    do not determine it (an average), ``states`` are further aggregates by column name, all
    sums, which Gold stores in the measure's place, and ``finish`` gives the value from them.
    With neither, a longer span has to be computed from Silver.
    """

    sql: str
    merge: str | None = None
    states: tuple[tuple[str, str], ...] = ()
    finish: str | None = None


@dataclass(frozen=True)
class StreamSpec:
    name: str
    topic: str
    # Event fields in order, as (name, SQL type).
    fields: tuple[tuple[str, str], ...]
    # Field whose value keys the log, so that its events stay in order.
    key: str
    # Fields without which an event is unusable.
    required: tuple[str, ...]
    # Conditions an event must meet; one that evaluates to NULL is not met.
    rules: tuple[str, ...]
    # Gold grouping in output order: ``hour`` and the columns that name the entity.
    grain: tuple[str, ...]
    # Gold aggregates by output column.
    measures: dict[str, Measure]
    # Gold ratios over measures: output column -> SQL expression.
    rates: dict[str, str] = field(default_factory=dict)

    @property
    def ddl(self) -> str:
        return ", ".join(f"{name} {kind}" for name, kind in self.fields)

    @property
    def field_names(self) -> list[str]:
        return [name for name, _ in self.fields]

    @property
    def entities(self) -> list[str]:
        """The columns that together name an entity."""
        return [column for column in self.grain if column != HOUR]

    @property
    def unmergeable(self) -> list[str]:
        """Measures that a longer span needs Silver for."""
        return [
            name
            for name, measure in self.measures.items()
            if measure.merge is None and not measure.states
        ]

    @property
    def states(self) -> dict[str, tuple[str, str | None]]:
        """What Gold stores, by column: the aggregate over events, and that over parts."""
        found: dict[str, tuple[str, str | None]] = {}
        for name, measure in self.measures.items():
            if measure.states:
                found |= {column: (sql, "sum") for column, sql in measure.states}
            else:
                found[name] = (measure.sql, measure.merge)
        return found

    @property
    def rate(self) -> str:
        """The stream's one health rate, which its baseline watches."""
        if len(self.rates) != 1:
            raise ValueError(f"stream {self.name} has no single rate: {sorted(self.rates)}")
        return next(iter(self.rates))


def one_of(column: str, values: Iterable[str]) -> str:
    return f"{column} in ({', '.join(repr(value) for value in values)})"


def within(column: str, low: float, high: float) -> str:
    return f"{column} between {low} and {high}"


def finite(column: str) -> str:
    """An extra rule for streams that must not hold NaN or infinity.

    The shipped streams do without: NaN compares greater than any number and so passes
    a lower bound.
    """
    return f"abs({column}) < double('infinity')"


def rows() -> Measure:
    return Measure("count(*)", "sum")


def rows_where(condition: str) -> Measure:
    return Measure(f"count_if({condition})", "sum")


def average(column: str) -> Measure:
    """The mean to two decimals, kept as sum and count."""
    total, count = f"{column}_sum", f"{column}_count"
    return Measure(
        round2(f"avg({column})"),
        states=((total, f"sum({column})"), (count, f"count({column})")),
        finish=round2(f"{total} / nullif({count}, 0)"),
    )


# Fixed values from here on: topics, fields, keys, accepted categories and metric names of
# the three streams.
PAYMENTS_TOPIC = "raw-payments"
USER_EVENTS_TOPIC = "raw-user-events"
SYSTEM_LOGS_TOPIC = "raw-system-logs"
CURRENCIES = ("USD", "CAD", "EUR", "GBP")
PAYMENT_STATUSES = ("completed", "failed", "pending")
USER_EVENT_TYPES = ("page_view", "click", "signup", "add_to_cart", "checkout", "purchase")
DEVICES = ("mobile", "desktop", "tablet")
LOG_LEVELS = ("INFO", "WARN", "ERROR")

PAYMENTS = StreamSpec(
    name="payments",
    topic=PAYMENTS_TOPIC,
    fields=(
        ("event_id", "string"),
        ("merchant_id", "string"),
        ("user_id", "string"),
        ("amount", "double"),
        ("currency", "string"),
        ("status", "string"),
        ("timestamp", "string"),
    ),
    key="merchant_id",
    required=("event_id", "merchant_id", "amount", "status"),
    rules=(
        "amount > 0",
        one_of("currency", CURRENCIES),
        one_of("status", PAYMENT_STATUSES),
    ),
    grain=("merchant_id", HOUR),
    measures={
        "total_transactions": rows(),
        "completed_count": rows_where("status = 'completed'"),
        "failed_count": rows_where("status = 'failed'"),
        "completed_volume": Measure("sum(if(status = 'completed', amount, 0D))", "sum"),
    },
    rates={"failure_rate_pct": percent("failed_count", "total_transactions")},
)

USER_EVENTS = StreamSpec(
    name="user_events",
    topic=USER_EVENTS_TOPIC,
    fields=(
        ("event_id", "string"),
        ("user_id", "string"),
        ("session_id", "string"),
        ("event_type", "string"),
        ("page", "string"),
        ("device", "string"),
        ("timestamp", "string"),
    ),
    key="user_id",
    required=("event_id", "user_id", "event_type"),
    rules=(
        one_of("event_type", USER_EVENT_TYPES),
        one_of("device", DEVICES),
    ),
    grain=(HOUR, "device"),
    measures={
        "total_events": rows(),
        "page_views": rows_where("event_type = 'page_view'"),
        "add_to_carts": rows_where("event_type = 'add_to_cart'"),
        "checkouts": rows_where("event_type = 'checkout'"),
        "purchases": rows_where("event_type = 'purchase'"),
    },
)

SYSTEM_LOGS = StreamSpec(
    name="system_logs",
    topic=SYSTEM_LOGS_TOPIC,
    fields=(
        ("event_id", "string"),
        ("service", "string"),
        ("level", "string"),
        ("message", "string"),
        ("latency_ms", "double"),
        ("cpu_percent", "double"),
        ("memory_percent", "double"),
        ("timestamp", "string"),
    ),
    key="service",
    required=("event_id", "service", "level", "latency_ms"),
    rules=(
        one_of("level", LOG_LEVELS),
        "latency_ms >= 0",
        within("cpu_percent", 0, 100),
        within("memory_percent", 0, 100),
    ),
    grain=("service", HOUR),
    measures={
        "total_logs": rows(),
        "info_count": rows_where("level = 'INFO'"),
        "warn_count": rows_where("level = 'WARN'"),
        "error_count": rows_where("level = 'ERROR'"),
        "avg_latency_ms": average("latency_ms"),
        "max_latency_ms": Measure(round2("max(latency_ms)"), "max"),
        "avg_cpu_percent": average("cpu_percent"),
    },
    rates={"error_rate_pct": percent("error_count", "total_logs")},
)

STREAMS = {spec.name: spec for spec in (PAYMENTS, USER_EVENTS, SYSTEM_LOGS)}
