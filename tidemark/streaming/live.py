"""Patterns and anomalies while events arrive."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo,
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)

from tidemark.functions.times import parse_event_time
from tidemark.operators.baseline import THRESHOLD
from tidemark.operators.cleaning import accepted
from tidemark.operators.journeys import CART_WAIT
from tidemark.operators.patterns import ESCALATION
from tidemark.plans.streams import HOUR, SYSTEM_LOGS, USER_EVENTS, StreamSpec
from tidemark.streaming.windows import DEFAULT_LATENESS, windowed

MATCH = "service string, event_id string, partition int, offset bigint"
TAIL = "offset bigint, codes array<int>"


class PatternProcessor(StatefulProcessor):
    """Ends of a pattern in the log of one entity and partition, whole batches at once.

    Of a micro-batch it holds offset and code of each record, and the ids of those that can
    end the pattern; how much a batch may be is set at its source. The state is the last
    codes and the last offset.
    """

    def __init__(self, pattern: tuple[int, ...], quiet_days: int | None) -> None:
        self.pattern, self.quiet_days = np.array(pattern), quiet_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        lifetime = None if self.quiet_days is None else self.quiet_days * 86_400_000
        self.tail = handle.getValueState("tail", TAIL, ttlDurationMs=lifetime)

    def handleInputRows(
        self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues
    ) -> Iterator[pd.DataFrame]:
        offsets, codes, ends = [], [], []
        for frame in rows:
            offsets.append(frame["offset"].to_numpy())
            codes.append(frame["code"].to_numpy())
            ends.append(frame.loc[frame["code"] == self.pattern[-1], ["offset", "event_id"]])
        last, before = self.tail.get() if self.tail.exists() else (-1, [])
        offset, place = np.unique(np.concatenate(offsets), return_index=True)
        code = np.concatenate(codes)[place][offset > last]
        offset = offset[offset > last]
        if not len(offset):
            return
        run = np.concatenate([np.array(before, code.dtype), code])
        reach = len(self.pattern) - 1
        size = max(len(run) - reach, 0)
        matched = np.ones(size, bool)
        for shift, wanted in enumerate(self.pattern):
            matched &= run[shift : shift + size] == wanted
        found = offset[len(offset) - size :][matched] if size else offset[:0]
        self.tail.update((int(offset[-1]), [int(c) for c in run[len(run) - min(reach, len(run)) :]]))
        if len(found):
            ids = pd.concat(ends).drop_duplicates("offset").set_index("offset")["event_id"]
            texts = {"service": [key[0]] * len(found), "event_id": ids.loc[found].tolist()}
            named = {name: pd.Series(column, dtype=object) for name, column in texts.items()}
            yield pd.DataFrame({**named, "partition": key[1], "offset": found})

    def close(self) -> None:
        pass


def live_escalations(
    bronze: DataFrame, pattern: tuple[str, ...] = ESCALATION, quiet_days: int | None = None
) -> DataFrame:
    """Errors that directly follow three warnings of the same service, on a stream.

    State is kept per service and partition, within which the log has an order; records of
    a micro-batch are put in order of their offsets, and patterns that run over batches are
    found. A record at or before the last offset was seen already. Copies of an event
    at other offsets count as events; the table form works on Silver, which has none.

    With ``quiet_days`` the state of a service that is quiet for so long expires. That goes by
    the clock, for which Spark runs batches without an end: it suits a job that never stops,
    not one that takes what is available.
    """
    names = list(dict.fromkeys(pattern))
    code = F.array_position(F.array(*map(F.lit, names)), F.col("level")).cast("int")
    rows = accepted(bronze, SYSTEM_LOGS).where("partition is not null and offset is not null")
    return (
        rows.select("service", "partition", "offset", code.alias("code"), "event_id")
        .groupBy("service", "partition")
        .transformWithStateInPandas(
            PatternProcessor(tuple(names.index(level) + 1 for level in pattern), quiet_days),
            MATCH,
            "Append",
            "None" if quiet_days is None else "ProcessingTime",
        )
    )


CART = "user_id string, added_at timestamp"
PENDING = "added array<bigint>, bought array<bigint>"


class CartProcessor(StatefulProcessor):
    """Carts of one user that time out, by event-time timers.

    The state holds the times of events that may still decide on a cart, those of the last
    ``wait`` before the watermark and all after it.
    """

    def __init__(self, wait_seconds: int) -> None:
        self.wait = wait_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getValueState("pending", PENDING)

    def known(self) -> tuple[np.ndarray, np.ndarray]:
        added, bought = self.pending.get() if self.pending.exists() else ([], [])
        return np.array(added, np.int64), np.array(bought, np.int64)

    def keep(self, added: np.ndarray, bought: np.ndarray) -> None:
        """Stores what is undecided, with a timer for the first cart that can time out."""
        if not len(added) and not len(bought):
            self.pending.clear()
            return
        self.pending.update((added.tolist(), bought.tolist()))
        # Purchases alone wait for late carts, and go when the watermark has passed them.
        first = int(added[0]) if len(added) else int(bought[-1])
        self.handle.registerTimer(-(-(first + self.wait) // 1000))

    def handleInputRows(
        self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues
    ) -> Iterator[pd.DataFrame]:
        added, bought = self.known()
        for frame in rows:
            at, purchase = frame["at"].to_numpy(), frame["purchase"].to_numpy().astype(bool)
            added = np.union1d(added, at[~purchase])
            bought = np.union1d(bought, at[purchase])
        self.keep(added, bought)
        yield from ()

    def handleExpiredTimer(
        self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo
    ) -> Iterator[pd.DataFrame]:
        added, bought = self.known()
        decided = timerValues.getCurrentWatermarkInMs() * 1000 - self.wait
        due = added[added <= decided]
        others = np.union1d(added, bought)
        following = np.searchsorted(others, due, "right")
        after = np.append(others, np.iinfo(np.int64).max)[following]
        left = (after - due > self.wait) & ~np.isin(due, bought)
        self.keep(added[added > decided], bought[bought > decided])
        if left.any():
            users = pd.Series([key[0]] * int(left.sum()), dtype=object)
            yield pd.DataFrame({"user_id": users, "added_at": pd.to_datetime(due[left], unit="us")})

    def close(self) -> None:
        pass


def live_expired_carts(
    bronze: DataFrame, wait_seconds: int = CART_WAIT, lateness: str = DEFAULT_LATENESS
) -> DataFrame:
    """Carts that saw nothing more within the wait, as soon as no event can change that.

    The rows of :func:`tidemark.operators.journeys.expired_carts`, up to the watermark: a cart
    is given out once the watermark passes the end of its wait. Copies of an event have its
    time and change nothing.
    """
    rows = accepted(bronze, USER_EVENTS).withColumn("event_timestamp", parse_event_time("timestamp"))
    timed = rows.where(F.col("event_timestamp").isNotNull()).withWatermark("event_timestamp", lateness)
    return (
        timed.where(F.col("event_type").isin("add_to_cart", "purchase"))
        .select(
            "user_id",
            "event_timestamp",
            F.unix_micros("event_timestamp").alias("at"),
            (F.col("event_type") == "purchase").alias("purchase"),
        )
        .groupBy("user_id")
        .transformWithStateInPandas(CartProcessor(wait_seconds), CART, "Append", "EventTime")
    )


def live_flagged_hours(
    bronze: DataFrame, thresholds: DataFrame, spec: StreamSpec, lateness: str = DEFAULT_LATENESS
) -> DataFrame:
    """Hours above their entity's stored threshold, as soon as they are final.

    ``thresholds`` is a table, read anew for every micro-batch; it has a row per entity,
    and whether it is broadcast is left to its size.
    """
    hours = windowed(bronze, spec, "1 hour", lateness).withColumnRenamed("window_start", HOUR)
    known = hours.join(thresholds.select(*spec.entities, THRESHOLD), spec.entities)
    total = next(iter(spec.measures))
    return known.where(F.col(spec.rate) > F.col(THRESHOLD)).select(
        *spec.entities, HOUR, spec.rate, THRESHOLD, total
    )


def live_signals(
    streams: list[tuple[DataFrame, DataFrame, StreamSpec]], lateness: str = DEFAULT_LATENESS
) -> DataFrame:
    """One feed of flagged hours over several streams: ``stream, entity, hour, rate``.

    :func:`tidemark.streaming.incidents.live_incidents` joins the streams hour by hour.
    """
    feeds = [
        live_flagged_hours(bronze, thresholds, spec, lateness).select(
            F.lit(spec.name).alias("stream"),
            F.concat_ws("/", *spec.entities).alias("entity"),
            HOUR,
            F.col(spec.rate).alias("rate"),
        )
        for bronze, thresholds, spec in streams
    ]
    found = feeds[0]
    for feed in feeds[1:]:
        found = found.unionByName(feed)
    return found
