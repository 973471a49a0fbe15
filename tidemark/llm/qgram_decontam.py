"""Benchmark decontamination by the q-gram lemma.

A passage of ``m`` bytes found in a text with at most ``e`` edits shares at least
``m + 1 - q * (e + 1)`` q-grams with it, on diagonals (text position less passage
position) that span no more than ``e + 1`` values. Shared q-grams are counted per passage
in overlapping bands of ``2 * (e + 1)`` diagonals, every ``e + 1``, so that one band holds
them all. Bands that meet the bound are verified by banded alignment, which gives the
exact number of edits.

Texts and passages are compared as UTF-8 bytes with A-Z in lower case and white space
collapsed. The passages are sent to the tasks in blocks of bounded size; each block takes
one pass over the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import IS_SPACE, LOWER, Powers, pieces

Q = 10
#: Edits allowed per byte of a passage.
EDIT_RATE = 0.08
#: Bytes from which on an item is a passage that can identify its source.
LEAST_BYTES = 10
#: Bytes of passages sent to the tasks at once.
BLOCK_BYTES = 4 << 20
#: Pairs of text and passage positions looked at together.
PAIRS = 2_000_000
FILTER_BITS = 22

FOLDED = LOWER.copy()
FOLDED[IS_SPACE] = 32


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes without second white space, and the new row offsets."""
    space = IS_SPACE[data]
    keep = np.ones(len(data), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    keep[offsets[:-1][offsets[:-1] < len(data)]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return FOLDED[data[keep]], kept[offsets]


def budget(length: int, rate: float) -> int:
    """Edits allowed in a passage."""
    return int(rate * length)


def own_q(length: int, q: int, rate: float) -> int:
    """``q``, or for a short passage the largest with which the lemma asks for a shared q-gram."""
    return max(1, min(q, length // (budget(length, rate) + 1)))


class Passages:
    """Index of the q-grams of a block of passages."""

    def __init__(self, items: list[tuple[int, bytes]], q: int = Q, rate: float = EDIT_RATE) -> None:
        self.q = q
        self.items = items
        self.length = np.array([len(data) for _, data in self.items], np.int64)
        self.edits = np.array([budget(n, rate) for n in self.length], np.int64)
        self.least = self.length + 1 - q * (self.edits + 1)
        powers = Powers()
        keys, item, place = [], [], []
        for number, (_, data) in enumerate(self.items):
            grams = powers.rolling(powers.prefix(np.frombuffer(data, np.uint8)), q)
            keys.append(grams)
            item.append(np.full(len(grams), number))
            place.append(np.arange(len(grams)))
        keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.item = np.concatenate(item)[order] if item else np.zeros(0, np.int64)
        self.place = np.concatenate(place)[order] if place else np.zeros(0, np.int64)
        self.keys, self.first = np.unique(keys[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(keys)))
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.keys >> np.uint64(64 - FILTER_BITS)] = True

    def hits(self, data: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple:
        """Text positions whose q-gram some passage has, and its number in ``keys``."""
        grams = powers.rolling(powers.prefix(data), self.q)
        if not len(grams) or not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.filter[grams >> np.uint64(64 - FILTER_BITS)])
        key = np.minimum(np.searchsorted(self.keys, grams[at]), len(self.keys) - 1)
        row = np.searchsorted(offsets, at, "right")
        true = (self.keys[key] == grams[at]) & (at + self.q <= offsets[row])
        return at[true], key[true]

    def bands(self, at: np.ndarray, key: np.ndarray, offsets: np.ndarray) -> tuple:
        """Row, passage and band number of bands that meet the lemma's bound, with counts."""
        empty = np.zeros((0, 3), np.int64)
        found, counts = empty, np.zeros(0, np.int64)
        pairs = np.cumsum(self.count[key])
        start = 0
        while start < len(at):
            before = pairs[start - 1] if start else 0
            stop = max(int(np.searchsorted(pairs, before + PAIRS, "right")), start + 1)
            n = self.count[key[start:stop]]
            source = np.repeat(np.arange(start, stop), n)
            within = np.arange(len(source)) - np.repeat(np.cumsum(n) - n, n)
            entry = self.first[key[source]] + within
            item = self.item[entry]
            row = np.searchsorted(offsets, at[source], "right") - 1
            # Diagonals are counted from the row's first byte, so a text's bands are its own.
            band = (at[source] - offsets[row] - self.place[entry]) // (self.edits[item] + 1)
            twice = np.concatenate(
                [np.stack([row, item, band], axis=1), np.stack([row, item, band - 1], axis=1)]
            )
            both = np.concatenate([found, twice])
            order = np.lexsort((both[:, 2], both[:, 1], both[:, 0]))
            both = both[order]
            weight = np.concatenate([counts, np.ones(len(twice), np.int64)])[order]
            new = np.concatenate([[True], (both[1:] != both[:-1]).any(axis=1)])
            first = np.flatnonzero(new)
            found, counts = both[first], np.add.reduceat(weight, first)
            start = stop
        enough = counts >= self.least[found[:, 1]] if len(found) else np.zeros(0, bool)
        return found[enough], counts[enough]

    def align(self, data: np.ndarray, offsets: np.ndarray, bands: np.ndarray) -> np.ndarray:
        """Least edits of each band's passage anywhere in the band, all bands in step."""
        row, item, band = bands.T
        length, edits = self.length[item], self.edits[item]
        low = band * (edits + 1)
        width = 2 * (edits + 1)
        columns = np.arange(int(width.max()))
        outside = int(length.max()) * 2 + len(columns)
        cost = np.where(columns < width[:, None], 0, outside)
        passage = np.zeros((len(bands), int(length.max())), np.int64)
        for i, number in enumerate(item):
            own = self.items[number][1]
            passage[i, : len(own)] = np.frombuffer(own, np.uint8)
        size = np.diff(offsets)[row]
        result = np.zeros(len(bands), np.int64)
        for step in range(int(length.max())):
            place = low[:, None] + step + columns
            valid = (place >= 0) & (place < size[:, None])
            here = data[np.where(valid, place + offsets[row][:, None], 0)]
            differs = ~valid | (here != passage[:, step][:, None])
            skipped = np.full_like(cost, outside)
            skipped[:, :-1] = cost[:, 1:] + 1
            cost = np.minimum(cost + differs, skipped)
            cost = np.where(columns < width[:, None], cost, outside)
            cost = np.minimum.accumulate(cost - columns, axis=1) + columns
            done = length == step + 1
            if done.any():
                inside = np.where(columns < width[done][:, None], cost[done], outside)
                result[done] = inside.min(axis=1)
        return result

    def search(self, data: np.ndarray, offsets: np.ndarray, powers: Powers) -> np.ndarray:
        """``row, item, edits, shared`` of every passage found in every row."""
        data, offsets = normalised(data, offsets)
        at, key = self.hits(data, offsets, powers)
        bands, counts = self.bands(at, key, offsets)
        if not len(bands):
            return np.zeros((0, 4), np.int64)
        edits = np.concatenate(
            [self.align(data, offsets, bands[i : i + 256]) for i in range(0, len(bands), 256)]
        )
        true = edits <= self.edits[bands[:, 1]]
        table = np.stack([bands[:, 0], bands[:, 1], edits, counts], axis=1)[true]
        order = np.lexsort((-table[:, 3], table[:, 2], table[:, 1], table[:, 0]))
        table = table[order]
        best = np.ones(len(table), bool)
        best[1:] = (table[1:, :2] != table[:-1, :2]).any(axis=1)
        return table[best]


FOUND = "doc_id long, item_id long, edits int, shared_qgrams int, text_key long"


def search_block(
    documents: DataFrame, items: list[tuple[int, bytes]], q: int, rate: float
) -> DataFrame:
    """What one block of passages finds; its size is bounded by ``BLOCK_BYTES`` on average."""
    by_q: dict[int, list[tuple[int, bytes]]] = {}
    for name, data in items:
        by_q.setdefault(own_q(len(data), q, rate), []).append((name, data))
    shared = documents.sparkSession.sparkContext.broadcast(by_q)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        indexes = [Passages(own, size, rate) for size, own in sorted(shared.value.items())]
        names = [np.array([name for name, _ in index.items], np.int64) for index in indexes]
        for batch in batches:
            for piece in pieces(batch.column(1)):
                for index, known in zip(indexes, names):
                    found = index.search(piece.data, piece.offsets, powers)
                    if not len(found):
                        continue
                    row = pa.array(found[:, 0] + piece.first)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(row),
                            pa.array(known[found[:, 1]]),
                            pa.array(found[:, 2].astype(np.int32)),
                            pa.array(found[:, 3].astype(np.int32)),
                            batch.column(2).take(row),
                        ],
                        ["doc_id", "item_id", "edits", "shared_qgrams", "text_key"],
                    )

    return documents.mapInArrow(run, FOUND)


def matches(
    documents: DataFrame,
    benchmark: DataFrame,
    q: int = Q,
    rate: float = EDIT_RATE,
    least_bytes: int = LEAST_BYTES,
) -> DataFrame:
    """One row for each document and benchmark item found in it within the edit budget.

    The budget is ``rate`` times the item's bytes. An item too short for the lemma to ask for
    a shared q-gram at that budget is searched with the largest smaller ``q`` that does.
    Items that are null, lack an id or have fewer than ``least_bytes`` bytes identify nothing
    (a word of every text would); a null or empty text contains nothing, a row without an id
    is reported without one. Repeated rows are reported each. Documents in which nothing is
    found give no row. Of ``documents`` only ``doc_id`` and ``text`` are read, of
    ``benchmark`` ``item_id`` and ``text``.

    Columns: ``doc_id, item_id, edits, shared_qgrams`` (of the best band).
    """
    return located(documents, benchmark, q, rate, least_bytes).drop("text_key")


def located(
    documents: DataFrame,
    benchmark: DataFrame,
    q: int = Q,
    rate: float = EDIT_RATE,
    least_bytes: int = LEAST_BYTES,
) -> DataFrame:
    """The rows of ``matches``, with a hash of the text in ``text_key``."""
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key")
    )
    items = (
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
        .where("item_id is not null and text is not null")
        .distinct()
    )
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_BYTES))
    parts = []
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()
        folded = []
        for row in own:
            data = np.frombuffer(row["text"].encode(), np.uint8)
            plain, _ = normalised(data, np.array([0, len(data)]))
            if len(passage := plain.tobytes().strip()) >= max(1, least_bytes):
                folded.append((row["item_id"], passage))
        parts.append(search_block(rows, folded, q, rate))
    return reduce(DataFrame.union, parts)


def without_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` in which no benchmark item is found; columns stay as they are.

    Each row is judged by its own text, whether its id is repeated, null or neither. Rows are
    found again by id and a 64-bit hash of the text.
    """
    leaking = (
        located(documents, benchmark)
        .select(F.col("doc_id").alias("leaking_id"), F.col("text_key").alias("leaking_key"))
        .distinct()
        .hint("shuffle_hash")
    )
    same = documents["doc_id"].cast("long").eqNullSafe(leaking["leaking_id"])
    own = F.xxhash64(documents["text"])
    return documents.join(leaking, same & (own == leaking["leaking_key"]), "left_anti")
