"""Quality scores learned from preference pairs (Bradley and Terry).

A document's strength is a linear function of features of its text. Of two labelled
documents with different labels the better one wins with probability
``sigmoid(strength difference)``, so the weights come from logistic loss on feature
differences. A document is good when its strength reaches the quantile of the learning
strengths that equals the share of poor labels; that cut becomes score 0.7.

Features are computed once for every whole text and stored as narrow rows. All labelled rows
that are not held out teach, and all pairs of a good and a poor one among them: tasks add up
sums over rows, from which the driver has the sums over pairs. Each step of Newton's method
reads the learning rows twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.all_pairs import NODES, nodes, paired, sigmoid, sigmoid_slope, softplus, spread
from tidemark.llm.storage import stored
from tidemark.llm.text import LETTER, Powers, held_out, pieces, words

#: All pairs together weigh as much as so many, beside the ridge.
PAIRS = 60_000
RIDGE = 1.0
#: Newton's method ends with a step as small as this, its halvings of a step likewise.
STEP = 1e-6
STEPS = 40
#: Strengths that the driver sorts to find one by its rank.
FEW = 10_000
#: The key of a sum over all rows, beside those of cells.
WHOLE = -(1 << 62)
#: The score from which a document is predicted to be good.
THRESHOLD = 0.7

UPPER = np.zeros(256, bool)
UPPER[65:91] = True
#: Bytes whose share is a feature of its own: all of ASCII but letters.
SINGLE = np.flatnonzero(~LETTER)[9:]
SHAPES = 14


def shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    return counts / np.maximum(total, 1)


def repeated(keys: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Share of each row's keys that occur in the row already."""
    both = keys ^ (rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, at = np.unique(both, return_index=True)
    total = np.bincount(rows, minlength=n)
    return shares(total - np.bincount(rows[at], minlength=n), total)


def features(column: pa.Array) -> np.ndarray:
    """One row of features per text, a function of that text alone."""
    powers = Powers()
    out = np.zeros((len(column), len(SINGLE) + SHAPES), np.float32)
    for piece in pieces(column):
        n, data, offsets = piece.rows, piece.data, piece.offsets
        sizes = np.diff(offsets)
        of_byte = np.repeat(np.arange(n), sizes)
        table = np.bincount(of_byte * 256 + data, minlength=n * 256).reshape(n, 256)
        starts, ends, rows = words(data, offsets)
        n_words = np.bincount(rows, minlength=n)
        lengths = (ends - starts).astype(np.float64)
        letters = np.concatenate([[0], np.cumsum(LETTER[data])])
        uppers = np.concatenate([[0], np.cumsum(UPPER[data])])
        in_word = letters[ends] - letters[starts]
        upper = uppers[ends] - uppers[starts]
        sums = powers.prefix(data)

        def mean(values: np.ndarray) -> np.ndarray:
            return shares(np.bincount(rows, values, minlength=n), n_words)

        mean_length = mean(lengths)
        newline = np.flatnonzero(data == 10)
        line_start = np.unique(np.concatenate([offsets[:-1][sizes > 0], newline + 1]))
        line_start = line_start[line_start < len(data)]
        line_row = np.searchsorted(offsets, line_start, "right") - 1
        line_end = np.minimum(
            np.append(line_start[1:], len(data)), offsets[1:][line_row] if n else 0
        )
        n_lines = np.bincount(line_row, minlength=n)
        lines = powers.spans(sums, line_start, line_end)
        shapes = [
            np.log1p(sizes),
            np.log1p(n_words),
            mean_length,
            np.sqrt(np.maximum(mean(lengths**2) - mean_length**2, 0)),
            shares(table[:, LETTER].sum(axis=1), sizes),
            shares(table[:, UPPER].sum(axis=1), sizes),
            shares(table[:, 128:].sum(axis=1), sizes),
            mean((in_word == 0).astype(float)),
            mean(((upper == in_word) & (in_word > 1)).astype(float)),
            mean((~LETTER[data[ends - 1]]).astype(float)) if len(ends) else np.zeros(n),
            mean(((in_word < lengths) & (in_word > 0)).astype(float)),
            repeated(powers.spans(sums, starts, ends), rows, n),
            repeated(lines, line_row, n),
            np.log1p(shares(n_words, n_lines)),
        ]
        own = out[piece.first : piece.first + n]
        own[:, : len(SINGLE)] = np.log1p(200 * shares(table[:, SINGLE], sizes[:, None]))
        own[:, len(SINGLE) :] = np.stack(shapes, axis=1)
    return out


def described(documents: DataFrame) -> DataFrame:
    """``doc_id, text_key, features`` of every document; the key is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = features(batch.column(1))
            flat = pa.array(table.ravel())
            offsets = pa.array(np.arange(len(table) + 1, dtype=np.int32) * table.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.ListArray.from_arrays(offsets, flat)],
                ["doc_id", "text_key", "features"],
            )

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key")
    )
    return rows.mapInArrow(run, "doc_id long, text_key long, features array<float>")


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def plain(self, table: np.ndarray) -> np.ndarray:
        return expanded((table - self.mean) / self.scale)

    def strength(self, table: np.ndarray) -> np.ndarray:
        return self.plain(table) @ self.weights

    def score(self, table: np.ndarray) -> np.ndarray:
        odds = self.strength(table) - self.cut + np.log(THRESHOLD / (1 - THRESHOLD)) + 1e-9
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def expanded(table: np.ndarray) -> np.ndarray:
    """Standardised features and their squares, clipped against outliers."""
    table = np.clip(table, -8, 8)
    return np.concatenate([table, table**2], axis=1)


def learn(table: np.ndarray, label: np.ndarray, poor_share: float, pairs: int = PAIRS) -> Model:
    """Weights by Newton's method on drawn pairs; without both labels all are good.

    For a table in memory. The queries learn from all rows and pairs, see :func:`learned`.
    """
    mean = table.mean(axis=0) if len(table) else np.zeros(len(SINGLE) + SHAPES)
    scale = (table.std(axis=0) if len(table) else np.ones_like(mean)) + 1e-6
    good, poor = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(poor):
        return Model(mean, scale, np.zeros(2 * len(mean)), 0.0)
    known = expanded((table - mean) / scale)
    draw = np.random.default_rng(9)
    differences = known[draw.choice(good, pairs)] - known[draw.choice(poor, pairs)]
    weights = np.zeros(known.shape[1])
    for _ in range(15):
        p = 1 / (1 + np.exp(-np.clip(differences @ weights, -30, 30)))
        slope = differences.T @ (1 - p) - RIDGE * weights
        curve = (differences * (p * (1 - p))[:, None]).T @ differences
        step = np.linalg.solve(curve + RIDGE * np.eye(len(weights)), slope)
        weights += step
        if np.abs(step).max() < 1e-4:
            break
    return Model(mean, scale, weights, float(np.quantile(known @ weights, poor_share)))


def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches that hold rows, with the features of their last column."""
    for batch in batches:
        if batch.num_rows:
            flat = batch.column(batch.num_columns - 1).flatten().to_numpy().astype(np.float64)
            yield batch, flat.reshape(batch.num_rows, len(SINGLE) + SHAPES)


Sums = dict[int, np.ndarray]


def summed(known: DataFrame, part: Callable[[np.ndarray, np.ndarray], Sums]) -> Sums:
    """Per key, the sum of the vectors that ``part`` gives for each batch of features and labels.

    A task adds its rows up; the sums of one key meet in one task, always in the same order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Sums = {}
        first = None
        for batch, table in tables(batches):
            first = batch.column(0)[0].as_py() if first is None else first
            for key, vector in part(table, batch.column(1).to_numpy()).items():
                sums[key] = sums[key] + vector if key in sums else vector
        for key, vector in sums.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([key], pa.int64()),
                    pa.array([first], pa.int64()),
                    pa.array([vector.tobytes()], pa.binary()),
                ],
                ["key", "first", "sums"],
            )

    def add(parts: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(one) for one in parts.sort_values("first")["sums"])
        return pd.DataFrame({"key": parts["key"].iloc[:1], "sums": [total.tobytes()]})

    added = (
        known.select("doc_id", "quality", "features")
        .mapInArrow(run, "key long, first long, sums binary")
        .groupBy("key")
        .applyInPandas(add, "key long, sums binary")
    )
    return {row["key"]: np.frombuffer(row["sums"]) for row in added.collect()}


class Level(NamedTuple):
    """Good and poor rows counted on the nodes of their strengths, and the loss they give."""

    cells: list[int]
    places: np.ndarray
    good: np.ndarray
    poor: np.ndarray
    loss: float


def level(known: DataFrame, model: Model, share: float) -> Level:
    def part(table: np.ndarray, label: np.ndarray) -> Sums:
        cell, on_nodes = spread(model.strength(table))
        out = {}
        for one in np.unique(cell):
            own = cell == one
            sides = [on_nodes[own & (label == side)].sum(axis=0) for side in (1, 0)]
            out[int(one)] = np.concatenate(sides)
        return out

    sums = summed(known, part)
    found = sorted(sums)
    good, poor = np.stack([sums[one].reshape(2, NODES) for one in found], axis=1)
    good, poor = good.ravel(), poor.ravel()
    places = nodes(np.array(found)).ravel()
    loss = share * good @ paired(softplus, places, poor)
    return Level(found, places, good, poor, loss + RIDGE * model.weights @ model.weights / 2)


def climb(known: DataFrame, model: Model, at: Level, share: float) -> np.ndarray:
    """The step of Newton's method from ``model``, whose rows lie as ``at`` says."""
    bends = np.stack(
        [
            paired(sigmoid_slope, at.places, at.poor).reshape(-1, NODES),
            paired(sigmoid_slope, at.places, at.good).reshape(-1, NODES),
        ]
    )
    place = {one: i for i, one in enumerate(at.cells)}
    width = len(model.weights)

    def part(table: np.ndarray, label: np.ndarray) -> Sums:
        plain = model.plain(table)
        cell, on_nodes = spread(plain @ model.weights)
        bend = np.zeros(len(table))
        out = {}
        for one in np.unique(cell):
            sides = []
            for side, of_node in zip((1, 0), bends):
                own = np.flatnonzero((cell == one) & (label == side))
                bend[own] = on_nodes[own] @ of_node[place[int(one)]]
                sides.append((on_nodes[own].T @ plain[own]).ravel())
            out[int(one)] = np.concatenate(sides)
        out[WHOLE] = ((plain * bend[:, None]).T @ plain).ravel()
        return out

    sums = summed(known, part)
    own = sums.pop(WHOLE).reshape(width, width)
    good, poor = np.stack([sums[one].reshape(2, NODES, width) for one in at.cells], axis=1)
    good, poor = good.reshape(-1, width), poor.reshape(-1, width)
    pull = paired(sigmoid, at.places, at.poor) @ good
    push = paired(lambda gap: sigmoid(-gap), at.places, at.good) @ poor
    cross = good.T @ paired(sigmoid_slope, at.places, poor)
    slope = share * (pull - push) - RIDGE * model.weights
    curve = share * (own - cross - cross.T) + RIDGE * np.eye(width)
    return np.linalg.solve((curve + curve.T) / 2, slope)


def ranked(values: DataFrame, rank: int) -> float:
    """The value of the only column that ``rank`` others precede; no task sorts all of them."""
    value = F.col(values.columns[0])
    while True:
        rows, low, high = values.agg(F.count("*"), F.min(value), F.max(value)).first()
        if low == high:
            return low
        if rows <= FEW:
            return sorted(row[0] for row in values.collect())[rank]
        part = F.floor((value - low) / (high - low) * 4096)
        for one, count in sorted(values.groupBy(part.alias("part")).count().collect()):
            if rank < count:
                break
            rank -= count
        values = values.where(part == one)


def quantile(values: DataFrame, share: float) -> float:
    """Numpy's quantile of the only column, exactly."""
    last = values.count() - 1
    place = share * last
    low = int(place)
    ends = [ranked(values, low), ranked(values, min(low + 1, last))]
    return float(np.quantile(ends, place - low))


def learned(known: DataFrame) -> Model:
    """The model of all rows ``doc_id, quality, features`` and all pairs of a good and a poor one.

    The loss of all pairs is scaled to the weight of ``PAIRS``, so the ridge means the same
    for any number of rows. Without both labels all are good.
    """
    rows, good, poor = known.agg(
        F.count("*"), F.count_if(F.col("quality") == 1), F.count_if(F.col("quality") == 0)
    ).first()
    mean, scale = np.zeros(len(SINGLE) + SHAPES), np.ones(len(SINGLE) + SHAPES)
    if rows:
        mean = summed(known, lambda table, label: {0: table.sum(axis=0)})[0] / rows
        squares = summed(known, lambda table, label: {0: ((table - mean) ** 2).sum(axis=0)})[0]
        scale = np.sqrt(squares / rows)
    model = Model(mean, scale + 1e-6, np.zeros(2 * len(mean)), 0.0)
    if not good or not poor:
        return model
    share = PAIRS / (good * poor)
    at = level(known, model, share)
    for _ in range(STEPS):
        step = climb(known, model, at, share)
        while True:
            ahead = model._replace(weights=model.weights + step)
            if np.abs(step).max() < STEP:
                break
            reached = level(known, ahead, share)
            if reached.loss <= at.loss + 1e-9 * (1 + abs(at.loss)):
                break
            step = step / 2
        model = ahead
        if np.abs(step).max() < STEP:
            break
        at = reached

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in tables(batches):
            yield pa.RecordBatch.from_arrays([pa.array(model.strength(table))], ["strength"])

    strengths = stored(known.select("features").mapInArrow(run, "strength double"), "strengths")
    return model._replace(cut=quantile(strengths, poor / rows))


def scores(documents: DataFrame, labels: DataFrame, modulus: int = 4) -> DataFrame:
    """Every document with its quality score.

    Labels are learned from rows that are not held out. Null labels and documents with
    contradicting labels teach nothing; without good and poor examples every score is 0.7.
    Null texts count as empty and are scored too. A repeated document is scored each time
    and taught once, of several texts the one with the least hash. Of ``documents`` only
    ``doc_id`` and ``text`` are read, of ``labels`` ``doc_id`` and ``quality``.

    Columns: ``doc_id, held_out, score, predicted``.
    """
    return judged(documents, labels, modulus).drop("text_key")


def judged(documents: DataFrame, labels: DataFrame, modulus: int = 4) -> DataFrame:
    """The rows of ``scores``, with a hash of the text in ``text_key``."""
    rows = stored(described(documents), "quality-features")
    taught = (
        labels.where("quality is not null and doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .where("quality = other")
        .drop("other")
    )
    known = (
        rows.where(~held_out(F.col("doc_id"), modulus))
        .join(taught, "doc_id")
        .groupBy("doc_id")
        .agg(
            F.first("quality").cast("double").alias("quality"),
            F.min_by("features", "text_key").alias("features"),
        )
    )
    model = learned(stored(known, "quality-learning"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, table in tables(batches):
            found = model.score(table)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(2),
                    pa.array(found),
                    pa.array((found >= THRESHOLD).astype(np.int32)),
                ],
                ["doc_id", "text_key", "held_out", "score", "predicted"],
            )

    return rows.select(
        "doc_id", "text_key", held_out(F.col("doc_id"), modulus).alias("held_out"), "features"
    ).mapInArrow(
        run, "doc_id long, text_key long, held_out boolean, score double, predicted int"
    )


def good_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``documents`` without those predicted to be poor; columns stay as they are.

    Each row is judged by its own text: of a repeated id only the poor rows go, and a poor row
    without an id goes too. Rows are found again by id and a 64-bit hash of the text.
    """
    rejected = (
        judged(documents, labels)
        .where("predicted = 0")
        .select(F.col("doc_id").alias("rejected_id"), F.col("text_key").alias("rejected_key"))
        .distinct()
        .hint("shuffle_hash")
    )
    same = documents["doc_id"].cast("long").eqNullSafe(rejected["rejected_id"])
    own = F.xxhash64(documents["text"])
    return documents.join(rejected, same & (own == rejected["rejected_key"]), "left_anti")
