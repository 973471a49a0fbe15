"""SimHash near-duplicates by anchor-point covering.

The 64 fingerprint bits are cut into three blocks. Two fingerprints at distance ``t``
differ in at most ``t // 3`` bits of some block. In each block the codewords of the
perfect binary Golay code are the anchors: every 23-bit word lies within three bits of
exactly one. A fingerprint is at home at its nearest anchor and visits every anchor that
is nearest to some word within the block's share of the threshold, that is every anchor
within covering radius plus that share which can matter. A linked pair therefore meets at
the home of either, and fingerprints are compared only per anchor.

Equal fingerprints are one point. What an anchor finds leaves it as a spanning forest, at
most one link for each visit, never as all pairs of a dense group. An anchor with many
homes is dealt to several groups, each with all visits, which stream past the homes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.storage import stored
from tidemark.llm.text import LOWER, Piece, pieces, words

SHINGLE_WORDS = 4
MAX_DISTANCE = 4
HASH_SEED = 42

#: Generator polynomial of the binary Golay code of length 23.
GOLAY = 0b101011100011
#: First bit and width of each block; a narrow block is read as 23 bits with leading zeros.
BLOCKS = ((0, 23), (23, 23), (46, 18))

#: Different fingerprints up to which one block makes an anchor; two blocks make more anchors.
SINGLE_BLOCK_POINTS = 10_000_000

#: Homes in one group, and visits compared with them at once.
HOMES = 4096
VISITS = 1024


def shingles(piece: Piece, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of a piece in their order, and the row of each."""
    lowered = LOWER[piece.data]
    starts, ends, rows = words(lowered, piece.offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sizes = ends - starts
    begin = np.cumsum(sizes + 1) - sizes - 1
    joined = np.full(int(begin[-1] + sizes[-1]), 32, np.uint8)
    take = np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    put = np.arange(int(sizes.sum())) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)
    joined[put] = lowered[take]
    finish = begin + sizes

    first_word = np.searchsorted(rows, np.arange(piece.rows), "left")
    n_words = np.searchsorted(rows, np.arange(piece.rows), "right") - first_word
    full = np.flatnonzero(rows[: len(rows) - width + 1] == rows[width - 1 :])
    short = np.flatnonzero((n_words > 0) & (n_words < width))
    low = np.concatenate([full, first_word[short]])
    high = np.concatenate([full + width - 1, first_word[short] + n_words[short] - 1])
    order = np.argsort(low, kind="stable")
    low, high = low[order], high[order]

    buffer = joined.tobytes()
    hashed = xxhash.xxh64_intdigest
    values = np.array(
        [
            hashed(buffer[s:e], HASH_SEED)
            for s, e in zip(begin[low].tolist(), finish[high].tolist())
        ],
        np.uint64,
    )
    return values, rows[low]


def fingerprint_batch(column: pa.Array, width: int = SHINGLE_WORDS) -> np.ndarray:
    """64-bit SimHash of every text; zero without words."""
    result = np.zeros(len(column), np.uint64)
    for piece in pieces(column):
        values, owner = shingles(piece, width)
        if not len(values):
            continue
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        owners, at = np.unique(owner, return_index=True)
        counts = np.add.reduceat(bits, at, axis=0, dtype=np.int32)
        sizes = np.diff(np.append(at, len(owner)))
        packed = np.packbits(2 * counts > sizes[:, None], axis=1, bitorder="little")
        result[piece.first + owners] = packed.reshape(-1, 8).view(np.uint64).ravel()
    return result


def fingerprints(documents: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, bits, text_key``: the fingerprint as a signed long, a hash to find the row by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = fingerprint_batch(batch.column(1), width).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(bits), batch.column(2)], ["doc_id", "bits", "text_key"]
            )

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key")
    )
    return rows.mapInArrow(run, "doc_id long, bits long, text_key long")


def golay_errors() -> np.ndarray:
    """The error of up to three bits for each of the 2048 syndromes."""
    table = np.full(2048, -1, np.int64)
    for weight in range(4):
        for places in combinations(range(23), weight):
            error = sum(1 << place for place in places)
            table[syndrome(np.array([error]))[0]] = error
    return table


def syndrome(values: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit polynomials by the generator."""
    values = values.copy()
    for place in range(22, 10, -1):
        values ^= np.where(values >> place & 1, GOLAY << (place - 11), 0)
    return values


class Anchors:
    """Home and visited anchors of fingerprints for blocks taken ``joint`` at a time."""

    def __init__(self, distance: int, joint: int) -> None:
        self.errors = golay_errors()
        self.choices = list(combinations(BLOCKS, joint))
        self.share = distance * joint // len(BLOCKS)

    def nearest(self, words_: np.ndarray) -> np.ndarray:
        """The 12 message bits of the nearest codeword."""
        return (words_ ^ self.errors[syndrome(words_)]) >> 11

    def of(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, row of ``bits`` and whether the row is at home there."""
        found = []
        for number, blocks in enumerate(self.choices):
            places = [(i, at) for i, (_, width) in enumerate(blocks) for at in range(width)]
            values = [
                (bits >> np.uint64(first) & np.uint64((1 << width) - 1)).astype(np.int64)
                for first, width in blocks
            ]
            seen = []
            for weight in range(self.share + 1):
                for flips in combinations(places, weight):
                    anchor = np.full(len(bits), number, np.int64)
                    for i, value in enumerate(values):
                        mask = sum(1 << at for block, at in flips if block == i)
                        anchor = anchor << 12 | self.nearest(value ^ mask)
                    seen.append(anchor)
            table = np.stack(seen, axis=1)
            home = table[:, 0].copy()
            table.sort(axis=1)
            fresh = np.ones(table.shape, bool)
            fresh[:, 1:] = table[:, 1:] != table[:, :-1]
            rows, _ = np.nonzero(fresh)
            anchor = table[fresh]
            found.append((anchor, rows, anchor == home[rows]))
        return tuple(np.concatenate(part) for part in zip(*found))


def visits(points: DataFrame, distance: int, joint: int) -> DataFrame:
    """``anchor, is_home, point, bits`` of every home and visit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(distance, joint)
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                point = part.column(0).to_numpy(zero_copy_only=False)
                bits = part.column(1).to_numpy(zero_copy_only=False)
                anchor, rows, home = anchors.of(bits.view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(home), pa.array(point[rows]), pa.array(bits[rows])],
                    ["anchor", "is_home", "point", "bits"],
                )

    return points.mapInArrow(run, "anchor long, is_home boolean, point long, bits long")


class Group:
    """Homes of one group and the forest that its visits have shown so far."""

    def __init__(self) -> None:
        self.points = np.zeros(0, np.int64)
        self.bits = np.zeros(0, np.uint64)
        self.label = np.zeros(0, np.int64)

    def settle(self, points: np.ndarray, bits: np.ndarray) -> None:
        self.points = np.concatenate([self.points, points])
        self.bits = np.concatenate([self.bits, bits])
        self.label = np.arange(len(self.points))

    def visit(self, points: np.ndarray, bits: np.ndarray, distance: int) -> np.ndarray:
        """Links, one for each matching visit and for each merged tree of homes."""
        near = np.bitwise_count(bits[:, None] ^ self.bits[None, :]) <= distance
        guests, homes = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        if not len(guests):
            return np.zeros((0, 2), np.int64)
        near = near[np.ix_(guests, homes)]
        none = len(self.points)
        before = self.label[homes]
        now = before.copy()
        while True:
            of_guest = np.where(near, now[None, :], none).min(axis=1)
            of_home = np.where(near, of_guest[:, None], none).min(axis=0)
            if np.array_equal(of_home, now):
                break
            now = of_home
        # Homes with one label move together, also those that no guest has matched now.
        moves = np.unique(np.stack([before, now], axis=1), axis=0)
        label = self.label
        links = [np.stack([points[guests], self.points[of_guest]], axis=1)]
        for old, new in moves[moves[:, 0] != moves[:, 1]].tolist():
            links.append(self.points[[[old, new]]])
            root_old, root_new = sorted((label[old], label[new]), reverse=True)
            label[label == root_old] = root_new
        links = np.concatenate(links)
        return links[links[:, 0] != links[:, 1]]


def meet(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Compares per group; rows come sorted by group, homes before visits."""
    current, group = None, Group()
    for batch in batches:
        anchor = batch.column(0).to_numpy(zero_copy_only=False)
        slot = batch.column(1).to_numpy(zero_copy_only=False)
        home = batch.column(2).to_numpy(zero_copy_only=False)
        point = batch.column(3).to_numpy(zero_copy_only=False)
        bits = batch.column(4).to_numpy(zero_copy_only=False).view(np.uint64)
        change = (np.diff(anchor) != 0) | (np.diff(slot) != 0) | (np.diff(home) != 0)
        cuts = np.concatenate([[0], np.flatnonzero(change) + 1, [len(anchor)]])
        found = []
        for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if start == stop:
                continue
            key = (anchor[start], slot[start])
            if key != current:
                current, group = key, Group()
            if home[start]:
                group.settle(point[start:stop], bits[start:stop])
            elif len(group.points):
                for at in range(start, stop, VISITS):
                    to = min(at + VISITS, stop)
                    found.append(group.visit(point[at:to], bits[at:to], distance))
        links = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], ["a", "b"])


def links(points: DataFrame, distance: int = MAX_DISTANCE, joint: int = 1) -> DataFrame:
    """``a, b``: links that connect the same points as all pairs within ``distance``.

    ``points`` has ``point, bits``, both without nulls and without repeated ``bits``.
    """
    met = stored(visits(points, distance, joint), "simhash-visits")
    # At most 3 * 4096 ** joint anchors; only those with several groups are listed.
    crowded = (
        met.where("is_home")
        .groupBy("anchor")
        .agg(F.ceil(F.count("*") / HOMES).cast("int").alias("slots"))
        .where("slots > 1")
    )
    dealt = met.join(crowded, "anchor", "left").withColumn("slots", F.coalesce("slots", F.lit(1)))
    own_slot = F.pmod(F.xxhash64("point"), F.col("slots")).cast("int")
    homes = dealt.where("is_home").select(
        "anchor", own_slot.alias("slot"), "is_home", "point", "bits"
    )
    guests = dealt.select(
        "anchor",
        F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"),
        F.lit(False).alias("is_home"),
        "point",
        "bits",
    )
    return (
        homes.union(guests)
        .repartition("anchor", "slot")
        .sortWithinPartitions("anchor", "slot", F.desc("is_home"))
        .mapInArrow(lambda batches: meet(batches, distance), "a long, b long")
    )


def components_of(marks: DataFrame, distance: int, joint: int | None) -> DataFrame:
    """``marks`` with the ``component`` of each fingerprint: the least one that links reach."""
    points = stored(marks.select("bits").distinct(), "simhash-points")
    if joint is None:
        joint = 1 if points.count() <= SINGLE_BLOCK_POINTS else 2
    named = points.select(F.col("bits").alias("point"), "bits")
    found = components(links(named, distance, joint), "a", "b")
    labels = points.join(found, F.col("bits") == F.col("node"), "left").select(
        "bits", F.coalesce("component", "bits").alias("component")
    )
    return marks.join(labels, "bits")


def near_duplicates(
    documents: DataFrame,
    width: int = SHINGLE_WORDS,
    distance: int = MAX_DISTANCE,
    joint: int | None = None,
) -> DataFrame:
    """One row per document: fingerprint, and the least id that its links reach.

    Words are lower-cased in A-Z only; a text of fewer than ``width`` words has one shingle,
    one without words (also null) has fingerprint zero. Rows without an id have the
    component of their fingerprint; where none of its rows has an id, it is null. Repeated
    rows stay repeated. Only ``doc_id`` and ``text`` are read. ``joint`` blocks
    form an anchor together, by default one up to ``SINGLE_BLOCK_POINTS`` different
    fingerprints and two beyond, so that an anchor's homes stay few; both find every link.

    Columns: ``doc_id, fingerprint, component_id``.
    """
    marks = stored(fingerprints(documents, width).drop("text_key"), "simhash-marks")
    named = stored(components_of(marks, distance, joint), "simhash-named")
    least = stored(
        named.groupBy("component").agg(F.min("doc_id").alias("component_id")), "simhash-least"
    )
    return named.join(least, "component").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(
    documents: DataFrame,
    width: int = SHINGLE_WORDS,
    distance: int = MAX_DISTANCE,
    joint: int | None = None,
) -> DataFrame:
    """``documents`` with one text of each component; columns stay as they are.

    Of a component the smallest id stays, of a repeated id the text with the least hash, and
    a row without an id only where no row has one. Rows that repeat an id
    and its text stay or go together.
    """
    marks = stored(fingerprints(documents, width), "simhash-marks")
    named = stored(
        components_of(marks, distance, joint).select("component", "doc_id", "text_key").distinct(),
        "simhash-named",
    )
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    best = stored(
        named.groupBy("component")
        .agg(
            F.min_by(F.struct("doc_id", "text_key"), order).alias("best"),
            F.count("*").alias("times"),
        )
        .where("times > 1")
        .drop("times"),
        "simhash-best",
    )
    dropped = (
        named.join(best, "component")
        .where(F.struct("doc_id", "text_key") != F.col("best"))
        .select(F.col("doc_id").alias("dropped_id"), F.col("text_key").alias("dropped_key"))
        .hint("shuffle_hash")
    )
    own_id = documents["doc_id"].cast("long")
    return documents.join(
        dropped,
        own_id.eqNullSafe(dropped["dropped_id"])
        & (F.xxhash64(documents["text"]) == dropped["dropped_key"]),
        "left_anti",
    )
