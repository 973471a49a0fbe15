"""Substring deduplication by sliding spans of sentences.

From each sentence the shortest run of sentences with at least ``MIN_WORDS`` words is hashed,
and up to each sentence the shortest that ends there. A longer repeated run consists of such
runs, where its copies are cut into the same sentences: a sentence too near its end to begin
one lies in the one that ends with it. One
aggregate, combined in each task before it moves, gives the first document of each run; a
join with the repeated runs alone tells which runs are not first, and adaptive execution
splits a run that fills a large part of the join. Sentences covered by a run that is not
first are removed.

Sentences end with a word ending in ``. ! ?`` or at a line end. Passages are also spliced
into the middle of other sentences, so a sentence has at most ``LONGEST`` words: where that
many words go by without an end, the word with the least hash among them is one. These ends
depend on the words around them alone, so they are the same in every copy, and a passage
of ``2 * LONGEST + MIN_WORDS`` words always holds a whole run. Sentences are compared by
their words, lower-cased in A-Z, so white space and line breaks inside do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import stored
from tidemark.llm.text import LOWER, Powers, mixed, pieces, sliding, words

MIN_WORDS = 18
LONGEST = 16

ENDS_SENTENCE = np.zeros(256, bool)
ENDS_SENTENCE[list(b".!?")] = True

#: Stands for a missing id, behind all ids.
LAST = (1 << 63) - 1


class Sentences:
    """Words of a piece, their hashes, and the first word of each sentence."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, powers: Powers, longest: int) -> None:
        lowered = LOWER[data]
        self.starts, self.ends, self.rows = words(lowered, offsets)
        self.hashes = powers.spans(powers.prefix(lowered), self.starts, self.ends)
        n = len(self.starts)
        ends = np.ones(n, bool)
        if n:
            breaks = np.concatenate([[0], np.cumsum(data == 10)])
            ends[:-1] = (
                ENDS_SENTENCE[lowered[self.ends[:-1] - 1]]
                | (breaks[self.starts[1:]] > breaks[self.ends[:-1]])
                | (self.rows[1:] != self.rows[:-1])
            )
        if n >= longest:
            rank = np.where(ends, np.uint64(0), self.hashes | np.uint64(1))
            least = sliding(rank, longest, np.minimum)
            least[self.rows[: n - longest + 1] != self.rows[longest - 1 :]] = 0
            around = np.zeros(longest - 1, np.uint64)
            chosen = sliding(np.concatenate([around, least, around]), longest, np.maximum)
            ends |= (chosen == rank) & (rank > 0)
        begins = np.ones(n, bool)
        begins[1:] = ends[:-1]
        self.first = np.flatnonzero(begins)
        self.row = self.rows[self.first]


def runs(found: Sentences, n_rows: int, powers: Powers, min_words: int):
    """Row, first sentence, number of sentences and two hashes of every run; and whether an
    earlier run of the row has the same hashes.

    A run begins with each sentence and ends with the first one that gives it
    ``min_words`` words; another ends with each sentence and begins with the last such one.
    """
    total = np.bincount(found.row, minlength=n_rows)
    stop = np.cumsum(total)
    before = stop - total
    bounds = np.append(found.first, len(found.starts))
    begin = np.arange(len(found.first))
    end = np.searchsorted(bounds, found.first + min_words, "left")
    fits = end <= stop[found.row]
    until = begin + 1
    since = np.searchsorted(bounds, bounds[until] - min_words, "right") - 1
    whole = since >= before[found.row]
    both = np.concatenate(
        [begin[fits] << 32 | end[fits], since[whole] << 32 | until[whole]]
    )
    both = np.unique(both)
    begin, end = both >> 32, both & 0xFFFFFFFF
    row = found.row[begin]
    powers.reach(len(found.hashes) + 1)
    keys = []
    for salt in (np.uint64(3), np.uint64(5)):
        sums = np.zeros(len(found.hashes) + 1, np.uint64)
        np.cumsum(mixed(found.hashes + salt) * powers.up[: len(found.hashes)], out=sums[1:])
        keys.append(powers.spans(sums, bounds[begin], bounds[end]))
    order = np.lexsort((begin, keys[1], keys[0], row))
    again = np.zeros(len(begin), bool)
    again[order[1:]] = np.logical_and.reduce(
        [key[order][1:] == key[order][:-1] for key in (row, *keys)]
    )
    return row, begin - before[row], end - begin, keys[0], keys[1], again


def hashed(documents: DataFrame, min_words: int, longest: int) -> DataFrame:
    """The runs of ``owner, text_key, text``, each once per text, by their sentences' numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for piece in pieces(batch.column(2)):
                found = Sentences(piece.data, piece.offsets, powers, longest)
                row, place, size, high, low, again = runs(found, piece.rows, powers, min_words)
                row, place, size, high, low = (c[~again] for c in (row, place, size, high, low))
                at = pa.array(row + piece.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(at),
                        batch.column(1).take(at),
                        pa.array(place.astype(np.int32)),
                        pa.array(size.astype(np.int32)),
                        pa.array(high.view(np.int64)),
                        pa.array(low.view(np.int64)),
                    ],
                    ["owner", "text_key", "place", "size", "high", "low"],
                )

    return documents.mapInArrow(
        run, "owner long, text_key long, place int, size int, high long, low long"
    )


def repeats(documents: DataFrame, min_words: int, longest: int) -> DataFrame:
    """``owner, text_key, repeated``: place and size of runs that a smaller id has too.

    Runs are as large as the texts, so they are hashed for the aggregate and again for the
    join rather than stored in between. The repeated ones are few and are stored: adaptive
    execution can only split a join between plain exchanges.
    """
    all_runs = hashed(documents, min_words, longest)
    firsts = stored(
        all_runs.groupBy("high", "low")
        .agg(F.count("*").alias("times"), F.min("owner").alias("first_owner"))
        .where("times > 1")
        .drop("times"),
        "sentence-firsts",
    )
    return (
        all_runs.join(firsts, ["high", "low"])
        .where("first_owner < owner")
        .groupBy("owner", "text_key")
        .agg(F.collect_set(F.struct("place", "size")).alias("repeated"))
    )


def keyed(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("owner"),
        F.xxhash64("text").alias("text_key"),
        "text",
    )


def cleaned(
    documents: DataFrame, min_words: int = MIN_WORDS, longest: int = LONGEST
) -> DataFrame:
    """Every document without the sentences of repeated runs.

    The first of equal runs is the one in the smallest ``doc_id`` (rows without an id come
    last), then the earliest in the text; what is judged is the input. Texts of fewer than
    ``min_words`` words have no run and stay whole. Null counts as empty. Rows with the
    same id do not repeat each other. Only ``doc_id`` and ``text`` are read.

    Columns: ``doc_id, n_sentences, n_removed, n_spans`` (runs of removed sentences),
    ``kept_text``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            ids, texts, repeated = batch.columns
            counts, kept_texts = [], []
            for piece in pieces(texts):
                found = Sentences(piece.data, piece.offsets, powers, longest)
                begin = found.starts[found.first]
                bounds = np.searchsorted(found.row, np.arange(piece.rows + 1), "left")
                row, place, size, _, _, again = runs(found, piece.rows, powers, min_words)
                row, place, size = row[again], place[again], size[again]
                order = np.argsort(row, kind="stable")
                row, place, size = row[order], place[order], size[order]
                own_runs = np.searchsorted(row, np.arange(piece.rows + 1), "left")
                for i in range(piece.rows):
                    low, high = piece.offsets[i], piece.offsets[i + 1]
                    own = begin[bounds[i] : bounds[i + 1]]
                    gone = np.zeros(len(own), bool)
                    for one in repeated[piece.first + i].as_py() or []:
                        gone[one["place"] : one["place"] + one["size"]] = True
                    for k in range(own_runs[i], own_runs[i + 1]):
                        gone[place[k] : place[k] + size[k]] = True
                    starts_run = gone & ~np.concatenate([[False], gone[:-1]])
                    counts.append((len(own), int(gone.sum()), int(starts_run.sum())))
                    keep = np.ones(high - low, bool)
                    edges = np.append(own, high) - low
                    for k in np.flatnonzero(gone):
                        keep[edges[k] : edges[k + 1]] = False
                    kept_texts.append(piece.data[low:high][keep].tobytes().decode())
            columns = list(zip(*counts)) if counts else [(), (), ()]
            numbers = [pa.array(column, pa.int64()) for column in columns]
            yield pa.RecordBatch.from_arrays(
                [ids, *numbers, pa.array(kept_texts, pa.string())],
                ["doc_id", "n_sentences", "n_removed", "n_spans", "kept_text"],
            )

    rows = keyed(documents)
    found = repeats(rows, min_words, longest)
    return (
        rows.join(found, ["owner", "text_key"], "left")
        .select(F.expr(f"nullif(owner, {LAST})").alias("doc_id"), "text", "repeated")
        .mapInArrow(
            run, "doc_id long, n_sentences long, n_removed long, n_spans long, kept_text string"
        )
    )


def digests(documents: DataFrame, **options) -> DataFrame:
    """:func:`cleaned` with the digest of the kept text in its place."""
    return cleaned(documents, **options).select(
        "doc_id",
        "n_sentences",
        "n_removed",
        "n_spans",
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )
