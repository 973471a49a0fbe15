"""Interpolated modified Kneser-Ney n-gram model of any order, counted in Spark.

Tasks count their own n-grams and send them by context to a bucket; a bucket knows all
followers of its contexts. It stores its n-grams and sends on, by their contexts without
the first word, in how many different n-grams each shorter one ends: the counts of the
order below, down to single words. What follows a context, in numbers of followers seen
once, twice and more often, is summed beside that. Contexts that are frequent (found by a
first pass, a list of bounded size) are spread over all buckets by their followers.
Buckets hold a bounded share of the text.

The marks before a text count as words of it, one less than the order.

The model is a set of sorted hash arrays in the shared folder, one file set per bucket,
which workers map into memory. Scoring sorts the hashes of a batch before it searches, so
memory is read in order.

Words and contexts are known by 64-bit hashes and n-grams by 56 bits within a bucket.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import Arrays, bucketed, mounted, saved, stored
from tidemark.llm.text import LOWER, Powers, held_out, mixed, pieces, text_bytes, words
from tidemark.session import scratch_path

#: Hashes of the marks before and after a text.
BEGIN, END = np.uint64(1), np.uint64(2)
#: Words of an n-gram.
ORDER = 2
#: Bytes of text per bucket, and n-grams counted in a task before they are sent.
BUCKET_BYTES = 8 << 20
FLUSH_TOKENS = 2_000_000
#: A context is frequent from this many tokens on, or from a share of them between these.
CROWD = 500_000
LEAST_SHARE, MOST_SHARE = 1e-6, 1 / 1000
#: About the bytes of a word and the white space after it.
WORD_BYTES = 6
#: Tokens scored at once.
SCORE_TOKENS = 700_000


#: Rows that go on to the next step, and rows about contexts.
MAIN, CONTEXT = 0, 1


class Tokens(NamedTuple):
    """Words of consecutive rows, what stands before each, and each row's first.

    ``before[m - 1]`` are hashes of the ``m`` words before.
    """

    before: np.ndarray
    word: np.ndarray
    first: np.ndarray


def longer(context: np.ndarray, older: np.ndarray) -> np.ndarray:
    """Hash of a context with one more word in front."""
    return mixed(context * np.uint64(0xA0761D6478BD642F) + older)


def begin_contexts(order: int) -> np.ndarray:
    """The contexts of first words, the shortest one first."""
    found = [np.array([BEGIN])]
    while len(found) < order - 1:
        found.append(longer(found[-1], found[0]))
    return np.concatenate(found)


def ngrams(column: pa.Array, order: int) -> Iterator[tuple[int, int, Tokens]]:
    """First row, number of rows and tokens of each piece of a column of texts."""
    powers = Powers()
    for piece in pieces(column):
        lowered = LOWER[piece.data]
        starts, ends, rows = words(lowered, piece.offsets)
        hashes = powers.spans(powers.prefix(lowered), starts, ends)
        at = np.arange(len(starts)) + rows
        word = np.full(len(starts) + piece.rows, END, np.uint64)
        before = np.full((order - 1, len(word)), BEGIN, np.uint64)
        word[at] = hashes
        before[0, at + 1] = hashes
        first = np.searchsorted(rows, np.arange(piece.rows), "left") + np.arange(piece.rows)
        if order > 2:
            place = np.arange(len(word)) - np.repeat(first, np.diff(np.append(first, len(word))))
        for m in range(1, order - 1):
            older = np.full(len(word), BEGIN, np.uint64)
            older[m:] = np.where(place[m:] >= m, before[0, :-m], BEGIN)
            before[m] = longer(before[m - 1], older)
        yield piece.first, piece.rows, Tokens(before, word, first)


def encoded(keys: np.ndarray, *columns: np.ndarray) -> bytes:
    """Keys and small counts; a count of 255 and more is told apart in eight bytes."""
    out = [struct.pack("<q", len(keys)), keys.astype("<u8").tobytes()]
    for column in columns:
        codes = np.minimum(column, 255).astype(np.uint8)
        large = column[codes == 255].astype("<u8")
        out += [codes.tobytes(), struct.pack("<q", len(large)), large.tobytes()]
    return b"".join(out)


def decoded(data: bytes, at: int, columns: int) -> tuple[int, list[np.ndarray]]:
    """Position after the block, and its keys and columns."""
    (n,) = struct.unpack_from("<q", data, at)
    at += 8
    out = [np.frombuffer(data, "<u8", n, at)]
    at += 8 * n
    for _ in range(columns):
        codes = np.frombuffer(data, np.uint8, n, at)
        at += n
        (m,) = struct.unpack_from("<q", data, at)
        at += 8
        column = codes.astype(np.uint64)
        column[codes == 255] = np.frombuffer(data, "<u8", m, at)
        at += 8 * m
        out.append(column)
    return at, out


def summed(keys: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Different keys in order, with the sums of their columns."""
    if not len(keys):
        return keys, columns
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], [np.add.reduceat(column[order], at) for column in columns]


def merged(
    contexts: list[np.ndarray], word: np.ndarray, columns: list[np.ndarray]
) -> tuple[list[np.ndarray], np.ndarray, list[np.ndarray]]:
    """Different n-grams by context and word, with the sums of their columns."""
    order = np.lexsort((word, contexts[0]))
    context, word = contexts[0][order], word[order]
    new = (context[1:] != context[:-1]) | (word[1:] != word[:-1])
    at = np.flatnonzero(np.concatenate([[True], new]))
    return (
        [other[order[at]] for other in contexts],
        word[at],
        [np.add.reduceat(column[order], at) for column in columns],
    )


def packed(contexts: list[np.ndarray], word: np.ndarray, *columns: np.ndarray) -> bytes:
    """Sorted n-grams: every context once, with its shorter forms, then the followers."""
    own = contexts[0]
    runs = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    sizes = np.diff(np.append(runs, len(own)))
    shorter = [other[runs].astype("<u8").tobytes() for other in contexts[1:]]
    return b"".join([encoded(own[runs], sizes), *shorter, encoded(word, *columns)])


def unpacked(data: bytes, contexts: int, columns: int) -> list[np.ndarray]:
    """The contexts, words and columns of n-grams, each as long as their number."""
    at, (own, sizes) = decoded(data, 0, 1)
    found = [own]
    for _ in range(contexts - 1):
        found.append(np.frombuffer(data, "<u8", len(own), at))
        at += 8 * len(own)
    _, followers = decoded(data, at, columns)
    return [np.repeat(other, sizes.astype(np.int64)) for other in found] + followers


def in_buckets(bucket: np.ndarray, *within: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket with the places of its rows, sorted by ``within`` or as they come."""
    order = np.lexsort((*within, bucket)) if within else np.argsort(bucket, kind="stable")
    dealt = bucket[order]
    cuts = np.flatnonzero(np.concatenate([[True], dealt[1:] != dealt[:-1], [True]]))
    for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield int(dealt[start]), order[start:stop]


def paired(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """56-bit hash of an n-gram, in the upper bits."""
    return mixed(context * np.uint64(0xC2B2AE3D27D4EB4F) + word) & ~np.uint64(255)


def bucket_of(
    context: np.ndarray, word: np.ndarray, frequent: np.ndarray, buckets: int
) -> np.ndarray:
    spread = np.where(np.isin(context, frequent), context ^ word, context)
    return (mixed(spread + np.uint64(7)) % np.uint64(buckets)).astype(np.int64)


def word_bucket(word: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(word + np.uint64(11)) % np.uint64(buckets)).astype(np.int64)


def frequent_contexts(texts: DataFrame, share: float, order: int = ORDER) -> np.ndarray:
    """Hashes of the frequent contexts of all lengths, no more than ``2 / share``.

    A task notes what has half the share of the contexts it holds; no result depends on it.
    """

    def note(held: list[np.ndarray]) -> pa.RecordBatch:
        contexts = np.concatenate(held)
        keys, counts = np.unique(contexts, return_counts=True)
        noted = counts >= max(2, share / 2 * len(contexts))
        keys = np.append(keys[noted].view(np.int64), 0)
        counts = np.append(counts[noted], len(contexts))
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, _, tokens in ngrams(batch.column(0), order):
                held.append(tokens.before.ravel())
                size += tokens.before.size
                if size >= FLUSH_TOKENS:
                    yield note(held)
                    held, size = [], 0
        if held:
            yield note(held)

    noted = stored(
        texts.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")),
        "kneser-ney-noted",
    )
    total = noted.where("key = 0").first()  # no word hashes to it; carries the token count
    least = share / 2 * (total["n"] if total else 0)
    rows = noted.where((F.col("key") != 0) & (F.col("n") >= least)).select("key").collect()
    return np.sort(np.array([row["key"] for row in rows], np.int64).view(np.uint64))


def counted(texts: DataFrame, frequent: np.ndarray, buckets: int, order: int) -> DataFrame:
    """``kind, bucket, payload`` and empty sums: n-grams of parts of the text, contexts together."""
    sums = sum_names(order)

    def flush(held: list[Tokens]) -> pa.RecordBatch:
        before = np.concatenate([tokens.before for tokens in held], axis=1)
        word = np.concatenate([tokens.word for tokens in held])
        contexts, w, (n,) = merged(list(before[::-1]), word, [np.ones(len(word), np.int64)])
        names, loads = [], []
        for bucket, own in in_buckets(bucket_of(contexts[0], w, frequent, buckets)):
            names.append(bucket)
            loads.append(packed([other[own] for other in contexts], w[own], n[own]))
        zeros = pa.array(np.zeros(len(names), np.int64))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(names), MAIN, np.int32)),
                pa.array(names, pa.int64()),
                pa.array(loads, pa.binary()),
                *[zeros] * len(sums),
            ],
            ["kind", "bucket", "payload", *sums],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, _, tokens in ngrams(batch.column(0), order):
                held.append(tokens)
                size += tokens.before.size
                if size >= FLUSH_TOKENS:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return texts.mapInArrow(run, step_schema(order))


def counts_of_counts(column: np.ndarray) -> list[int]:
    return [int((column == k).sum()) for k in (1, 2, 3, 4)] + [int((column > 0).sum())]


SUMS = ["n1", "n2", "n3", "n4", "types"]


def sum_names(order: int) -> list[str]:
    return [f"order{level}_{name}" for level in range(2, order + 1) for name in SUMS]


def step_schema(order: int) -> str:
    sums = "".join(f", {name} long" for name in sum_names(order))
    return f"kind int, bucket long, payload binary{sums}"


def kept_table(folder: str, name: str, keys: np.ndarray, columns: list[np.ndarray]) -> None:
    """Stores sorted keys with their counts, a byte each; large ones aside."""
    table = np.stack(columns, axis=1)
    codes = np.minimum(table, 255).astype(np.uint8)
    large = np.flatnonzero(codes.ravel() == 255)
    saved(folder, name, keys)
    saved(folder, f"{name}-codes", codes)
    saved(folder, f"{name}-large", np.stack([large.astype(np.uint64), table.ravel()[large]]))


def merged_tables(payloads: pd.Series, columns: int) -> tuple[np.ndarray, list[np.ndarray]]:
    blocks = [decoded(payload, 0, columns)[1] for payload in payloads]
    return summed(
        np.concatenate([block[0] for block in blocks]),
        [np.concatenate([block[i] for block in blocks]) for i in range(1, columns + 1)],
    )


#: Per context: its followers' counts in sum, and followers counted once, twice, more often.
FOLLOWING = 4
#: Per word: tokens, different words before it, and what follows it.
WORD_COLUMNS = 2 + FOLLOWING


def level_files(folder: str, level: int, order: int, frequent: np.ndarray, buckets: int):
    """Merges and stores a bucket's n-grams of ``level`` words, and sends on what lies below.

    Rows about contexts come from the level above and end here.
    """
    names = ["kind", "bucket", "payload", *sum_names(order)]

    def context_files(frame: pd.DataFrame) -> pd.DataFrame:
        keys, columns = merged_tables(frame["payload"], FOLLOWING)
        kept_table(folder, f"contexts{level + 1}-{int(frame['bucket'].iloc[0])}", keys, columns)
        return pd.DataFrame(columns=names)

    def gram_files(frame: pd.DataFrame) -> pd.DataFrame:
        counts = 1 if level == order else 2
        blocks = [unpacked(payload, level - 1, counts) for payload in frame["payload"]]
        arrays = [np.concatenate(parts) for parts in zip(*blocks)]
        contexts, w, columns = merged(arrays[: level - 1], arrays[level - 1], arrays[level:])
        # Of the longest n-grams occurrences count, of others the different ones they end.
        tokens, n = columns[0], columns[-1]

        keys = paired(contexts[0], w) | np.minimum(n, 255)
        by_key = np.argsort(keys)
        large = np.flatnonzero(n[by_key] >= 255)
        name = f"grams{level}-{int(frame['bucket'].iloc[0])}"
        saved(folder, name, keys[by_key])
        saved(folder, f"{name}-large", np.stack([large.astype(np.uint64), n[by_key][large]]))

        one, zero = np.ones(len(w), np.uint64), np.zeros(len(w), np.uint64)
        following = [n, one * (n == 1), one * (n == 2), one * (n > 2)]
        rows = []
        if level > 2:
            lower, word, below = merged(contexts[1:], w, [tokens, one])
            for bucket, own in in_buckets(bucket_of(lower[0], word, frequent, buckets)):
                load = packed([other[own] for other in lower], word[own], *(c[own] for c in below))
                rows.append((MAIN, bucket, load))
            kind, (key, table) = CONTEXT, summed(contexts[0], following)
        else:
            kind, (key, table) = MAIN, summed(
                np.concatenate([w, contexts[0]]),
                [np.concatenate([tokens, zero]), np.concatenate([one, zero])]
                + [np.concatenate([zero, column]) for column in following],
            )
        for bucket, own in in_buckets(word_bucket(key, buckets)):
            rows.append((kind, bucket, encoded(key[own], *(column[own] for column in table))))
        out = pd.DataFrame(rows, columns=names[:3])
        out[names[3:]] = 0
        out.loc[0, names[3:]] = frame[names[3:]].sum()
        out.loc[0, [f"order{level}_{name}" for name in SUMS]] = counts_of_counts(n)
        return out

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        return (context_files if frame["kind"].iloc[0] == CONTEXT else gram_files)(frame)

    return run


def word_files(folder: str, order: int):
    """Merges and stores the counts of a bucket's words; returns what adds up globally."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        keys, columns = merged_tables(frame["payload"], WORD_COLUMNS)
        kept_table(folder, f"words-{int(frame['bucket'].iloc[0])}", keys, columns)
        tokens, continued = columns[:2]
        out = {name: [int(frame[name].sum())] for name in sum_names(order)}
        for name, value in zip(SUMS, counts_of_counts(continued)):
            out[f"order1_{name}"] = [value]
        out["tokens"] = [int(tokens.sum())]
        out["vocabulary"] = [int((tokens > 0).sum())]
        return pd.DataFrame(out)

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and from 3 on; a missing count of counts gives a half."""
    if not (n1 and n2):
        return np.array([0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.5]
    return np.array([0] + [min(max(d, 0.05), k) for k, d in enumerate(found, 1)])


class Model(NamedTuple):
    folder: str
    buckets: int
    frequent: np.ndarray
    tokens: int
    vocabulary: int
    #: Discounts of single words, bigrams and so on.
    discounts: list[np.ndarray]
    bigram_types: int
    word_mass: float


def train(texts: DataFrame, order: int = ORDER) -> Model:
    """A model of the one text column of ``texts``, which counts every row."""
    if order < 2:
        raise ValueError(f"order {order}: a model has n-grams of two words at least")
    spark = texts.sparkSession
    total = text_bytes(texts.toDF("text"))
    buckets = max(1, -(-total // BUCKET_BYTES))
    share = min(MOST_SHARE, max(LEAST_SHARE, CROWD / max(1, total // WORD_BYTES)))
    folder = mounted(scratch_path(spark, "kneser-ney"))
    os.makedirs(folder)
    frequent = np.union1d(frequent_contexts(texts, share, order), begin_contexts(order))
    rows = counted(texts, frequent, buckets, order)
    for level in range(order, 1, -1):
        rows = bucketed(rows, buckets, "kind", "bucket").applyInPandas(
            level_files(folder, level, order, frequent, buckets), step_schema(order)
        )
    names = [f"order1_{name}" for name in SUMS] + sum_names(order) + ["tokens", "vocabulary"]
    schema = ", ".join(f"{name} long" for name in names)
    found = (
        bucketed(rows, buckets, "bucket")
        .applyInPandas(word_files(folder, order), schema)
        .agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in names])
        .first()
        .asDict()
    )
    taken = [
        discounts(*[found[f"order{level}_{name}"] for name in SUMS[:4]])
        for level in range(1, order + 1)
    ]
    ones, twos = found["order1_n1"], found["order1_n2"]
    more = found["order1_types"] - ones - twos
    mass = float(np.dot(taken[0][1:], [ones, twos, more]))
    types = found["order2_types"]
    return Model(
        folder,
        buckets,
        frequent,
        found["tokens"],
        found["vocabulary"],
        taken,
        types,
        mass / types if types else 1.0,
    )


class Reader(Arrays):
    """The model's arrays, looked up by bucket."""

    def __init__(self, model: Model) -> None:
        super().__init__(model.folder)
        self.model = model

    def rows(self, table: str, keys: np.ndarray, columns: int) -> np.ndarray:
        """The counts of each key in the table of words or of contexts, zeros where it lacks."""
        out = np.zeros((len(keys), columns), np.uint64)
        if not len(keys):
            return out
        for bucket, own in in_buckets(word_bucket(keys, self.model.buckets), keys):
            there = self.array(f"{table}-{bucket}")
            if there is None or not len(there):
                continue
            at = np.minimum(np.searchsorted(there, keys[own]), len(there) - 1)
            hit = there[at] == keys[own]
            at, own = at[hit], own[hit]
            codes = self.array(f"{table}-{bucket}-codes")[at]
            counts = codes.astype(np.uint64)
            i, j = np.nonzero(codes == 255)
            large = self.array(f"{table}-{bucket}-large")
            place = (at[i] * columns + j).astype(np.uint64)
            counts[i, j] = large[1][np.searchsorted(large[0], place)]
            out[own] = counts
        return out

    def grams(self, level: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        out = np.zeros(len(word), np.uint64)
        keys = paired(context, word)
        places = bucket_of(context, word, self.model.frequent, self.model.buckets)
        for bucket, own in in_buckets(places, keys):
            there = self.array(f"grams{level}-{bucket}")
            if there is None or not len(there):
                continue
            at = np.minimum(np.searchsorted(there, keys[own]), len(there) - 1)
            found = there[at]
            count = np.where(found & ~np.uint64(255) == keys[own], found & np.uint64(255), 0)
            many = np.flatnonzero(count == 255)
            if len(many):
                large = self.array(f"grams{level}-{bucket}-large")
                count[many] = large[1][np.searchsorted(large[0], at[many].astype(np.uint64))]
            out[own] = count
        return out

    def log10(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each token, and its training count."""
        model = self.model
        own = self.rows("words", tokens.word, WORD_COLUMNS)
        following = np.empty((len(own), FOLLOWING), np.uint64)
        following[1:] = own[:-1, 2:]
        following[tokens.first] = self.rows("words", np.array([BEGIN]), WORD_COLUMNS)[0, 2:]

        continued = own[:, 1].astype(np.float64)
        d = model.discounts[0][np.minimum(own[:, 1], 3).astype(np.int64)]
        found = (continued - d) / max(model.bigram_types, 1)
        found += model.word_mass / (model.vocabulary + 1)
        for level, taken in enumerate(model.discounts[1:], 2):
            context = tokens.before[level - 2]
            if level > 2:
                following = self.rows(f"contexts{level}", context, FOLLOWING)
            count = self.grams(level, context, tokens.word)
            d = taken[np.minimum(count, 3).astype(np.int64)]
            total = following[:, 0].astype(np.float64)
            kept = following[:, 1:].astype(np.float64) @ taken[1:]
            with np.errstate(divide="ignore", invalid="ignore"):
                upper = (count.astype(np.float64) - d + kept * found) / total
            found = np.where(total > 0, upper, found)
        return np.log10(found), own[:, 0]


SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """Scores of all rows of ``doc_id, held_out, text`` by the model's arrays."""

    def scored(reader: Reader, held: list[Tokens]) -> np.ndarray:
        starts = np.cumsum([0] + [len(t.word) for t in held[:-1]])
        tokens = Tokens(
            np.concatenate([t.before for t in held], axis=1),
            np.concatenate([t.word for t in held]),
            np.concatenate([t.first + start for t, start in zip(held, starts)]),
        )
        logs, counts = reader.log10(tokens)
        base = np.log10((counts.astype(np.float64) + 1) / (model.tokens + model.vocabulary + 1))
        sizes = np.diff(np.append(tokens.first, len(tokens.word)))
        return np.stack(
            [
                sizes,
                np.add.reduceat((counts > 0).astype(np.float64), tokens.first),
                np.add.reduceat(base, tokens.first),
                np.add.reduceat(logs, tokens.first),
            ],
            axis=1,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            held, n, found = [], 0, [np.zeros((0, 4))]
            for _, _, tokens in ngrams(batch.column(2), len(model.discounts)):
                held.append(tokens)
                n += len(tokens.word)
                if n >= SCORE_TOKENS:
                    found.append(scored(reader, held))
                    held, n = [], 0
            if held:
                found.append(scored(reader, held))
            table = np.concatenate(found)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(table[:, 0].astype(np.int64)),
                    pa.array(table[:, 1].astype(np.int64)),
                    pa.array(np.full(len(table), model.tokens, np.int64)),
                    pa.array(table[:, 2]),
                    pa.array(table[:, 3]),
                ],
                [part.split()[0] for part in SCORED.split(", ")],
            )

    return documents.mapInArrow(run, SCORED)


def scores(documents: DataFrame, modulus: int = 7, order: int = ORDER) -> DataFrame:
    """Every document scored by a model of ``order`` words, of those that are not held out.

    Words are lower-cased in A-Z; every text ends with one end mark, which is a token, so
    a null or empty text has one token. Rows without an id are learned from. Repeated rows
    count each. No rows to learn from: every token is unknown, with probability one
    over an empty vocabulary plus one. Only ``doc_id`` and ``text`` are read.

    Columns: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id").cast("long"), modulus).alias("held_out"),
        "text",
    )
    return score(rows, train(rows.where("not held_out").select("text"), order))
