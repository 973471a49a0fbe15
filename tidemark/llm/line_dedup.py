"""Line deduplication by a sharded minimal perfect hash that documents probe.

The distinct lines of each document are counted by a 128-bit hash. The hashes that several
documents hold are dealt to shards; each shard becomes one file: a minimal perfect hash
(levels of bits, where a key alone at its bit stays and the others go on to the next level),
and at the number it gives each key a 64-bit fingerprint, the count of documents and the
first of them. Documents are then split once more and look their lines up, so no line is
ever joined. A line that is in no shard is told from the others by its fingerprint.

Files lie in the shared folder and are mapped; a batch of lines is looked up shard by shard,
and only ``OPEN_SHARDS`` files are open at a time.
"""

from __future__ import annotations

import os
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import mounted, saved, stored
from tidemark.llm.text import BASE, SPACES, mixed
from tidemark.session import scratch_path

MIN_CHARS = 10
#: Keys in a shard, about 21 bytes each.
SHARD_KEYS = 1 << 21
OPEN_SHARDS = 64
#: Bits of a level for each key that reaches it.
SPARSENESS = 2
#: Bytes of text whose lines are looked up at once.
LOOKUP_BYTES = 8 << 20

#: Stands for a missing id, behind all ids.
LAST = (1 << 63) - 1
#: Counts are held in 32 bits and stay at this one.
MOST = (1 << 32) - 1

KEYS = "owner long, high long, low long"


def keys_of(text: bytes, min_chars: int) -> tuple[list[bytes], list[bytes | None]]:
    """The lines of a text, and the hash of each that is long enough."""
    lines = text.split(b"\n")
    hashes = []
    for line in lines:
        key = line.strip(SPACES).lower()
        # A code point has at most four bytes, so most lines need no decoding.
        long = len(key) >= 4 * min_chars or (
            len(key) >= min_chars and len(key.decode()) >= min_chars
        )
        hashes.append(xxhash.xxh3_128_digest(key) if long else None)
    return lines, hashes


def halves(hashes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    joined = b"".join(hashes)
    pairs = (np.frombuffer(joined, np.int64) if joined else np.zeros(0, np.int64)).reshape(-1, 2)
    return np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1])


def line_keys(documents: DataFrame, min_chars: int) -> DataFrame:
    """``owner, high, low``: each document's distinct lines that are long enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, found, size = [], [], 0
            ids = batch.column(0).to_pylist()
            for i, value in zip(ids, batch.column(1)):
                text = (value.as_py() or "").encode()
                own = {key for key in keys_of(text, min_chars)[1] if key is not None}
                owners.append(np.full(len(own), i, np.int64))
                found.extend(own)
                size += len(text)
                if size >= LOOKUP_BYTES:
                    yield packed(owners, found)
                    owners, found, size = [], [], 0
            yield packed(owners, found)

    def packed(owners: list[np.ndarray], found: list[bytes]) -> pa.RecordBatch:
        own = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(own), *map(pa.array, halves(found))], ["owner", "high", "low"]
        )

    return documents.mapInArrow(run, KEYS)


def level_bits(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
    """The bit of each key in a level, from both halves and another mixture at each level."""
    seed = np.uint64((2 * level + 1) * int(BASE) % (1 << 64))
    mixture = mixed(high.view(np.uint64) * seed + low.view(np.uint64) + seed)
    return (mixture % np.uint64(size)).astype(np.int64)


def perfect_hash(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Level sizes, the bits of all levels, and the number of each key, for distinct keys."""
    sizes, bits, numbers = [], [], np.zeros(len(high), np.int64)
    left, taken = np.arange(len(high)), 0
    while len(left):
        size = 64 * (-(-SPARSENESS * len(left) // 64) + 1)
        at = level_bits(high[left], low[left], len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        own = alone[at]
        rank = np.cumsum(alone) - 1
        numbers[left[own]] = taken + rank[at[own]]
        taken += int(alone.sum())
        sizes.append(size)
        bits.append(alone)
        left = left[~own]
    flat = np.concatenate(bits) if bits else np.zeros(0, bool)
    return np.array(sizes, np.int64), flat, numbers


def shard_file(high, low, counts, firsts) -> np.ndarray:
    """A shard as one array of words: header, bits, ranks, fingerprints, firsts, counts."""
    sizes, bits, numbers = perfect_hash(high, low)
    words = np.packbits(bits, bitorder="little").view(np.uint64)
    ones = np.cumsum(np.bitwise_count(words).astype(np.uint64))
    ranks = np.concatenate([np.zeros(1, np.uint64), ones])[: len(words)]
    n = len(high)
    fingerprints, first = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    count = np.zeros(n + n % 2, np.uint32)
    fingerprints[numbers] = low.view(np.uint64)
    first[numbers] = firsts.view(np.uint64)
    count[numbers] = np.minimum(counts, MOST)
    header = np.array([n, len(sizes), *sizes.tolist()], np.uint64)
    return np.concatenate([header, words, ranks, fingerprints, first, count.view(np.uint64)])


class Shard:
    """A mapped shard; its file is closed when the last reference goes."""

    def __init__(self, path: str) -> None:
        self.words = np.load(path, mmap_mode="r")
        n, levels = int(self.words[0]), int(self.words[1])
        self.sizes = self.words[2 : 2 + levels].astype(np.int64)
        at, parts = 2 + levels, []
        for length in (self.sizes.sum() // 64, self.sizes.sum() // 64, n, n, (n + 1) // 2):
            parts.append(self.words[at : at + int(length)])
            at += int(length)
        self.bits, self.ranks, self.fingerprints, self.firsts, counts = parts
        self.firsts, self.counts = self.firsts.view(np.int64), counts.view(np.uint32)

    def probe(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and first document of each key; count 0 for keys that are not in the shard."""
        counts, firsts = np.zeros(len(high), np.int64), np.zeros(len(high), np.int64)
        left, offset = np.arange(len(high)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = offset + level_bits(high[left], low[left], level, size)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            values = self.bits[word]
            hit = (values >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(values & ((np.uint64(1) << bit) - np.uint64(1)))
            number = (self.ranks[word] + below)[hit].astype(np.int64)
            same = self.fingerprints[number] == low.view(np.uint64)[left[hit]]
            mine = left[hit][same]
            counts[mine], firsts[mine] = self.counts[number[same]], self.firsts[number[same]]
            left, offset = left[~hit], offset + size
        return counts, firsts


class Shards:
    """The index in ``folder``: the last used shards stay open."""

    def __init__(self, folder: str, shards: int) -> None:
        self.folder, self.shards, self.open = folder, shards, OrderedDict()

    def shard(self, number: int) -> Shard:
        if number not in self.open:
            while len(self.open) >= OPEN_SHARDS:
                self.open.popitem(last=False)
            self.open[number] = Shard(f"{self.folder}/{number}.npy")
        self.open.move_to_end(number)
        return self.open[number]

    def probe(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts, firsts = np.zeros(len(high), np.int64), np.zeros(len(high), np.int64)
        if not self.shards:
            return counts, firsts
        own = high % self.shards
        order = np.argsort(own, kind="stable")
        numbers, starts = np.unique(own[order], return_index=True)
        for number, mine in zip(numbers.tolist(), np.split(order, starts[1:])):
            counts[mine], firsts[mine] = self.shard(number).probe(high[mine], low[mine])
        return counts, firsts


def build_index(documents: DataFrame, min_chars: int) -> tuple[str, int]:
    """Writes the shards of all lines that several ``owner``s hold; their folder and number."""
    shared = stored(
        line_keys(documents, min_chars)
        .groupBy("high", "low")
        .agg(
            F.count("*").alias("count"),
            F.min("owner").alias("first"),
            F.max("owner").alias("last"),
        )
        .where("first < last")
        .drop("last"),
        "line-counts",
    )
    shards = -(-shared.count() // SHARD_KEYS)
    folder = mounted(scratch_path(documents.sparkSession, "line-index"))
    os.makedirs(folder)
    if not shards:
        return folder, 0

    def build(table: pa.Table) -> pa.Table:
        names = ("high", "low", "count", "first")
        high, low, counts, firsts = (table.column(name).to_numpy() for name in names)
        number = table.column("shard")[0].as_py()
        saved(folder, str(number), shard_file(high, low, counts, firsts))
        return pa.table({"shard": [number], "keys": [len(high)]})

    dealt = shared.withColumn("shard", F.pmod("high", F.lit(shards)))
    groups = dealt.repartition(shards, "shard").groupBy("shard")
    groups.applyInArrow(build, "shard long, keys long").agg(F.sum("keys")).collect()
    return folder, shards


def keyed(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("owner"), "text"
    )


def cleaned(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Every document without the lines that a document before it holds.

    A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased. Keys
    of at least ``min_chars`` code points that several ids hold lose all their lines except
    in the smallest id; rows without an id are one document behind all others, and so are
    rows of one id: they do not repeat each other. A null or empty text is one empty line.
    Repeats inside a document stay. Only ``doc_id`` and ``text`` are read.

    Columns: ``doc_id, n_lines, n_dropped, kept_text``.
    """
    rows = keyed(documents)
    folder, shards = build_index(rows, min_chars)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Shards(folder, shards)
        for batch in batches:
            owners, texts, size = [], [], 0
            for i, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = (value.as_py() or "").encode()
                owners.append(i)
                texts.append(text)
                size += len(text)
                if size >= LOOKUP_BYTES:
                    yield looked_up(index, owners, texts)
                    owners, texts, size = [], [], 0
            yield looked_up(index, owners, texts)

    def looked_up(index: Shards, owners: list[int], texts: list[bytes]) -> pa.RecordBatch:
        split = [keys_of(text, min_chars) for text in texts]
        hashes = [key for _, keys in split for key in keys if key is not None]
        counts, firsts = index.probe(*halves(hashes))
        of_row = np.repeat(
            np.array(owners, np.int64), [sum(key is not None for key in keys) for _, keys in split]
        )
        gone = iter(((counts > 1) & (firsts < of_row)).tolist())
        out = []
        for lines, keys in split:
            kept = [line for line, key in zip(lines, keys) if key is None or not next(gone)]
            out.append((len(lines), len(lines) - len(kept), b"\n".join(kept).decode()))
        n_lines, n_dropped, kept_texts = zip(*out) if out else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(owners, pa.int64()),
                pa.array(n_lines, pa.int64()),
                pa.array(n_dropped, pa.int64()),
                pa.array(kept_texts, pa.string()),
            ],
            ["owner", "n_lines", "n_dropped", "kept_text"],
        )

    return rows.mapInArrow(
        run, "owner long, n_lines long, n_dropped long, kept_text string"
    ).select(F.expr(f"nullif(owner, {LAST})").alias("doc_id"), "n_lines", "n_dropped", "kept_text")


def digests(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """:func:`cleaned` with the digest of the kept text in its place."""
    return cleaned(documents, min_chars).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


ORACLE_SQL = """
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
    SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place FROM split
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), shared AS (
    SELECT key, min(doc_id) AS first_id FROM keyed WHERE length(key) >= 10
    GROUP BY key HAVING count(DISTINCT doc_id) > 1
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (first_id < doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place)
                       FILTER (first_id IS NULL OR first_id >= doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN shared USING (key)
GROUP BY doc_id
"""
