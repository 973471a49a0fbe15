"""Exact deduplication by composable polynomial fingerprints.

A text, stripped of white space, is read as a number in base ``B`` modulo several primes.
Chunks are hashed independently and joined by length-shifted arithmetic,
``H(xy) = H(x) * B**len(y) + H(y)``, so a huge document needs no more memory than a
chunk. Texts whose fingerprints and lengths agree are then compared chunk by chunk: per
group and chunk number, the least and the greatest chunk must be the same. That is an
aggregate with constant state, combined in each task before it moves, so a group that
holds a third of all rows costs each task one row per chunk. A group that fails the
comparison is regrouped by its texts themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import stored
from tidemark.llm.text import SPACES

#: Primes below 2**31; a byte times a power stays exact in a double over a whole chunk.
MODULI = (2147483647, 2147483629, 2147483587)
BASE = 1000003
CHUNK_BYTES = 4096
#: Characters of text in one compared chunk.
COMPARE_CHARS = 65536

#: White space that the comparison ignores.
WHITE_SPACE = "[\\x20\\x09-\\x0D]+"

KEY = ["fingerprint", "n_bytes"]
FINGERPRINT = "doc_id long, fingerprint string, n_bytes long, code_points long, text_sha256 string"


def power_table(modulus: int, length: int) -> np.ndarray:
    """``BASE ** (length - 1 - i)`` modulo ``modulus``, exact in doubles."""
    table = np.empty(length, np.float64)
    value = 1
    for i in range(length - 1, -1, -1):
        table[i] = value
        value = value * BASE % modulus
    return table


def combine(left: tuple[int, int], right: tuple[int, int], modulus: int) -> tuple[int, int]:
    """Fingerprint and length of a text from those of its two parts."""
    (a, n), (b, m) = left, right
    return (a * pow(BASE, m, modulus) + b) % modulus, n + m


class Fingerprints:
    """Fingerprints of byte strings, a chunk at a time."""

    def __init__(self, moduli: Sequence[int] = MODULI) -> None:
        self.moduli = tuple(moduli)
        self.tables = np.stack([power_table(p, CHUNK_BYTES) for p in self.moduli], axis=1)

    def of(self, data: bytes) -> str:
        parts = [(0, 0)] * len(self.moduli)
        for start in range(0, len(data), CHUNK_BYTES):
            chunk = np.frombuffer(data, np.uint8, min(CHUNK_BYTES, len(data) - start), start)
            sums = chunk.astype(np.float64) @ self.tables[CHUNK_BYTES - len(chunk) :]
            parts = [
                combine(part, (int(value) % p, len(chunk)), p)
                for part, value, p in zip(parts, sums, self.moduli)
            ]
        return "".join(f"{value:08x}" for value, _ in parts)


def fingerprints(documents: DataFrame, moduli: Sequence[int] = MODULI) -> DataFrame:
    """One narrow row per document: fingerprint, length and digest of the stripped text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Fingerprints(moduli)
        for batch in batches:
            marks, sizes, points, digests = [], [], [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                stripped = text.encode().translate(None, SPACES)
                marks.append(hasher.of(stripped))
                sizes.append(len(stripped))
                points.append(len(text))
                digests.append(hashlib.sha256(stripped).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(marks, pa.string()),
                    pa.array(sizes, pa.int64()),
                    pa.array(points, pa.int64()),
                    pa.array(digests, pa.string()),
                ],
                ["doc_id", "fingerprint", "n_bytes", "code_points", "text_sha256"],
            )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, FINGERPRINT)


def stripped() -> Column:
    """The compared text: white space ``[\\x20\\x09-\\x0D]`` deleted, null as empty."""
    return F.regexp_replace(F.coalesce("text", F.lit("")), WHITE_SPACE, "")


def own_texts(documents: DataFrame, members: DataFrame) -> DataFrame:
    """The stripped texts of ``members``; a repeated id with another text is told by digest."""
    return (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(members.distinct().hint("shuffle_hash"), "doc_id")
        .withColumn("text", stripped())
        .where(F.sha2("text", 256) == F.col("text_sha256"))
    )


def uneven_groups(documents: DataFrame, members: DataFrame) -> DataFrame:
    """Fingerprint groups whose texts differ in some chunk.

    ``members`` has the marks of the documents in groups of two and more.
    """
    last = F.expr(f"greatest(char_length(text) - 1, 0) div {COMPARE_CHARS}").cast("int")
    chunks = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.substring("text", i * COMPARE_CHARS + 1, F.lit(COMPARE_CHARS)),
    )
    return (
        own_texts(documents, members)
        .select(*KEY, F.posexplode(chunks).alias("chunk_no", "chunk"))
        .groupBy(*KEY, "chunk_no")
        .agg(F.min("chunk").alias("least"), F.max("chunk").alias("greatest"))
        .where("least <> greatest")
        .select(*KEY)
        .distinct()
    )


def exact_duplicates(documents: DataFrame, moduli: Sequence[int] = MODULI) -> DataFrame:
    """One row per document: the document that stays for it, and the size of its group.

    Texts are equal when identical without white space; null counts as empty, so empty and
    null texts form one group. Of equal texts the longest original stays, then the smallest
    id, and rows without an id come last: where one of them alone is longest, ``keep_id`` is
    null and the group's rows without an id stay. An empty table gives no rows. Only ``doc_id`` and ``text`` are read, so other columns cannot clash.

    Columns: ``doc_id, keep_id, group_size, kept, text_sha256``.
    """
    marks = stored(fingerprints(documents, moduli), "exact-marks")
    groups = stored(
        marks.groupBy(*KEY).agg(F.count("*").alias("size")).where("size > 1").drop("size"),
        "exact-groups",
    )
    members = marks.join(groups, KEY).select("doc_id", "text_sha256", *KEY)
    uneven = stored(uneven_groups(documents, members), "exact-uneven")
    if uneven.isEmpty():
        return keepers(marks, KEY)
    apart = own_texts(documents, members.join(uneven, KEY)).select(
        "doc_id", "text_sha256", F.col("text").alias("own_text")
    )
    marked = marks.join(apart.distinct(), ["doc_id", "text_sha256"], "left")
    return keepers(marked.fillna("", "own_text"), [*KEY, "own_text"])


def keepers(marks: DataFrame, key: list[str]) -> DataFrame:
    """The row that stays for each row of ``marks``; equal values of ``key`` are one group.

    Groups are stored before they are joined: adaptive execution can then split the join of
    a group that holds a third of all rows.
    """
    best = stored(
        marks.groupBy(*key).agg(
            F.count("*").alias("group_size"),
            F.max_by("doc_id", F.struct("code_points", -F.col("doc_id"))).alias("keep_id"),
        ),
        "exact-best",
    )
    return marks.join(best, key).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def without_copies(documents: DataFrame) -> DataFrame:
    """``documents`` with one id per text; columns and order of columns stay.

    Rows that repeat an id and its text stay or go together, as do the rows of a text that have
    no id. Of a repeated id with several texts only the rows go whose text is another row's.
    """
    found = exact_duplicates(documents)
    dropped = (
        found.where(~F.col("kept"))
        .select(F.col("doc_id").alias("dropped_id"), F.col("text_sha256").alias("dropped_sha"))
        .distinct()
        .hint("shuffle_hash")
    )
    doc_id = documents["doc_id"].cast("long")
    own = F.coalesce(documents["text"], F.lit(""))
    own = F.sha2(F.regexp_replace(own, WHITE_SPACE, ""), 256)
    # Rows without an id may be many; these alone are joined on their texts as well.
    same = doc_id.eqNullSafe(dropped["dropped_id"]) & F.when(doc_id.isNull(), own).eqNullSafe(
        F.when(dropped["dropped_id"].isNull(), dropped["dropped_sha"])
    )
    # An equality would be joined on, and so be computed for all texts; this is evaluated for
    # rows of a dropped id only. Digests have one length, so it means the same.
    return documents.join(dropped, same & F.contains(own, dropped["dropped_sha"]), "left_anti")
