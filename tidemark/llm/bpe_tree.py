"""Byte-level BPE as a monoid: halves are encoded, neighbours are joined at their seam.

Text level. A segment's value is its sequence of pattern matches, each with its ids. Two
neighbours are joined by matching again from the last match start that lies ``REACH``
characters before the seam, over a window that grows to the right until a match of the
window ends where a match of the right neighbour begins. Matching has no memory before a
match start and looks no further than ``REACH`` characters past a match end, so the
matches before and after the window stand as they are.

Match level. A long match is halved the same way. The window around the seam is encoded
again; the tokens outside stay when the pairs at both edges of the window encode to
themselves, because a sequence is the encoding of its bytes exactly when each neighbouring
pair is (every token of the vocabulary being the encoding of its own bytes).

Decoding concatenates bytes up the same kind of tree.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters past the end of a match that the pattern may look at, or past its start.
REACH = 3
#: Segments and matches up to these sizes are leaves.
LEAF_CHARS = 2048
LEAF_BYTES = 128
LEAF_TOKENS = 4096
#: Matches remembered with their ids by a worker.
REMEMBERED = 300_000

Node = tuple[list[str], list[tuple[int, ...]]]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file of base64 and decimal columns."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Codec:
    """Encodes and decodes texts by ranks; ``pattern`` must keep to ``REACH``."""

    def __init__(
        self,
        ranks: dict[bytes, int],
        pattern: str,
        leaf_chars: int = LEAF_CHARS,
        leaf_bytes: int = LEAF_BYTES,
    ) -> None:
        self.matches = regex.compile(pattern).findall
        library = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.leaf = library._encode_single_piece
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.names = [str(rank) for rank in range(len(self.bytes_of))]
        self.leaf_chars = leaf_chars
        self.leaf_bytes = leaf_bytes
        self.known: dict[str, tuple[int, ...]] = {}

    # Match level: tokens of one match.

    def joint(self, tokens: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, tokens))

    def stands(self, left: list[int], right: list[int]) -> bool:
        """Whether the last token of ``left`` and the first of ``right`` stay apart."""
        if not left or not right:
            return True
        pair = [left[-1], right[0]]
        return self.leaf(self.joint(pair)) == pair

    def join_tokens(self, left: list[int], right: list[int]) -> list[int]:
        width = 2
        while True:
            outer_left, outer_right = left[:-width], right[width:]
            window = self.leaf(self.joint(left[-width:] + right[:width]))
            if self.stands(outer_left, window) and self.stands(window, outer_right):
                return outer_left + window + outer_right
            width *= 2

    def encode_match(self, data: bytes) -> list[int]:
        if len(data) <= self.leaf_bytes:
            return self.leaf(data)
        middle = len(data) // 2
        return self.join_tokens(self.encode_match(data[:middle]), self.encode_match(data[middle:]))

    def ids_of(self, matches: list[str]) -> list[tuple[int, ...]]:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for match in set(matches):
            if match not in known:
                known[match] = tuple(self.encode_match(match.encode()))
        return [known[match] for match in matches]

    # Text level: matches of a segment.

    def join_nodes(self, left: Node, right: Node) -> Node:
        if not left[0] or not right[0]:
            return left if left[0] else right
        stays, held = len(left[0]), 0
        while stays and held < REACH:
            stays -= 1
            held += len(left[0][stays])
        tail = "".join(left[0][stays:])
        taken = 1
        while True:
            taken = min(taken, len(right[0]))
            window = tail + "".join(right[0][:taken])
            whole = taken == len(right[0])
            starts = {held: 0}
            at = held
            for i, match in enumerate(right[0][:taken]):
                at += len(match)
                starts[at] = i + 1
            end, found = 0, self.matches(window)
            for i, match in enumerate(found):
                end += len(match)
                if end in starts and (whole or end <= len(window) - REACH):
                    fresh, rest = found[: i + 1], starts[end]
                    return (
                        left[0][:stays] + fresh + right[0][rest:],
                        left[1][:stays] + self.ids_of(fresh) + right[1][rest:],
                    )
            taken *= 2

    def node(self, text: str) -> Node:
        if len(text) <= self.leaf_chars:
            found = self.matches(text)
            return found, self.ids_of(found)
        middle = len(text) // 2
        return self.join_nodes(self.node(text[:middle]), self.node(text[middle:]))

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.node(text)[1]))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF_TOKENS:
            return self.joint(ids)
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


def tokens(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids, decoded``: ids of every text, and the bytes that the ids stand for."""

    def row(codec: Codec, text: str) -> tuple:
        ids = codec.encode(text)
        return ids, codec.decode(ids)

    kinds = (pa.list_(pa.int32()), pa.binary())
    return mapped(documents, path, pattern, row, {"ids": kinds[0], "decoded": kinds[1]},
                  "doc_id long, ids array<int>, decoded binary")


def digests(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: number and digest of its ids, digest of what they decode to.

    Every match of ``pattern`` is encoded separately, without special tokens, by the ranks
    in the file at ``path``, which the driver reads and sends to the tasks. A null text
    counts as empty and has no tokens. Rows are treated one by one, so repeated rows and
    ids, also null ids, give a row each, and an empty table none. Only ``doc_id`` and
    ``text`` are read.

    Columns: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.
    """

    def row(codec: Codec, text: str) -> tuple:
        ids = codec.encode(text)
        listed = ",".join(map(codec.names.__getitem__, ids))
        return (
            len(ids),
            hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(codec.decode(ids)).hexdigest(),
        )

    kinds = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
    return mapped(documents, path, pattern, row, kinds,
                  "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def mapped(documents, path, pattern, row, kinds, schema) -> DataFrame:
    # A vocabulary is a fixed table of some ten thousand tokens.
    ranks = documents.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(ranks.value, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                found = [row(codec, value.as_py() or "") for value in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0)]
                    + [pa.array(column, kind) for column, kind in zip(zip(*found), kinds.values())],
                    ["doc_id", *kinds],
                )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, schema)
