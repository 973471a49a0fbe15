"""Text columns as flat byte arrays, and the word arithmetic shared by the operators.

A batch of texts is handled as one ``uint8`` array with row offsets, cut into pieces of a
few megabytes so that a worker's memory does not depend on the batch size.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text handled at a time.
PIECE_BYTES = 1 << 20

#: ``[\x20\x09-\x0D]``, the white space of the word definition.
SPACES = b" \t\n\x0b\x0c\r"

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


class Piece(NamedTuple):
    """Rows ``first`` to ``first + rows`` of a batch: bytes, and where each row begins."""

    first: int
    rows: int
    data: np.ndarray
    offsets: np.ndarray


def pieces(column: pa.Array, target: int = PIECE_BYTES) -> Iterator[Piece]:
    """The texts of an Arrow column, null as empty, at least one row at a time."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    if not len(column):
        return
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if large else np.int32
    _, starts, values = column.buffers()
    offsets = np.frombuffer(starts, kind)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + target, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Piece(
            first,
            last - first,
            data[offsets[first] : offsets[last]],
            offsets[first : last + 1] - offsets[first],
        )
        first = last


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the whole 64-bit word."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    return values


class Powers:
    """Powers of the hash base and of its inverse, grown when a longer text comes."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", BASE), ("down", BASE_INVERSE)):
                table = np.full(size, base, np.uint64)
                table[0] = 1
                setattr(self, name, np.multiply.accumulate(table))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """``n + 1`` running sums of ``(byte + 1) * base ** index`` modulo 2**64."""
        self.reach(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=sums[1:])
        return sums

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of ``[start, end)``; equal bytes have equal hashes wherever they lie."""
        return mixed((sums[ends] - sums[starts]) * self.down[starts])

    def rolling(self, sums: np.ndarray, width: int) -> np.ndarray:
        """Hashes of all runs of ``width`` bytes, by start."""
        n = len(sums) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mixed((sums[width:] - sums[:n]) * self.down[:n])


def sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of all runs of ``width`` values."""
    size = 1
    while size * 2 <= width:
        values = best(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return best(values[:-rest], values[rest:]) if rest else values


def words(
    data: np.ndarray, offsets: np.ndarray, inside: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the words, runs of ``inside``; none crosses a row.

    Without ``inside``, words are ``[^\\x20\\x09-\\x0D]+``.
    """
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    if inside is None:
        inside = ~IS_SPACE[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets[:-1]] = True
    begins[len(data)] = True
    after_gap = np.ones(len(data), bool)
    after_gap[1:] = ~inside[:-1]
    before_gap = np.ones(len(data), bool)
    before_gap[:-1] = ~inside[1:]
    starts = np.flatnonzero(inside & (after_gap | begins[:-1]))
    ends = np.flatnonzero(inside & (before_gap | begins[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def held_out(doc_id: Column, modulus: int, remainder: int = 2) -> Column:
    """Whether ``crc32`` of the id as text leaves ``remainder``; null ids are not held out."""
    return F.coalesce(
        F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False)
    )


def text_bytes(documents: DataFrame) -> int:
    """UTF-8 bytes of all texts."""
    return documents.select(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
