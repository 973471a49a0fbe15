"""Substring deduplication by longest-previous-factor arrays over bucketed suffixes.

A byte goes when it lies in a string of ``length`` bytes that also starts in a document
with a smaller id. Suffixes that share that many bytes lie next to each other in suffix
order, so for each suffix the previous and the next one of a smaller document in suffix
order give the longest earlier match. Only suffixes that can have one are ever sorted:

1. Every string of ``length`` bytes has a least q-gram (by hash), the same in each copy.
   Neighbouring strings with the same least q-gram are one run. Runs go to buckets by that
   q-gram, as hashes only. A run whose whole content is known from a smaller document is
   removed at once; a run that meets different runs of its q-gram is sorted in step 2; all
   others are unique.
2. The bytes of the runs to be sorted, one document each, go to buckets by q-gram. Each
   bucket sorts its suffixes and takes previous and next smaller documents.

q-grams that are frequent (found by a first pass, a list of bounded size) would crowd a
bucket with different runs. Their strings are spread over all buckets by their whole
content, where suffix order is trivial: all are equal and the least document counts.
Tasks settle what they can by themselves and send only the first copies.

What buckets find for a document is stored in sorted arrays in the shared folder, which
the passes over the texts map into memory, so texts themselves are never shuffled.
"""

from __future__ import annotations

import hashlib
import os
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import Arrays, bucketed, mounted, saved, stored
from tidemark.llm.text import Piece, Powers, mixed, pieces, sliding, text_bytes
from tidemark.session import scratch_path

LENGTH = 50
Q = 18
#: Bytes of text per bucket, and of text from which a task sends what it holds.
BUCKET_BYTES = 8 << 20
FLUSH_BYTES = 8 << 20
#: A q-gram is frequent from this many runs on, or from a share of all runs between these.
CROWD = 50_000
LEAST_SHARE, MOST_SHARE = 1e-6, 1 / 4000
#: Window starts in one run.
RUN = 255
#: Ids that share all but these bits have their answers in one file.
BLOCK_BITS = 9

LAST = (1 << 63) - 1
RUNS, STRINGS, FOUND = 0, 1, 2


def packed(*columns: np.ndarray) -> bytes:
    """Arrays as one compressed value, bytes of equal weight together."""
    out = []
    for column in columns:
        kind = column.dtype.str.encode()
        flat = np.ascontiguousarray(column).view(np.uint8)
        planes = flat.reshape(len(column), column.dtype.itemsize).T
        out += [struct.pack("<q8s", len(column), kind), planes.tobytes()]
    return zstandard.compress(b"".join(out), 1)


def unpacked(data: bytes) -> list[np.ndarray]:
    data, at, out = zstandard.decompress(data), 0, []
    while at < len(data):
        n, kind = struct.unpack_from("<q8s", data, at)
        kind = np.dtype(kind.rstrip(b"\0").decode())
        at += 16
        planes = np.frombuffer(data, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * kind.itemsize
    return out


def together(payloads: list[bytes]) -> list[np.ndarray]:
    return [np.concatenate(parts) for parts in zip(*map(unpacked, payloads))]


def by_bucket(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
    if not len(order):
        return
    for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        own = order[start:stop]
        yield int(bucket[start]), packed(*(column[own] for column in columns))


class Runs:
    """Runs of a piece: row, first and number of strings, least q-gram; hashes on demand."""

    def __init__(self, piece: Piece, powers: Powers, length: int, q: int) -> None:
        self.powers, self.length = powers, length
        self.sums = powers.prefix(piece.data)
        self.row = self.start = self.count = np.zeros(0, np.int64)
        self.key = np.zeros(0, np.uint64)
        if len(piece.data) < length:
            return
        least = sliding(powers.rolling(self.sums, q), length - q + 1, np.minimum)
        fits = np.ones(len(least), bool)
        for end in piece.offsets[1:-1].tolist():
            fits[max(0, end - length + 1) : end] = False
        new = np.ones(len(least), bool)
        new[1:] = (least[1:] != least[:-1]) | (fits[1:] != fits[:-1])
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(least)))
        keep = fits[begin]
        begin, size = begin[keep], size[keep]
        parts = -(-size // RUN)  # only where a text repeats itself at once
        whole = np.repeat(np.arange(len(begin)), parts)
        part = np.arange(len(whole)) - np.repeat(np.cumsum(parts) - parts, parts)
        self.start = begin[whole] + part * RUN
        self.count = np.minimum(size[whole] - part * RUN, RUN)
        self.key = mixed(least[self.start] + np.uint64(17))
        self.row = np.searchsorted(piece.offsets, self.start, "right") - 1

    def contents(self) -> np.ndarray:
        return self.powers.spans(self.sums, self.start, self.start + self.count + self.length - 1)

    def strings(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of some runs: number of the run, start and hash of each string."""
        count = self.count[which]
        owner = np.repeat(np.arange(len(which)), count)
        start = np.repeat(self.start[which], count)
        start = start + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        return which[owner], start, self.powers.spans(self.sums, start, start + self.length)


def text_marks(piece: Piece, sums: np.ndarray, powers: Powers) -> np.ndarray:
    """Tell texts of one id apart."""
    whole = powers.spans(sums, piece.offsets[:-1], piece.offsets[1:])
    return (whole >> np.uint64(32)).astype(np.uint32)


def row_names(owner: np.ndarray, mark: np.ndarray) -> np.ndarray:
    return mixed(mixed(owner.view(np.uint64)) + mark.astype(np.uint64))


def row_buckets(owner: np.ndarray, mark: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of rows: blocks of neighbouring ids lie together, so that a task that reads
    documents in about the order of their ids looks into few files. Rows without an id are
    spread by their text."""
    block = np.where(owner == LAST, mark.astype(np.int64), owner >> BLOCK_BITS)
    return (mixed(block.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def settled(key: np.ndarray, content: np.ndarray, owner: np.ndarray):
    """Order by key, content and owner; and, in this order, the least owner of the content."""
    order = np.lexsort((owner, content, key))
    k, c = key[order], content[order]
    new = np.ones(len(order), bool)
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    least = owner[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    return order, new, least


def frequent_grams(texts: DataFrame, share: float, length: int, q: int) -> np.ndarray:
    """Keys of frequent q-grams, no more than about ``2 / share``; only speed depends on it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            keys = [Runs(p, powers, length, q).key for p in pieces(batch.column(1))]
            keys = np.concatenate([*keys, np.zeros(0, np.uint64)])
            noted, counts = np.unique(keys, return_counts=True)
            many = counts >= max(2, share / 2 * len(keys))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(noted[many].view(np.int64), 0)),
                    pa.array(np.append(counts[many], len(keys))),
                ],
                ["key", "n"],
            )

    noted = stored(
        texts.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")),
        "suffix-noted",
    )
    total = noted.where("key = 0").first()  # carries the number of runs
    least = share / 2 * (total["n"] if total else 0)
    rows = noted.where((F.col("key") != 0) & (F.col("n") >= least)).select("key").collect()
    return np.sort(np.array([row["key"] for row in rows], np.int64).view(np.uint64))


SENT = "kind int, bucket long, payload binary"


def sent_runs(
    texts: DataFrame, frequent: np.ndarray, buckets: int, length: int, q: int
) -> DataFrame:
    """First pass: hashes of runs and of frequent strings, and what a task settles itself."""

    def flush(held: list, found: list) -> Iterator[tuple]:
        owner, mark, start, count, key, content = (np.concatenate(c) for c in zip(*held))
        order, _, least = settled(key, content, owner)
        later = np.zeros(len(order), bool)
        later[order] = owner[order] > least
        found.append((owner[later], mark[later], start[later], count[later]))
        first = ~later
        bucket = (key[first] % np.uint64(buckets)).astype(np.int64)
        columns = (owner, mark, start, count, (key >> np.uint64(32)).astype(np.uint32), content)
        for name, payload in by_bucket(bucket, *(column[first] for column in columns)):
            yield RUNS, name, payload

    def flush_strings(held: list, found: list) -> Iterator[tuple]:
        owner, mark, start, content = (np.concatenate(c) for c in zip(*held))
        order, _, least = settled(content, content, owner)
        later = np.zeros(len(order), bool)
        later[order] = owner[order] > least
        found.append((owner[later], mark[later], start[later], np.ones(later.sum(), np.int64)))
        first = ~later
        bucket = (mixed(content[first]) % np.uint64(buckets)).astype(np.int64)
        columns = (owner, mark, start, content)
        for name, payload in by_bucket(bucket, *(column[first] for column in columns)):
            yield STRINGS, name, payload

    def everything(runs: list, strings: list) -> Iterator[pa.RecordBatch]:
        found: list = []
        rows = list(flush(runs, found)) if runs else []
        rows += flush_strings(strings, found) if strings else []
        if found:
            owner, mark, start, count = (np.concatenate(c) for c in zip(*found))
            rows += answers(owner, mark, start, count, np.zeros(len(owner), np.uint8), buckets)
        columns = list(zip(*rows)) or [(), (), ()]
        kinds = (pa.int32(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds)], ["kind", "bucket", "payload"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, runs, strings, size = Powers(), [], [], 0
        for batch in batches:
            owners = batch.column(0).to_numpy(zero_copy_only=False)
            for piece in pieces(batch.column(1)):
                own = Runs(piece, powers, length, q)
                mark = text_marks(piece, own.sums, powers)
                owner = owners[piece.first : piece.first + piece.rows]
                crowded = np.isin(own.key, frequent)
                which = np.flatnonzero(~crowded)
                row = own.row[which]
                local = (own.start[which] - piece.offsets[row]).astype(np.uint32)
                content = own.contents()[which]
                count, key = own.count[which].astype(np.uint8), own.key[which]
                runs.append((owner[row], mark[row], local, count, key, content))
                number, start, content = own.strings(np.flatnonzero(crowded))
                row = own.row[number]
                local = (start - piece.offsets[row]).astype(np.uint32)
                strings.append((owner[row], mark[row], local, content))
                size += len(piece.data)
                if size >= FLUSH_BYTES:
                    yield from everything(runs, strings)
                    runs, strings, size = [], [], 0
        if runs:
            yield from everything(runs, strings)

    return texts.mapInArrow(run, SENT)


def answers(owner, mark, start, count, to_sort, buckets: int) -> list[tuple]:
    """What is found out about runs of strings, on its way to the bucket of their row."""
    bucket = row_buckets(owner, mark, buckets)
    columns = (owner, mark, start.astype(np.uint32), count.astype(np.uint32), to_sort)
    return [(FOUND, name, payload) for name, payload in by_bucket(bucket, *columns)]


def frame_of(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["kind", "bucket", "payload"])


def judged(buckets: int):
    """Judges a bucket of runs or of equal strings; answers go on to the rows."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        kind, payloads = int(frame["kind"].iloc[0]), list(frame["payload"])
        if kind == FOUND:
            return frame[["kind", "bucket", "payload"]]
        if kind == STRINGS:
            owner, mark, start, content = together(payloads)
            order, _, least = settled(content, content, owner)
            owner, mark, start = owner[order], mark[order], start[order]
            later = owner > least
            one, no = np.ones(later.sum(), np.int64), np.zeros(later.sum(), np.uint8)
            return frame_of(answers(owner[later], mark[later], start[later], one, no, buckets))
        owner, mark, start, count, key, content = together(payloads)
        order, new, least = settled(key, content, owner)
        owner, mark, start, count, key = (c[order] for c in (owner, mark, start, count, key))
        later = owner > least
        group = np.concatenate([[True], key[1:] != key[:-1]])
        number = np.cumsum(group) - 1
        at = np.flatnonzero(group)
        contents = np.add.reduceat(new.astype(np.int64), at)
        lowest, highest = np.minimum.reduceat(owner, at), np.maximum.reduceat(owner, at)
        to_sort = ~later & ((contents > 1) & (lowest < highest))[number]
        told = later | to_sort
        columns = (owner, mark, start, count, to_sort.astype(np.uint8))
        return frame_of(answers(*(column[told] for column in columns), buckets))

    return run


def filed(folder: str, name: str):
    """Stores a bucket's answers, sorted by row: removed ranges joined, runs to sort as they are."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        owner, mark, start, count, to_sort = together(list(frame["payload"]))
        row = row_names(owner, mark)
        order = np.lexsort((start, row))
        row, start, count, to_sort = row[order], start[order], count[order], to_sort[order] == 1
        bucket = int(frame["bucket"].iloc[0])
        own = (row[to_sort], start[to_sort], count[to_sort])
        saved(folder, f"{name}-sort-{bucket}", np.stack([c.astype(np.uint64) for c in own]))
        row, start = row[~to_sort], start[~to_sort].astype(np.int64)
        count = count[~to_sort].astype(np.int64)
        # Strings that start within a gap-free range; rows are kept apart by a large step.
        number = np.cumsum(np.diff(row, prepend=row[:1]) != 0) << 33
        first = start + number
        end = np.maximum.accumulate(first + count)
        new = np.ones(len(row), bool)
        new[1:] = first[1:] > end[:-1]
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(row))[: len(at)] - 1
        ranges = [row[at], start[at].astype(np.uint64), (end[last] - number[last]).astype(np.uint64)]
        saved(folder, f"{name}-gone-{bucket}", np.stack(ranges))
        return pd.DataFrame({"ranges": [len(at)]})

    return run


class Answers(Arrays):
    """Stored answers about rows."""

    def __init__(self, folder: str, buckets: int) -> None:
        super().__init__(folder)
        self.buckets = buckets

    def of(self, name: str, owner: np.ndarray, mark: np.ndarray):
        """Position of the row, first and second value of all entries about these rows."""
        rows, bucket = row_names(owner, mark), row_buckets(owner, mark, self.buckets)
        found = [np.zeros((3, 0), np.int64)]
        for one in np.unique(bucket).tolist():
            table = self.array(f"{name}-{one}")
            if table is None or not table.shape[1]:
                continue
            own = np.flatnonzero(bucket == one)
            low = np.searchsorted(table[0], rows[own], "left")
            n = np.searchsorted(table[0], rows[own], "right") - low
            at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            found.append(np.stack([np.repeat(own, n), table[1, at], table[2, at]]).astype(np.int64))
        return tuple(np.concatenate(found, axis=1))


def sent_bytes(texts: DataFrame, folder: str, buckets: int, length: int, q: int) -> DataFrame:
    """Second pass: the bytes of the runs to sort."""

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        owner, mark, start, count, key, size, data = (np.concatenate(c) for c in zip(*held))
        place = np.cumsum(size) - size
        order = np.argsort((key % np.uint64(buckets)), kind="stable")
        bucket = (key[order] % np.uint64(buckets)).astype(np.int64)
        cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
        names, loads = [], []
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            own = order[low:high]
            at = np.repeat(place[own] - (np.cumsum(size[own]) - size[own]), size[own])
            at = at + np.arange(len(at))
            names.append(int(bucket[low]))
            columns = (owner, mark, start.astype(np.uint32), count.astype(np.uint8))
            loads.append(packed(*(column[own] for column in columns), data[at]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int64()), pa.array(loads, pa.binary())], ["bucket", "payload"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, reader, held, size = Powers(), Answers(folder, buckets), [], 0
        for batch in batches:
            owners = batch.column(0).to_numpy(zero_copy_only=False)
            for piece in pieces(batch.column(1)):
                sums = powers.prefix(piece.data)
                mark = text_marks(piece, sums, powers)
                owner = owners[piece.first : piece.first + piece.rows]
                row, start, count = reader.of("first-sort", owner, mark)
                if not len(row):
                    continue
                at = piece.offsets[row] + start
                grams = powers.rolling(sums, q)
                # All strings of a run have the run's least q-gram; the first one's will do.
                span = at[:, None] + np.arange(length - q + 1)
                key = mixed(grams[span].min(axis=1) + np.uint64(17))
                wide = count + length - 1
                take = np.repeat(at - (np.cumsum(wide) - wide), wide) + np.arange(int(wide.sum()))
                held.append((owner[row], mark[row], start, count, key, wide, piece.data[take]))
                size += len(take)
                if size >= FLUSH_BYTES:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    return texts.mapInArrow(run, "bucket long, payload binary")


def suffix_order(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by ``length`` bytes, and the common prefix with the one before."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    columns = []
    for at in range(0, length, 8):
        word = np.zeros(len(starts), np.uint64)
        for i in range(8):
            word <<= np.uint64(8)
            if at + i < length:
                word |= padded[starts + at + i]
        columns.append(word)
    order = np.lexsort(columns[::-1])
    common = np.zeros(len(starts), np.int64)
    equal = np.ones(max(len(starts) - 1, 0), bool)
    for number, word in enumerate(columns):
        differs = word[order][1:] ^ word[order][:-1]
        same = np.full(len(differs), min(8, length - 8 * number))
        for i in range(7, -1, -1):
            here = (differs >> np.uint64(56 - 8 * i)) & np.uint64(255)
            same = np.where(here != 0, np.minimum(same, i), same)
        common[1:] += np.where(equal, same, 0)
        equal &= differs == 0
    return order, common


def smaller_before(owner: np.ndarray, common: np.ndarray, length: int) -> np.ndarray:
    """Common prefix with the nearest suffix before that has a smaller owner, 0 for none.

    Suffixes passed over have owners at least as large, so their own pointers are followed;
    prefixes shorter than ``length`` end the search.
    """
    at = np.arange(len(owner)) - 1
    shared = common.copy()
    while True:
        shared[(at < 0) | (shared < length)] = 0
        search = np.flatnonzero(shared > 0)
        search = search[owner[at[search]] >= owner[search]]
        if not len(search):
            return shared
        passed = at[search]
        shared[search] = np.minimum(shared[search], shared[passed])
        at[search] = at[passed]


def longest_previous(owner: np.ndarray, common: np.ndarray, length: int) -> np.ndarray:
    """Longest match with a smaller owner, by previous and next smaller in suffix order."""
    if not len(owner):
        return np.zeros(0, np.int64)
    before = smaller_before(owner, common, length)
    turned = np.concatenate([[0], common[1:][::-1]])
    return np.maximum(before, smaller_before(owner[::-1], turned, length)[::-1])


def sorted_bucket(buckets: int, length: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        owner, mark, start, count, data = together(list(frame["payload"]))
        count = count.astype(np.int64)
        wide = count + length - 1
        run_of = np.repeat(np.arange(len(count)), count)
        within = np.arange(len(run_of)) - np.repeat(np.cumsum(count) - count, count)
        order, common = suffix_order(data, (np.cumsum(wide) - wide)[run_of] + within, length)
        factor = longest_previous(owner[run_of][order], common, length)
        gone = np.sort(order[factor >= length])
        new = np.ones(len(gone), bool)
        new[1:] = (gone[1:] != gone[:-1] + 1) | (run_of[gone[1:]] != run_of[gone[:-1]])
        at = np.flatnonzero(new)
        number = run_of[gone[at]]
        size = np.diff(np.append(at, len(gone)))
        begin = start[number].astype(np.int64) + within[gone[at]]
        return frame_of(
            answers(owner[number], mark[number], begin, size, np.zeros(len(at), np.uint8), buckets)
        )

    return run


def keyed(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("owner"), "text"
    )


def found_ranges(texts: DataFrame, length: int, q: int) -> tuple[str, int]:
    """Folder and number of buckets of the stored answers about all rows."""
    total = text_bytes(texts)
    buckets = max(1, -(-total // BUCKET_BYTES))
    folder = mounted(scratch_path(texts.sparkSession, "suffix-dedup"))
    os.makedirs(folder)
    runs = max(1, total * 2 // (length - q + 2))
    share = min(MOST_SHARE, max(LEAST_SHARE, CROWD / runs))
    frequent = frequent_grams(texts, share, length, q)

    def file(rows: DataFrame, name: str) -> None:
        grouped = bucketed(rows, buckets, "bucket").applyInPandas(
            filed(folder, name), "ranges long"
        )
        grouped.agg(F.sum("ranges")).collect()

    sent = sent_runs(texts, frequent, buckets, length, q)
    # Three kinds of what is sent share a bucket's text.
    file(bucketed(sent, 3 * buckets, "kind", "bucket").applyInPandas(judged(buckets), SENT), "first")
    bytes_ = sent_bytes(texts, folder, buckets, length, q)
    sorted_ = bucketed(bytes_, buckets, "bucket")
    file(sorted_.applyInPandas(sorted_bucket(buckets, length), SENT), "second")
    return folder, buckets


CLEANED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def cleaned(documents: DataFrame, length: int = LENGTH, q: int = Q) -> DataFrame:
    """Every document without the bytes that a smaller document has had before.

    A byte is removed when a string of ``length`` bytes that covers it also starts in a
    document with a smaller id; strings are judged on the input and lie within one text.
    Null counts as empty. Rows without an id come after all others, and rows of one id are
    not earlier than each other. Texts shorter than ``length`` stay whole. Repeated rows
    give a row each. Only ``doc_id`` and ``text`` are read.

    Columns: ``doc_id, n_bytes, n_removed, n_spans`` (maximal removed ranges), ``kept``.
    """
    return removed(documents, length, q, False)


def digests(documents: DataFrame, length: int = LENGTH, q: int = Q) -> DataFrame:
    """:func:`cleaned` with the digest of the kept bytes, ``kept_sha256``, in their place."""
    return removed(documents, length, q, True)


def removed(documents: DataFrame, length: int, q: int, digest: bool) -> DataFrame:
    if not 0 < q <= length:
        raise ValueError("q-grams must fit into the strings")
    texts = keyed(documents)
    folder, buckets = found_ranges(texts, length, q)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, reader = Powers(), Answers(folder, buckets)
        for batch in batches:
            owners = batch.column(0).to_numpy(zero_copy_only=False)
            rows = []
            for piece in pieces(batch.column(1)):
                owner = owners[piece.first : piece.first + piece.rows]
                mark = text_marks(piece, powers.prefix(piece.data), powers)
                edge = np.zeros(len(piece.data) + 1, np.int64)
                for name in ("first-gone", "second-gone"):
                    row, start, stop = reader.of(name, owner, mark)
                    np.add.at(edge, piece.offsets[row] + start, 1)
                    np.add.at(edge, piece.offsets[row] + stop + length - 1, -1)
                gone = np.cumsum(edge)[:-1] > 0
                for i in range(piece.rows):
                    low, high = piece.offsets[i], piece.offsets[i + 1]
                    own = gone[low:high]
                    spans = int((own[1:] & ~own[:-1]).sum()) + int(len(own) > 0 and own[0])
                    kept = piece.data[low:high][~own].tobytes()
                    rows.append(
                        (
                            None if owner[i] == LAST else int(owner[i]),
                            int(high - low),
                            int(own.sum()),
                            spans,
                            hashlib.sha256(kept).hexdigest() if digest else kept,
                        )
                    )
            kinds = (*[pa.int64()] * 4, pa.string() if digest else pa.binary())
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)],
                [*names[:4], "kept_sha256" if digest else "kept"],
            )

    schema = CLEANED.replace("kept binary", "kept_sha256 string") if digest else CLEANED
    return texts.mapInArrow(run, schema)
