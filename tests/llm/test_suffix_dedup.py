import hashlib
import random
import resource

import numpy as np
import pytest

from tests.conftest import SMALL
from tests.llm.rows import AWKWARD, awkward, clashing, collected, documents
from tidemark.llm import suffix_dedup as suffix


def brute(rows, length):
    first = {}
    owners = [suffix.LAST if i is None else i for i, _ in rows]
    data = [(text or "").encode() for _, text in rows]
    for owner, text in zip(owners, data):
        for at in range(len(text) - length + 1):
            key = text[at : at + length]
            first[key] = min(first.get(key, owner), owner)
    out = []
    for (i, _), owner, text in zip(rows, owners, data):
        gone = [False] * len(text)
        for at in range(len(text) - length + 1):
            if first[text[at : at + length]] < owner:
                gone[at : at + length] = [True] * length
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(draw, alphabet):
    prose = lambda n: "".join(draw.choices(alphabet, k=n))
    passages = [prose(draw.randrange(5, 60)) for _ in range(12)]
    rows = []
    for i in range(80):
        parts = []
        for _ in range(draw.randrange(6)):
            parts.append(draw.choice([prose(draw.randrange(30)), draw.choice(passages)]))
        rows.append((draw.randrange(1000), "".join(parts)))
    rows += [(2000, rows[3][1] + rows[5][1]), (None, rows[7][1] * 2), (5, "a" * 700), (4, "a" * 40)]
    return rows + [(rows[9][0], rows[9][1]), (rows[9][0], rows[11][1]), (1, "ab" * 300), (0, "ab" * 9)]


@pytest.mark.parametrize("crowd", ["usual", "all frequent", "none frequent"])
@pytest.mark.parametrize(("alphabet", "length", "q"), [("abcdefgh ", 12, 5), ("ab", 20, 6), ("ab", 9, 9)])
def test_equals_brute_force(spark, monkeypatch, crowd, alphabet, length, q):
    monkeypatch.setattr(suffix, "BUCKET_BYTES", 1500)
    monkeypatch.setattr(suffix, "FLUSH_BYTES", 600)
    if crowd != "usual":
        share = 1e-9 if crowd == "all frequent" else 5.0
        monkeypatch.setattr(suffix, "LEAST_SHARE", share)
        monkeypatch.setattr(suffix, "MOST_SHARE", share)
    rows = corpus(random.Random(length), alphabet)
    found = suffix.digests(documents(spark, rows), length, q)
    assert collected(found) == brute(rows, length)


def test_awkward_rows(spark):
    expected = brute(AWKWARD, suffix.LENGTH)
    assert collected(suffix.digests(awkward(spark))) == expected
    assert collected(suffix.digests(clashing(spark))) == expected
    assert suffix.digests(documents(spark, [])).count() == 0


def test_given_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(row["doc_id"], row["text"]) for row in docs.collect()]
    assert collected(suffix.digests(docs)) == brute(rows, suffix.LENGTH)
    kept = {row["doc_id"]: bytes(row["kept"]) for row in suffix.cleaned(docs).collect()}
    digests = {row[0]: row[4] for row in brute(rows, suffix.LENGTH)}
    assert {i: hashlib.sha256(k).hexdigest() for i, k in kept.items()} == digests


def test_longest_previous_factors():
    draw = random.Random(1)
    text = "".join(draw.choices("ab", k=400)).encode()
    length = 6
    data = np.frombuffer(text, np.uint8)
    starts = np.arange(len(text) - length + 1)
    owner = np.array([draw.randrange(9) for _ in starts])
    order, common = suffix.suffix_order(data, starts, length)
    windows = [text[s : s + length] for s in starts]
    assert [windows[i] for i in order] == sorted(windows)
    factor = np.zeros(len(starts), int)
    factor[order] = suffix.longest_previous(owner[order], common, length)
    for i in starts:
        earlier = any(windows[j] == windows[i] and owner[j] < owner[i] for j in starts)
        assert (factor[i] == length) == earlier


def test_packed_values_come_back():
    columns = [np.arange(5), np.array([1, 2], np.uint8), np.zeros(0, np.uint32), np.array([7], np.uint64)]
    back = suffix.unpacked(suffix.packed(*columns))
    assert all(a.dtype == b.dtype and a.tolist() == b.tolist() for a, b in zip(columns, back))


def test_answers_open_few_files(tmp_path):
    for number in range(400):
        suffix.saved(str(tmp_path), f"first-gone-{number}", np.full((3, 2), number, np.uint64))
    before = resource.getrlimit(resource.RLIMIT_NOFILE)
    resource.setrlimit(resource.RLIMIT_NOFILE, (256, before[1]))
    try:
        reader = suffix.Answers(str(tmp_path), 400)
        for number in [*range(400), *range(400), 399, 0]:
            assert (reader.array(f"first-gone-{number}") == number).all()
            assert reader.array(f"second-gone-{number}") is None
            assert len(reader.open) <= reader.limit
    finally:
        resource.setrlimit(resource.RLIMIT_NOFILE, before)
