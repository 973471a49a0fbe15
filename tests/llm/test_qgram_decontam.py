import random
import re

import numpy as np
import pytest

from tests.conftest import SMALL
from tests.llm.rows import AWKWARD, awkward, clashing, collected, documents
from tidemark.llm import qgram_decontam as qgram


def folded(text):
    text = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).encode()


def least_edits(passage, text):
    """Sellers' algorithm: least edits of the passage anywhere in the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(passage, 1):
        last, row[0] = row[0], i
        for j, t in enumerate(text, 1):
            last, row[j] = row[j], min(last + (p != t), row[j] + 1, row[j - 1] + 1)
    return min(row)


def brute(rows, items, rate, least=qgram.LEAST_BYTES):
    found = []
    for i, text in rows:
        for name, passage in items:
            own = folded(passage).strip()
            if name is None or passage is None or len(own) < least:
                continue
            edits = least_edits(own, folded(text))
            if edits <= qgram.budget(len(own), rate):
                found.append((i, name, edits))
    return sorted(found, key=repr)


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def edited(draw, text, n):
    for _ in range(n):
        at = draw.randrange(len(text))
        text = text[:at] + draw.choice(["", "z", "zz"]) + text[at + draw.randrange(2) :]
    return text


@pytest.mark.parametrize(("q", "rate", "least"), [(10, 0.08, 10), (10, 0.08, 1), (4, 0.15, 4)])
def test_equals_brute_force_around_the_budget(spark, monkeypatch, q, rate, least):
    monkeypatch.setattr(qgram, "PAIRS", 50)
    draw = random.Random(q)
    word = lambda: "".join(draw.choice("etaoin") for _ in range(draw.randrange(1, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(draw.randrange(3, 30))) for i in range(6)] + [(7, "aaaaaaaaaaaaaaaaaaaa")]
    items += [(8 + i, prose(9)[:n].strip()) for i, n in enumerate((13, 17, 19, 26, 29, 38))]
    shortest = [(20, "eta"), (21, "no"), (22, "i")]
    rows = []
    for i in range(60):
        _, passage = draw.choice(items)
        most = qgram.budget(len(passage), rate)
        planted = edited(draw, passage, draw.randrange(most + 3))
        rows.append((i, f"{prose(draw.randrange(9))} {planted}  {prose(draw.randrange(9))}".upper()))
    rows += [(50, "a" * 300), (51, None), (52, prose(200))]
    items += shortest
    found = qgram.matches(documents(spark, rows), benchmark(spark, items), q, rate, least)
    assert collected(found.drop("shared_qgrams")) == brute(rows, items, rate, least)


def test_rows_without_id_and_of_a_repeated_id_are_judged_each(spark):
    passage = "a passage of the benchmark that must not be learned"
    rows = [(None, passage), (None, "clean words of a row without an id"), (5, f"so: {passage}."),
            (5, "clean words under the same id"), (6, None), (None, None), (None, passage)]
    kept = qgram.without_leaks(documents(spark, rows), benchmark(spark, [(1, passage)]))
    assert collected(kept.select("doc_id", "text")) == sorted(
        [r for r in rows if passage not in (r[1] or "")], key=repr
    )


def test_awkward_tables(spark, monkeypatch):
    items = [(1, "ONE two three\tfour five six seven"), (2, None), (None, "word0 runs0. word1"),
             (3, ""), (4, "short"), (5, "no id here"), (1, "ONE two three\tfour five six seven")]
    expected = sorted({(i, n, e) for i, n, e in brute([r for r in AWKWARD if len(r[1] or "") < 9000], items[:-1], 0.08)}, key=repr)
    for table in (awkward(spark), clashing(spark)):
        found = qgram.matches(table, benchmark(spark, items)).drop("shared_qgrams")
        assert sorted(set(collected(found)), key=repr) == expected
    monkeypatch.setattr(qgram, "BLOCK_BYTES", 20)
    found = qgram.matches(awkward(spark), benchmark(spark, items)).drop("shared_qgrams")
    assert sorted(set(collected(found)), key=repr) == expected
    assert qgram.matches(documents(spark, []), benchmark(spark, items)).count() == 0
    assert qgram.matches(awkward(spark), benchmark(spark, [])).count() == 0
    kept = qgram.without_leaks(clashing(spark), benchmark(spark, items))
    assert kept.columns == clashing(spark).columns
    assert {5, 6, 7}.isdisjoint(row["doc_id"] for row in kept.collect())


def test_all_whole_passages_of_the_test_table_are_found(spark):
    folder = SMALL.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = {row[:2] for row in collected(qgram.matches(docs, items))}
    names = [(row["item_id"], folded(row["text"]).strip()) for row in items.collect()]
    whole = {(d["doc_id"], n) for d in docs.collect() for n, p in names if p in folded(d["text"])}
    assert whole and whole <= found and len(found) <= len(whole) + 3


def test_normalised_keeps_rows_apart():
    data = np.frombuffer(b"A  b  c\n\nD", np.uint8)
    out, offsets = qgram.normalised(data, np.array([0, 5, 5, 10]))
    assert (out.tobytes(), offsets.tolist()) == (b"a b  c d", [0, 4, 4, 8])
