import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from tests.llm.rows import AWKWARD, awkward, clashing, collected, documents
from tidemark.llm import simhash
from tidemark.llm.components import components


def brute_fingerprint(text, width=4):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    if not words:
        return 0
    votes = [0] * 64
    for shingle in shingles:
        h = xxhash.xxh64_intdigest(shingle.encode(), 42)
        for bit in range(64):
            votes[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * votes[bit] > len(shingles))


def brute_components(points, distance):
    """Least point of each component; ``points`` maps a point to its bits."""
    parent = {p: p for p in points}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    names = sorted(points)
    for i, a in enumerate(names):
        for b in names[:i]:
            if (points[a] ^ points[b]).bit_count() <= distance:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {p: root(p) for p in points}


def test_awkward_rows_equal_brute_force(spark):
    expected_bits = [(i, brute_fingerprint(t)) for i, t in AWKWARD]
    least = {}
    for i, bits in expected_bits:
        if i is not None:
            least[bits] = min(least.get(bits, i), i)
    component = brute_components({p: b for b, p in least.items()}, 4)
    expected = [(i, f"{b:016x}", component.get(least.get(b))) for i, b in expected_bits]
    assert collected(simhash.near_duplicates(awkward(spark))) == sorted(expected, key=repr)
    assert collected(simhash.near_duplicates(clashing(spark))) == sorted(expected, key=repr)


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


@pytest.mark.parametrize("joint", [1, 2])
@pytest.mark.parametrize("distance", [0, 3, 4, 7])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, joint, distance):
    if joint == 2 and distance == 7:
        pytest.skip("many flips, slow")
    monkeypatch.setattr(simhash, "HOMES", 7)
    monkeypatch.setattr(simhash, "VISITS", 5)
    draw = random.Random(distance * 10 + joint)
    values = {draw.getrandbits(64) for _ in range(40)}
    for value in list(values)[:15]:
        for _ in range(8):
            value ^= sum({1 << draw.randrange(64) for _ in range(draw.randrange(1, distance + 3))})
            values.add(value)
    points = dict(enumerate(sorted(values)))
    rows = [(p, int(np.uint64(b).astype(np.int64))) for p, b in points.items()]
    frame = spark.createDataFrame(rows, "point long, bits long")
    found = components(simhash.links(frame, distance, joint), "a", "b").collect()
    labels = {p: p for p in points} | {r["node"]: r["component"] for r in found}
    assert labels == brute_components(points, distance)


def test_golay_code_is_perfect():
    errors = simhash.golay_errors()
    assert (errors >= 0).all() and len(set(errors.tolist())) == 2048


def test_components_of_chains_stars_and_noise(spark):
    rows = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)]
    rows += [(7, 7), (None, 3), (100, 101), (101, 100)]
    found = components(spark.createDataFrame(rows, "a long, b long"), "a", "b")
    sizes = Counter(row["component"] for row in found.collect())
    assert sizes == {0: 51, 100: 40}


def test_one_of_each_decides_by_row(spark):
    kept = simhash.one_of_each(clashing(spark))
    assert kept.columns == clashing(spark).columns
    ids = [row["doc_id"] for row in kept.collect()]
    assert {6, 7}.isdisjoint(ids) and ids.count(5) == 2 and None in ids
    assert {1, 4, 8, 10, 11} <= set(ids)
    words = "one two three four five six seven"
    rows = [(None, words), (5, words), (5, "else altogether, and long enough"), (9, None), (None, "")]
    rows += [(None, "nobody has an id for this"), (None, "nobody has an id for this")]
    found = sorted(
        ((r["doc_id"], r["text"]) for r in simhash.one_of_each(documents(spark, rows)).collect()), key=repr
    )
    assert found == sorted([rows[1], rows[2], rows[3], rows[5], rows[6]], key=repr)
