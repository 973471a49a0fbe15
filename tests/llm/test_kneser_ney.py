import math
import random
import re
import resource
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from tests.llm.rows import AWKWARD, awkward, clashing, documents
from tidemark.llm import kneser_ney


def tokens(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", text) + ["</s>"]


def brute_discounts(counts):
    n = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
    if not n[0] or not n[1]:
        return {1: 0.5, 2: 0.5, 3: 0.5}
    y = n[0] / (n[0] + 2 * n[1])
    raw = {1: 1 - 2 * y * n[1] / n[0], 2: 2 - 3 * y * n[2] / n[1],
           3: 3 - 4 * y * n[3] / n[2] if n[2] else 0.5}
    return {k: min(max(d, 0.05), k) for k, d in raw.items()}


def brute(rows, order=2):
    """Scores by the textbook formulas, from plain counts."""
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}

    def grams(own):
        padded = ["<s>"] * (order - 1) + own
        return [tuple(padded[j : j + order]) for j in range(len(own))]

    single, counts = Counter(), {order: Counter()}
    for i, text in rows:
        if not held[i]:
            single.update(tokens(text))
            counts[order].update(grams(tokens(text)))
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(gram[1:] for gram in counts[k + 1])
    n, v, types = sum(single.values()), len(single), len(counts[2])
    taken = {k: brute_discounts(counts[k].values()) for k in counts}
    followers, totals = defaultdict(Counter), Counter()
    for k in range(2, order + 1):
        for gram, c in counts[k].items():
            followers[gram[:-1]][min(c, 3)] += 1
            totals[gram[:-1]] += c
    mass = sum(taken[1][min(c, 3)] for c in counts[1].values())

    def probability(gram):
        k, c = len(gram), counts[len(gram)][gram]
        less = c - taken[k][min(c, 3)] if c else 0
        if k == 1:
            return (less + mass / (v + 1)) / types if types else 1 / (v + 1)
        if not totals[gram[:-1]]:
            return probability(gram[1:])
        gamma = sum(taken[k][kind] * m for kind, m in followers[gram[:-1]].items())
        return (less + gamma * probability(gram[1:])) / totals[gram[:-1]]

    out = []
    for i, text in rows:
        own = tokens(text)
        base = sum(math.log10((single[w] + 1) / (n + v + 1)) for w in own)
        score = sum(math.log10(probability(gram)) for gram in grams(own))
        out.append((i, held[i], len(own), sum(single[w] > 0 for w in own), n, base, score))
    # The probabilities of all words after any context add up to one.
    for context in list(counts[order])[:4] + [("never", "seen") * order]:
        context = context[: order - 1]
        mass_ = math.fsum(probability((*context, w)) for w in [*single, "never seen either"])
        assert mass_ == pytest.approx(1)
    return out


def same(found, expected):
    found = sorted((tuple(row) for row in found.collect()), key=repr)
    expected = sorted(expected, key=repr)
    assert [row[:5] for row in found] == [row[:5] for row in expected]
    for row, other in zip(found, expected):
        assert row[5:] == pytest.approx(other[5:], rel=1e-9)


def corpus():
    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    return [
        (i, " ".join(draw.choices(vocabulary, weights, k=draw.randrange(0, 200))))
        for i in range(300)
    ]


@pytest.mark.parametrize(
    ("bucket_bytes", "share", "order"),
    [(8 << 20, 1e-3, 2), (5000, 1e-3, 2), (5000, 1e-9, 2), (8 << 20, 1e-3, 3), (9000, 2e-2, 3), (9000, 1e-9, 4)],
)
def test_equals_brute_force(spark, monkeypatch, bucket_bytes, share, order):
    monkeypatch.setattr(kneser_ney, "LEAST_SHARE", share)
    monkeypatch.setattr(kneser_ney, "MOST_SHARE", share)
    monkeypatch.setattr(kneser_ney, "BUCKET_BYTES", bucket_bytes)
    monkeypatch.setattr(kneser_ney, "FLUSH_TOKENS", 2000)
    monkeypatch.setattr(kneser_ney, "SCORE_TOKENS", 700)
    rows = corpus()
    same(kneser_ney.scores(documents(spark, rows), order=order), brute(rows, order))


def test_awkward_rows(spark):
    same(kneser_ney.scores(awkward(spark)), brute(AWKWARD))
    same(kneser_ney.scores(awkward(spark), order=3), brute(AWKWARD, 3))
    same(kneser_ney.scores(clashing(spark)), brute(AWKWARD))


def test_empty_and_unlearnt_tables(spark):
    assert kneser_ney.scores(documents(spark, [])).count() == 0
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = kneser_ney.scores(documents(spark, [(only, "two words")])).first()
    assert row["held_out"] and row["n_known"] == 0 and row["score"] == 0


def test_frequent_words_are_bounded_and_found(spark):
    rows = [(i, "the " * 50 + f"rare{i}") for i in range(50)]
    found = kneser_ney.frequent_contexts(documents(spark, rows).select("text"), 0.05)
    assert 1 <= len(found) <= 2 / 0.05


def test_scoring_opens_few_files(spark, monkeypatch):
    """Hundreds of buckets, five arrays each, read with 256 descriptors."""
    monkeypatch.setattr(kneser_ney, "BUCKET_BYTES", 400)
    rows = [(i, text) for i, text in corpus() if zlib.crc32(str(i).encode()) % 7 != 2]
    model = kneser_ney.train(documents(spark, rows).select("text"))
    assert model.buckets > 200
    expected = {row[0]: row[6] for row in brute(rows)}
    before = resource.getrlimit(resource.RLIMIT_NOFILE)
    resource.setrlimit(resource.RLIMIT_NOFILE, (256, before[1]))
    try:
        reader = kneser_ney.Reader(model)
        for i, text in rows[::20] * 2:
            ((_, _, tokens),) = kneser_ney.ngrams(pa.array([text]), 2)
            assert reader.log10(tokens)[0].sum() == pytest.approx(expected[i])
            assert len(reader.open) <= reader.limit
    finally:
        resource.setrlimit(resource.RLIMIT_NOFILE, before)
