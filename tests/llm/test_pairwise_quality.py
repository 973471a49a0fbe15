import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tests.conftest import SMALL
from tests.llm.rows import AWKWARD, awkward, clashing, collected, documents
from tidemark.llm import all_pairs
from tidemark.llm import pairwise_quality as quality
from tidemark.llm import text as text_helpers

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    folder = SMALL.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = quality.scores(docs, labels).join(labels, "doc_id").collect()
    held = [row for row in found if row["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    right = sum(row["predicted"] == row["quality"] for row in held)
    assert len(held) > 50 and right / len(held) > 0.95
    kept_poor = [row for row in held if row["quality"] == 0 and row["predicted"] == 1]
    assert len(kept_poor) < 0.25 * sum(row["quality"] == 0 for row in held)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, LABELS)


def test_awkward_rows_are_all_scored(spark):
    labels = labels_of(spark, [(5, 1, 0), (8, 0, 0), (8, 0, 1), (4, 0, 0), (4, 1, 0), (9, None, 0), (None, 1, 0)])
    found = collected(quality.scores(awkward(spark), labels))
    assert len(found) == len(AWKWARD)
    assert all(0 <= row[2] <= 1 and row[3] == (row[2] >= 0.7) for row in found)
    assert found == collected(quality.scores(clashing(spark), labels))
    score = {row[0]: row[2] for row in found}
    assert score[1] == score[2]


def test_nothing_to_learn_keeps_all(spark):
    for rows in ([], [(5, 1, 0)]):
        found = quality.scores(awkward(spark), labels_of(spark, rows)).collect()
        assert {row["predicted"] for row in found} == {1}
    assert quality.scores(documents(spark, []), labels_of(spark, [])).count() == 0
    kept = quality.good_documents(clashing(spark), labels_of(spark, []))
    assert kept.columns == clashing(spark).columns and kept.count() == len(AWKWARD)


def test_rows_without_id_and_of_a_repeated_id_are_judged_each(spark):
    good = [f"This is sentence {i} of a text that was written with some care." for i in range(80)]
    poor = [f"## {i} || $$ BUY!! 00{i} ((" for i in range(80)]
    rows = [(i, text) for i, text in enumerate(good + poor)]
    labels = labels_of(spark, [(i, int(i < 80), 0) for i in range(160)])
    added = [(None, good[0]), (None, poor[0]), (3, poor[1]), (200, good[2]), (200, poor[3])]
    kept = quality.good_documents(documents(spark, rows + added), labels)
    texts = [(row["doc_id"], row["text"]) for row in kept.collect()]
    assert [row in texts for row in added] == [True, False, False, True, False]
    assert (3, good[3]) in texts


def test_features_do_not_depend_on_neighbours(monkeypatch):
    texts = ["One, two.\nOne, two.\n", "", "ABC def!! 12 | x", "é ü", "a\n\n\nb c c", "tail\n"]
    together = quality.features(pa.array(texts))
    for i, one in enumerate(texts):
        assert together[i] == pytest.approx(quality.features(pa.array([one]))[0])
    monkeypatch.setattr(text_helpers, "PIECE_BYTES", 8)
    assert quality.features(pa.array(texts[::-1]))[::-1] == pytest.approx(together)


def test_pairs_order_documents():
    draw = np.random.default_rng(0)
    width = len(quality.SINGLE) + quality.SHAPES
    table = draw.normal(size=(600, width))
    label = (table[:, 3] + 0.1 * draw.normal(size=600) > -0.8).astype(int)
    model = quality.learn(table, label, (label == 0).mean(), 5000)
    assert ((model.score(table) >= 0.7) == label).mean() > 0.95


def slow_strengths(table, label, pairs):
    """Bradley and Terry's likelihood with a ridge, climbed step by step from its formula."""
    mean, scale = table.mean(axis=0), table.std(axis=0) + 1e-6
    plain = np.clip((table - mean) / scale, -8, 8)
    known = np.hstack([plain, plain * plain])
    draw = np.random.default_rng(9)
    better = draw.choice(np.flatnonzero(label == 1), pairs)
    worse = draw.choice(np.flatnonzero(label == 0), pairs)
    gaps = np.array([known[i] - known[j] for i, j in zip(better, worse)])

    def slope(weights):
        return gaps.T @ (1 / (1 + np.exp(gaps @ weights))) - quality.RIDGE * weights

    step = 1 / (quality.RIDGE + np.linalg.norm(gaps, 2) ** 2 / 4)
    weights = ahead = np.zeros(gaps.shape[1])
    pull = (1 - np.sqrt(step)) / (1 + np.sqrt(step))
    for _ in range(60_000):
        following = ahead + step * slope(ahead)
        weights, ahead = following, following + pull * (following - weights)
        if np.abs(slope(weights)).max() < 1e-7:
            break
    assert np.abs(slope(weights)).max() < 1e-4
    return weights, known @ weights


def test_equals_slow_ranking(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("text is not null")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").where("quality is not null")
    rows = sorted(docs.join(labels, "doc_id").select("doc_id", "quality", "text").collect())
    label = np.array([row["quality"] for row in rows])
    table = quality.features(pa.array([row["text"] for row in rows])).astype(np.float64)
    poor = float((label == 0).mean())
    model = quality.learn(table, label, poor, 800)
    weights, strengths = slow_strengths(table, label, 800)
    assert len(rows) > 50 and 0 < poor < 1
    assert model.weights == pytest.approx(weights, abs=1e-4)
    cut = np.quantile(strengths, poor)
    assert model.cut == pytest.approx(cut, abs=1e-3)
    expected = 1 / (1 + np.exp(-(strengths - cut) - np.log(0.7 / 0.3)))
    assert model.score(table) == pytest.approx(expected, abs=1e-3)


def all_pairs_scores(tables, table, label):
    """Scores by the likelihood of every pair of a good and a poor row, each pair by itself."""
    mean, scale = table.mean(axis=0), table.std(axis=0) + 1e-6

    def plain(rows):
        clipped = np.clip((rows - mean) / scale, -8, 8)
        return np.hstack([clipped, clipped**2])

    known = plain(table)
    good, poor = known[label == 1], known[label == 0]
    gaps = (good[:, None] - poor[None, :]).reshape(-1, known.shape[1])
    share, weights = quality.PAIRS / len(gaps), np.zeros(known.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(gaps @ weights))
        slope = share * gaps.T @ p - quality.RIDGE * weights
        curve = share * (gaps * (p * (1 - p))[:, None]).T @ gaps
        step = np.linalg.solve(curve + quality.RIDGE * np.eye(len(weights)), slope)
        weights += step
    assert np.abs(step).max() < 1e-9
    cut = np.quantile(known @ weights, (label == 0).mean())
    return 1 / (1 + np.exp(-(plain(tables) @ weights - cut) - np.log(0.7 / 0.3)))


def brute_scores(rows):
    """Brute-force scores by id of rows ``doc_id, text, quality``, the quality None where unknown."""
    table = quality.features(pa.array([text for _, text, _ in rows])).astype(np.float64)
    taught = [
        i for i, (key, _, mark) in enumerate(rows)
        if mark is not None and zlib.crc32(str(key).encode()) % 4 != 2
    ]
    label = np.array([rows[i][2] for i in taught])
    return dict(zip([row[0] for row in rows], all_pairs_scores(table, table[taught], label)))


def test_all_rows_and_pairs_teach(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = [
        (row["doc_id"], row["text"], row["quality"])
        for row in docs.join(labels, "doc_id", "left").collect()
    ]
    expected = brute_scores(rows)
    found = {row["doc_id"]: row["score"] for row in quality.scores(docs, labels).collect()}
    assert found == pytest.approx(expected, abs=1e-6)


def test_rows_beyond_the_old_sample_teach(spark):
    """Of 36,000 short texts 27,001 teach; mean, scale and cut are those of all of them."""
    texts = [f"{'(' * (i % 7)} w{i % 11} {'|' * (i % 13 == 0)} {i}" for i in range(36_000)]
    rows = [(i, text) for i, text in enumerate(texts)]
    marks = [int(i % 13 != 0) for i in range(36_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame(list(enumerate(marks)), "doc_id long, quality int")
    known = quality.described(docs).join(labels, "doc_id")
    known = known.where(~text_helpers.held_out(known["doc_id"], 4))
    taught = np.array([zlib.crc32(str(i).encode()) % 4 != 2 for i in range(36_000)])
    table = quality.features(pa.array(texts)).astype(np.float64)[taught]
    model = quality.learned(known.localCheckpoint())
    assert len(table) == 27_001
    assert model.mean == pytest.approx(table.mean(axis=0), rel=1e-9)
    assert model.scale == pytest.approx(table.std(axis=0) + 1e-6, rel=1e-9)
    poor = 1 - np.array(marks)[taught].mean()
    assert model.cut == pytest.approx(np.quantile(model.strength(table), poor), abs=1e-9)


def test_rows_of_a_repeated_id_teach_alike_in_any_order(spark):
    """An id teaches once, by the text with the least hash, wherever its rows lie."""
    rows = [
        (i, f"{'(' * (i * (1 + 2 * second) % 7)} w{i % 11}{second} {'|' * (i % 3 == 0)} {i}")
        for i in range(120)
        for second in (0, 1)
    ]
    mark = {i: int(i % 3 != 0 or i % 4 == 0) for i in range(120)}
    key = {text: np.uint64(xxhash.xxh64_intdigest(text, 42)).astype(np.int64) for _, text in rows}
    least = [min(rows[2 * i : 2 * i + 2], key=lambda row: key[row[1]]) for i in range(120)]
    taught = [row for row in least if zlib.crc32(str(row[0]).encode()) % 4 != 2]
    label = np.array([mark[i] for i, _ in taught])
    table, own = (
        quality.features(pa.array([text for _, text in some])).astype(np.float64)
        for some in (rows, taught)
    )
    scores = all_pairs_scores(table, own, label)
    expected = [score for _, score in sorted((i, s) for (i, _), s in zip(rows, scores))]
    labels = labels_of(spark, [(i, one, 0) for i, one in mark.items()])
    for order in (rows, rows[::-1]):
        found = quality.scores(documents(spark, order).coalesce(1), labels).collect()
        assert [s for _, s in sorted((row["doc_id"], row["score"]) for row in found)] == pytest.approx(
            expected, abs=1e-6
        )


def test_quantile_is_exact(spark, monkeypatch):
    monkeypatch.setattr(quality, "FEW", 5)
    draw = np.random.default_rng(4)
    values = [*draw.normal(size=300), *[0.25] * 200, 1e9, -1e-300, 0.0]
    rows = spark.createDataFrame([(float(v),) for v in values], "strength double")
    for share in (0.0, 0.1, 0.5, 0.61, 0.999, 1.0):
        assert quality.quantile(rows, share) == np.quantile(values, share)


def test_sums_over_pairs_of_far_and_near_numbers():
    draw = np.random.default_rng(1)
    left, right = draw.normal(0, 9, 200), draw.normal(3, 20, 150)
    found = np.unique(np.concatenate([all_pairs.cells(left), all_pairs.cells(right)]))
    places = all_pairs.nodes(found).ravel()
    on = []
    for values in (left, right):
        cell, weights = all_pairs.spread(values)
        on.append(sum(np.outer(found == c, w).ravel() for c, w in zip(cell, weights)))
    for function in (all_pairs.sigmoid, all_pairs.sigmoid_slope, all_pairs.softplus):
        expected = function(right[None, :] - left[:, None]).sum()
        assert on[0] @ all_pairs.paired(function, places, on[1]) == pytest.approx(expected, rel=1e-10)
