import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import SMALL
from tests.llm.rows import AWKWARD, awkward, clashing, collected, documents
from tidemark.llm import langid_crf as crf
from tidemark.llm.text import Powers, pieces


@pytest.fixture(scope="module")
def trained(spark):
    folder = SMALL.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = crf.languages(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    return docs, found


def test_held_out_accuracy(trained):
    _, found = trained
    held = [row for row in found if row["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    right = sum(row["lang_pred"] == row["lang"] for row in held)
    assert len(held) > 100 and right / len(held) > 0.98
    assert all(0 <= row["score"] <= 1 for row in found)


def test_words_of_code_switched_text(trained, spark):
    docs, _ = trained
    model = crf.train(*crf.sample(docs))
    rows = {row["lang"]: row["text"].split()[:25] for row in docs.collect() if len(row["text"]) > 800}
    names = sorted(rows)[:3]
    text = " ".join(" ".join(rows[name]) for name in names)
    words = crf.word_labels(documents(spark, [(1, text), (2, None), (3, "12 ..")]), model).collect()
    by_id = {row["doc_id"]: row["words"] for row in words}
    assert by_id[2] == by_id[3] == []
    truth = [name for name in names for word in rows[name] for _ in crf_words(word)]
    right = sum(word["lang"] == name for word, name in zip(by_id[1], truth))
    assert len(truth) == len(by_id[1]) and right / len(truth) > 0.85


def crf_words(word):
    data = np.frombuffer(word.encode(), np.uint8)
    return crf.letter_words(data, np.array([0, len(data)]))[0]


def brute_marginals(weights, transitions):
    """Every path of one sequence, by its weight."""
    n, k = weights.shape
    result = np.zeros((n, k))
    for number in range(k**n):
        path = [number // k**i % k for i in range(n)]
        weight = weights[range(n), path].sum()
        weight += sum(transitions[a, b] for a, b in zip(path, path[1:]))
        weight += np.log(np.exp(transitions[:, path[0]]).mean())
        result[range(n), path] += np.exp(weight)
    return result / result.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("block", [1, 2, 3, 32])
def test_marginals_equal_all_paths(monkeypatch, block):
    monkeypatch.setattr(crf, "BLOCK", block)
    draw = np.random.default_rng(block)
    transitions = draw.normal(size=(3, 3))
    sizes = [1, 5, 2, 7]
    weights = draw.normal(size=(sum(sizes), 3)) * 2
    rows = np.repeat([0, 2, 3, 9], sizes)
    found = crf.marginals(weights, transitions, rows)
    cuts = np.cumsum([0, *sizes])
    for start, stop in zip(cuts[:-1], cuts[1:]):
        expected = brute_marginals(weights[start:stop], transitions)
        assert found[start:stop] == pytest.approx(expected)


def test_slopes_are_those_of_the_likelihood():
    draw = np.random.default_rng(4)
    transitions, weights = draw.normal(size=(3, 3)), draw.normal(size=(2, 5, 3))
    target = draw.integers(0, 3, size=(2, 5))
    by_word, by_step = crf.slopes(weights, transitions, target)
    for s in range(2):
        known = np.eye(3)[target[s]]
        assert by_word[s] == pytest.approx(known - brute_marginals(weights[s], transitions))
    assert by_step.sum() == pytest.approx(0)


def test_awkward_rows(spark):
    rows = [(i, t, lang) for (i, t), lang in zip(AWKWARD, ["en", "fr"] * 10)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {row["doc_id"]: row for row in crf.languages(table).collect()}
    for i in (1, 2, 3):
        assert found[i]["lang_pred"] == "und" and found[i]["score"] == 0
    assert all(found[i]["lang_pred"] in ("en", "fr") for i in (4, 5, 8, 9, 10, 11))

    long = [(i, text * 3000, lang) for i, (text, lang) in enumerate(
        [("the words here ", "en"), ("les mots ici ", "fr")] * 8)]
    table = spark.createDataFrame(long, "doc_id long, text string, lang string")
    texts, langs = crf.sample(table)
    assert set(langs) == {"en", "fr"} and {len(text) for text in texts} == {45000, 39000}
    assert all(r["lang_pred"] == long[r["doc_id"]][2] for r in crf.languages(table).collect())

    for table in (awkward(spark), clashing(spark)):
        found = collected(crf.languages(table))
        assert len(found) == len(AWKWARD)
        assert {row[2] for row in found} == {"en", "und"}


def test_letters_of_any_script_and_none(spark):
    rows = [(0, "text one two", "en"), (1, "12 345 \U0001f600 …", "en"), (3, "漢字", None), (4, "Ω", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {row["doc_id"]: row["lang_pred"] for row in crf.languages(table).collect()}
    assert found == {0: "en", 1: "und", 3: "en", 4: "en"}


def test_nothing_to_learn_and_empty_table(spark):
    unlabelled = documents(spark, AWKWARD).selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {row["lang_pred"] for row in crf.languages(unlabelled).collect()} == {"und"}
    assert crf.languages(documents(spark, [])).count() == 0


def test_words_do_not_depend_on_neighbours():
    powers = Powers()
    texts = ["ab cd", "", "é1xyz.", "the the"]
    (piece,) = pieces(pa.array(texts))
    starts, ends, rows = crf.letter_words(piece.data, piece.offsets)
    assert [piece.data[s:e].tobytes().decode() for s, e in zip(starts, ends)] == [
        "ab", "cd", "é", "xyz", "the", "the",
    ]
    together = crf.evidence(piece.data, starts, ends, powers)
    for i, (start, end) in enumerate(zip(starts, ends)):
        own = crf.evidence(piece.data[start:end], np.array([0]), np.array([end - start]), powers)
        assert own.hashes[0] == together.hashes[i]
        assert own.affixes[0].tolist() == together.affixes[i].tolist()
        assert own.trigram.tolist() == together.trigram[together.trigram_word == i].tolist()
