"""Against all runs of sentences, not only the shortest from each."""

import hashlib
import random

import pytest

from tests.llm.rows import collected, documents
from tests.llm.test_sentence_spans import split
from tidemark.llm import sentence_spans as spans


def brute(rows, min_words=spans.MIN_WORDS, longest=spans.LONGEST):
    first, own = {}, []
    for i, text in rows:
        parts, runs = split(text, longest), []
        for k in range(len(parts)):
            for e in range(k + 1, len(parts) + 1):
                words = tuple(w for _, part in parts[k:e] for w in part)
                if len(words) >= min_words:
                    runs.append((k, e, words))
                    first[words] = min(first.get(words, i), i)
        own.append((parts, runs))
    out = []
    for (i, text), (parts, runs) in zip(rows, own):
        gone, seen = set(), set()
        for k, e, words in runs:
            if words in seen or first[words] < i:
                gone |= set(range(k, e))
            seen.add(words)
        edges = [start for start, _ in parts] + [len(text)]
        kept = text[: edges[0]]
        kept += "".join(text[edges[k] : edges[k + 1]] for k in range(len(parts)) if k not in gone)
        n_spans = sum(k in gone and k - 1 not in gone for k in range(len(parts)))
        out.append((i, len(parts), len(gone), n_spans, hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_last_sentences_of_a_passage_go_too(spark):
    passage = "a b c d e f g h i. j k l m n o p q r. s t u v. w x y."
    rows = [(1, passage + " One two three."), (2, passage + " Four five six.")]
    found = {row["doc_id"]: row["kept_text"] for row in spans.cleaned(documents(spark, rows)).collect()}
    assert found == {1: rows[0][1], 2: "Four five six."}


# Cuts of long sentences near the edges of a passage depend on what is around it; none here.
@pytest.mark.parametrize(("min_words", "longest"), [(18, 1000), (5, 1000)])
def test_equals_all_runs(spark, min_words, longest):
    draw = random.Random(min_words)
    stock = [" ".join(draw.choices("abcdefgh", k=draw.randrange(1, 25))) + draw.choice([".", "!", "", "?"])
             for _ in range(25)]
    rows = [(i, " ".join(draw.choices(stock, k=draw.randrange(1, 14)))) for i in range(120)]
    found = spans.digests(documents(spark, rows), min_words=min_words, longest=longest)
    assert collected(found) == brute(rows, min_words, longest)
