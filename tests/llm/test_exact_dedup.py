import hashlib
import re
from collections import defaultdict

import pytest

from tests.llm.rows import AWKWARD, awkward, clashing, collected, documents
from tidemark.llm import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((i, len(text or "")))
    out = []
    for i, text in rows:
        own = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        named = [(-n, j) for j, n in groups[own] if j is not None]
        keep = min(named)[1] if named else None
        sha = hashlib.sha256(own.encode()).hexdigest()
        out.append((i, keep, len(groups[own]), i == keep, sha))
    return sorted(out, key=repr)


@pytest.mark.parametrize("moduli", [exact_dedup.MODULI, (2,)])
def test_equals_brute_force_also_when_fingerprints_collide(spark, moduli):
    rows = AWKWARD + [(20 + i, f"te xt {i % 7}") for i in range(40)] + [(5, "another text")]
    found = exact_dedup.exact_duplicates(documents(spark, rows), moduli)
    assert collected(found) == brute(rows)


def test_clashing_columns_and_empty_table(spark):
    assert collected(exact_dedup.exact_duplicates(clashing(spark))) == brute(AWKWARD)
    assert exact_dedup.exact_duplicates(documents(spark, [])).count() == 0


def test_chunks_compose():
    data = bytes(range(256)) * 100
    for modulus in exact_dedup.MODULI:
        direct = 0
        for byte in data:
            direct = (direct * exact_dedup.BASE + byte) % modulus
        marks = exact_dedup.Fingerprints((modulus,)).of(data)
        assert int(marks, 16) == direct
        left, right = data[:777], data[777:]
        parts = [(int(exact_dedup.Fingerprints((modulus,)).of(x), 16), len(x)) for x in (left, right)]
        assert exact_dedup.combine(*parts, modulus) == (direct, len(data))


def test_without_copies_keeps_columns_and_rows_without_id(spark):
    kept = exact_dedup.without_copies(clashing(spark))
    assert kept.columns == clashing(spark).columns
    ids = [row["doc_id"] for row in kept.collect()]
    assert None in ids and ids.count(5) == 2 and 6 not in ids and sum(i in ids for i in (1, 2, 3)) == 1


def test_rows_without_an_id_go_as_copies_too(spark):
    rows = [(1, "a b c"), (None, "abc"), (None, "its own"), (None, "its own"), (2, "longest"),
            (None, "lon gest"), (None, "longes t"), (4, "x"), (7, "x")]
    kept = exact_dedup.without_copies(documents(spark, rows))
    assert collected(kept.select("doc_id", "text")) == sorted(
        [(1, "a b c"), (4, "x")] + [row for row in rows[2:7] if row[0] is None], key=repr
    )


def test_a_repeated_id_loses_only_the_copied_text(spark):
    rows = [(1, "a b c"), (5, "abc"), (5, "its own text"), (9, "its own  text")]
    kept = exact_dedup.without_copies(documents(spark, rows))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [
        (1, "a b c"), (9, "its own  text")
    ]
