import duckdb
import pytest

from tests.conftest import SMALL
from tests.llm.rows import awkward, clashing, collected, documents
from tidemark.llm import licence_rules as rules

S = rules.SENTENCES
MIT = "\n\n".join([
    "MIT License", "Copyright (c) 2020 Someone", S["mit-grant"], S["mit-condition"], S["mit-as-is"],
])
BSD = (
    S["bsd-redistribution"] + "\n\n1. " + S["bsd-source"] + "\n2. " + S["bsd-binary"] + "\n\n3. "
    + S["bsd-names"]
)


def wrapped(text, width=40):
    """The text with its lines broken inside sentences."""
    lines, line = [], ""
    for word in text.split(" "):
        if len(line) + len(word) > width:
            lines.append(line)
            line = word
        else:
            line = f"{line} {word}".strip()
    return "\n".join([*lines, line])


CASES = [
    (1, "Some text. Released under the MIT License.", {"MIT"}),
    (2, "Some text\nReleased under the MIT License\nmore text", {"MIT"}),
    (3, MIT, {"MIT"}),
    (4, wrapped(S["mit-grant"]) + "\n\n" + wrapped(S["mit-condition"] + " " + S["mit-as-is"]), {"MIT"}),
    (5, S["mit-condition"] + "\n\n" + S["mit-grant"] + "\n\n" + S["mit-as-is"], set()),
    (6, BSD, {"BSD-3-Clause"}),
    (7, S["gpl-redistribute-3"] + " " + S["gpl-warranty"], {"GPL-3.0-or-later"}),
    (8, S["gpl-redistribute-3"] + " A. B. C. D. E. " + S["gpl-warranty"], set()),
    (9, "Not released under the MIT License.", set()),
    (10, "Licensed under CC BY-NC 4.0. LICENSED UNDER THE APACHE LICENSE, version 2.0!", {"CC-BY-NC-4.0", "Apache-2.0"}),
    (11, None, set()), (12, "", set()), (13, " . . \n\n", set()),
]


def by_id(rows):
    out = {}
    for row in rows.collect():
        out.setdefault(row["doc_id"], set()).add(row["licence"])
    return out


def test_cases(spark):
    found = by_id(rules.licences(documents(spark, [case[:2] for case in CASES])))
    assert found == {i: names for i, _, names in CASES if names}


def test_repeated_rows_awkward_rows_and_names(spark):
    twice = documents(spark, [CASES[0][:2]] * 2 + [(None, CASES[0][1])])
    assert collected(rules.licences(twice)) == sorted(
        [(1, "MIT", "mit-notice"), (None, "MIT", "mit-notice")], key=repr
    )
    assert rules.licences(awkward(spark)).count() == 0
    assert rules.licences(clashing(spark)).count() == 0
    assert rules.licences(documents(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = rules.licences(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(name in plan for name in ("Python", "Arrow", "Pandas"))


@pytest.mark.parametrize("table", ["cases", SMALL, SMALL.replace("0.001", "0.01")])
def test_equals_sql(spark, table):
    con = duckdb.connect()
    if table == "cases":
        rows = documents(spark, [case[:2] for case in CASES])
        frame = rows.toPandas()  # noqa: F841
        con.sql("create view documents as select * from frame")
    else:
        rows = spark.read.parquet(f"{table}/documents.parquet")
        con.sql(f"create view documents as select * from '{table}/documents.parquet'")
    assert collected(rules.licences(rows)) == sorted(con.sql(rules.oracle_sql()).fetchall(), key=repr)
