import hashlib
import random
import resource

import duckdb
import numpy as np
import pytest

from tests.conftest import SMALL
from tests.llm.rows import AWKWARD, awkward, clashing, collected, documents
from tidemark.llm import line_dedup

SPACES = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACES))


def brute(rows):
    owners = {}
    own = [(line_dedup.LAST if i is None else i, (text or "").split("\n")) for i, text in rows]
    for i, lines in own:
        for line in lines:
            owners.setdefault(key_of(line), set()).add(i)
    out = []
    for (doc_id, _), (i, lines) in zip(rows, own):
        kept = [
            line for line in lines
            if len(key_of(line)) < 10 or len(owners[key_of(line)]) < 2 or min(owners[key_of(line)]) == i
        ]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((doc_id, len(lines), len(lines) - len(kept), digest))
    return sorted(out, key=repr)


def sample():
    draw = random.Random(12)
    stock = ["".join(draw.choices("abÀé \t", k=draw.randrange(0, 30))) for _ in range(300)]
    stock += ["exactly 10", "nine char", "  Exactly 10\r", "ééééééééé", "éééééééééé"]
    rows = [(i, "\n".join(draw.choices(stock, k=draw.randrange(0, 40)))) for i in range(200)]
    rows += [(i, stock[0] + "a line that many share, by far the most\n" * 2) for i in range(200, 400)]
    return rows + [(3, "\n".join(stock[:20])), (None, "\n".join(stock)), (None, "\n".join(stock))]


@pytest.mark.parametrize(("keys", "files"), [(1 << 21, 64), (3, 2)])
def test_equals_brute_force(spark, monkeypatch, keys, files):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", keys)
    monkeypatch.setattr(line_dedup, "OPEN_SHARDS", files)
    monkeypatch.setattr(line_dedup, "LOOKUP_BYTES", 3000)
    rows = sample()
    assert collected(line_dedup.digests(documents(spark, rows))) == brute(rows)


def test_awkward_rows(spark):
    expected = brute(AWKWARD)
    assert collected(line_dedup.digests(awkward(spark))) == expected
    assert collected(line_dedup.digests(clashing(spark))) == expected
    assert line_dedup.digests(documents(spark, [])).count() == 0


def test_perfect_hash_is_minimal_and_tells_strangers(tmp_path):
    draw = np.random.default_rng(1)
    keys = draw.integers(-(2**63), 2**63 - 1, (2, 20000))
    keys[0, 10000:] = keys[0, :10000]  # equal first halves
    assert sorted(line_dedup.perfect_hash(*keys)[2].tolist()) == list(range(20000))
    counts, firsts = draw.integers(2, 2**33, 20000), draw.integers(0, 2**62, 20000)
    np.save(tmp_path / "0.npy", line_dedup.shard_file(*keys, counts, firsts))
    shard = line_dedup.Shard(f"{tmp_path}/0.npy")
    found = shard.probe(*keys)
    assert (found[0] == np.minimum(counts, line_dedup.MOST)).all() and (found[1] == firsts).all()
    others = draw.integers(-(2**63), 2**63 - 1, (2, 20000))
    assert not shard.probe(*others)[0].any()
    assert len(shard.words) * 8 < 22 * 20000 + 1000


def test_few_files_are_open(tmp_path):
    for number in range(400):
        words = line_dedup.shard_file(*(np.array([k], np.int64) for k in (number, 7, 2, 1)))
        np.save(tmp_path / f"{number}.npy", words)
    before = resource.getrlimit(resource.RLIMIT_NOFILE)
    resource.setrlimit(resource.RLIMIT_NOFILE, (256, before[1]))
    try:
        index = line_dedup.Shards(str(tmp_path), 400)
        high = np.arange(400)
        for _ in range(2):
            assert (index.probe(high, np.full(400, 7))[0] == 2).all()
    finally:
        resource.setrlimit(resource.RLIMIT_NOFILE, before)


@pytest.mark.parametrize("table", [SMALL, SMALL.replace("0.001", "0.01")])
def test_equals_sql(spark, table):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{table}/documents.parquet'")
    found = line_dedup.digests(spark.read.parquet(f"{table}/documents.parquet"))
    assert collected(found) == sorted(con.sql(line_dedup.ORACLE_SQL).fetchall(), key=repr)
