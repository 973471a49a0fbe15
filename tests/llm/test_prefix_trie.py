import hashlib
import random
import zlib

import duckdb
import pytest

from tests.conftest import SMALL
from tests.llm.rows import collected
from tidemark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """All nodes, from ``(conv_id, turn, role, text)``."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    nodes = {}
    for c, turns in built.items():
        for depth in range(len(turns) + 1):
            nodes.setdefault(turns[:depth], []).append(c)
    children, totals = {}, {}
    for node in nodes:
        if node:
            children.setdefault(node[:-1], []).append(node)
    for node in sorted(nodes, key=len, reverse=True):
        below = [totals[child] for child in children.get(node, [])]
        own_saved = (len(nodes[node]) - 1) * len(node[-1][1]) if node else 0
        totals[node] = (sum(t[0] for t in below) or 1, sum(t[1] for t in below) + own_saved)
    out = []
    for node, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if built[c] == node)
        out.append((
            min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members),
            len(children.get(node, [])), *totals[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def sample(seed, convs=400):
    draw = random.Random(seed)
    texts = ["", "héllo", "why", "so it goes", "\U0001f600 ok"]
    turn = lambda: (draw.choice(["user", "assistant", None]), draw.choice([*texts, None]))
    rows = []
    for c in range(convs):
        rows += [(c + draw.choice([0, 0, 900]), k, *turn()) for k in range(draw.randrange(1, 9))]
    same = [turn() for _ in range(40)]
    for c in (5001, 5002, 5003, 5107, *range(7000, 7160)):
        rows += [(c, k, *one) for k, one in enumerate(same[: 40 if c < 7000 else 8])]
    rows += [(9000, k, "user", f"turn {k}") for k in range(1500)]
    rows += [(9001, None, "user", "first"), (9001, -1, "user", "second"), (None, 1, "user", "no one's")]
    return rows


@pytest.mark.parametrize(("messages", "nodes", "ids"), [(200_000, 100_000, 4096), (3, 20, 7)])
def test_equals_brute_force(spark, monkeypatch, messages, nodes, ids):
    monkeypatch.setattr(prefix_trie, "QUEUE_MESSAGES", messages)
    monkeypatch.setattr(prefix_trie, "SHARD_NODES", nodes)
    monkeypatch.setattr(prefix_trie, "LIST_IDS", ids)
    rows = sample(messages)
    random.Random(1).shuffle(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = collected(prefix_trie.trie(spark.createDataFrame(rows, SCHEMA)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found == brute(rows)


def test_awkward_tables(spark):
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(3, 0, None, None), (3, 0, None, None), (3, 0, "", "x" * 5000), (-205, 1, "a", "b"), (7, 0, "a", "b")]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS depth", "'z' AS k1", "2 AS conv", "3 AS pid")
    # SQL's remainder has the sign of the id.
    expected = [r for r in brute([r for r in rows if r[0] >= 0])]
    assert [r for r in collected(prefix_trie.trie(frame.where("conv_id >= 0")))] == expected
    assert prefix_trie.trie(frame).where("depth = 0").first()["n_convs"] == 3


def test_given_table(spark):
    frame = spark.read.parquet(f"{SMALL}/conversations.parquet")
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in frame.collect()]
    assert collected(prefix_trie.trie(frame)) == brute(rows)


def test_queue_keeps_order_and_leaves_no_file(tmp_path):
    draw = random.Random(3)
    queue, messages = prefix_trie.Queue(str(tmp_path), 7), []
    for _ in range(200):
        message = (draw.randrange(-5, 0), draw.randrange(4), 0, draw.randrange(9), 1)
        messages.append(message)
        queue.push(message)
    found = [list(queue.pop(key)) for key in sorted({m[:3] for m in messages})]
    assert [sorted(m) for m in found] == [
        sorted(m for m in messages if m[:3] == key) for key in sorted({m[:3] for m in messages})
    ]
    assert list(tmp_path.iterdir()) == []


@pytest.mark.parametrize("table", [SMALL, SMALL.replace("0.001", "0.01")])
def test_equals_sql(spark, table):
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{table}/conversations.parquet'")
    found = prefix_trie.trie(spark.read.parquet(f"{table}/conversations.parquet"))
    assert collected(found) == sorted(con.sql(prefix_trie.ORACLE_SQL).fetchall(), key=repr)
