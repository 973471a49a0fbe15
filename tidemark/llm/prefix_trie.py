"""The trie of conversation prefixes, its subtree totals by time-forward processing.

Turns are sorted by conversation across all tasks; a prefix is known by a polynomial over the
hashes of its turns, modulo 2**64 in two lanes, which composes, so a conversation of any
length is spread over tasks. Equal prefixes of all conversations make a node.

Totals run from the leaves to the root. Nodes of one conversation alone have known totals.
Of the others, those with more members than the square root of all turns are the top: no more
than that root of them. Every subtree below the top holds at most as many conversations, and
the subtrees are dealt to shards. In a shard nodes are sorted externally, by Spark, from the
deepest level up; each takes its children's totals from a priority queue and puts its own in
for its parent. The queue spills sorted runs to the shared folder. What the roots of the
subtrees pass on is added up by parent, and the top goes through the same pass.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import mounted, stored
from tidemark.llm.text import BASE, BASE_INVERSE
from tidemark.session import scratch_path

#: Turns that a conversation can take from the first of its hundred.
FAMILY = 100
MOST_HEAD = 5
#: Nodes in a shard, about; messages that a queue holds in memory; ids in one piece of a list.
SHARD_NODES = 100_000
QUEUE_MESSAGES = 200_000
LIST_IDS = 4096

KEY = ("depth", "k1", "k2")
PARENT = ("q1", "q2")
WORD = 1 << 64

OWN = "conv long, pid long, j long, t1 long, t2 long, l1 long, l2 long, chars long"
ROW = (
    "conv long, depth long, k1 long, k2 long, q1 long, q2 long, chars long, is_end boolean"
)
TOTAL = "depth long, k1 long, k2 long, up boolean, n_children long, n_leaves long, saved long"


def signed(value: int) -> int:
    """A word of 64 bits as a long."""
    value %= WORD
    return value - WORD if value >= WORD >> 1 else value


def power(exponent: int) -> int:
    return pow(int(BASE if exponent >= 0 else BASE_INVERSE), abs(exponent), WORD)


def powers(exponents: np.ndarray) -> np.ndarray:
    """The base to each exponent, none negative."""
    result, square = np.ones(len(exponents), np.uint64), int(BASE)
    left = exponents.astype(np.uint64)
    while left.any():
        odd = left & np.uint64(1) == 1
        result[odd] *= np.uint64(square)
        square, left = square * square % WORD, left >> np.uint64(1)
    return result


def turns(conversations: DataFrame) -> DataFrame:
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        role.alias("role"),
        F.xxhash64(role, text).alias("t1"),
        F.xxhash64(F.lit(1), role, text).alias("t2"),
        F.char_length(text).cast("long").alias("chars"),
    ).where("conv is not null")


def numbered(conversations: DataFrame) -> DataFrame:
    """Each turn with its number ``j`` in its conversation's part of a task, ``pid``, and the
    polynomials ``l1, l2`` of that part up to and with the turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, last, seen, sums = TaskContext.get().partitionId(), None, 0, np.zeros(2, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column(0).to_numpy()
            begins = np.ones(len(conv), bool)
            begins[1:] = conv[1:] != conv[:-1]
            first = np.flatnonzero(begins)
            segment = np.cumsum(begins) - 1
            goes_on = last is not None and conv[0] == last
            j = np.arange(len(conv)) - first[segment]
            j[segment == 0] += seen if goes_on else 0
            lanes = []
            for lane in (0, 1):
                terms = batch.column(1 + lane).to_numpy().view(np.uint64) * powers(j)
                running = np.cumsum(terms)
                before = (running - terms)[first]
                before[0] -= sums[lane] if goes_on else np.uint64(0)
                lanes.append(running - before[segment])
            last, seen = conv[-1], int(j[-1]) + 1
            sums = np.array([lane[-1] for lane in lanes], np.uint64)
            columns = [batch.column(0), pa.array(np.full(len(conv), pid)), pa.array(j)]
            columns += [batch.column(1), batch.column(2)]
            columns += [pa.array(lane.view(np.int64)) for lane in lanes] + [batch.column(3)]
            yield pa.RecordBatch.from_arrays(
                columns, ["conv", "pid", "j", "t1", "t2", "l1", "l2", "chars"]
            )

    order = ["conv", "turn", "role", "t1", "t2"]
    return (
        turns(conversations)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv", "t1", "t2", "chars")
        .mapInArrow(run, OWN)
    )


def parts_of(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv, pid, n_part``; and where parts of divided conversations begin: ``offset, p1, p2``.

    Sorted by conversation, a task shares at most its first and its last one with others, so
    the second table has at most two rows for each task.
    """
    parts = stored(
        own.groupBy("conv", "pid").agg(
            F.count("*").alias("n_part"), F.max_by(F.struct("l1", "l2"), "j").alias("total")
        ),
        "trie-parts",
    )
    several = (
        parts.groupBy("conv")
        .agg(F.sort_array(F.collect_list(F.struct("pid", "n_part", "total"))).alias("parts"))
        .where(F.size("parts") > 1)
        .collect()
    )
    begins = []
    for row in several:
        offset, sums = 0, (0, 0)
        for part in row["parts"]:
            begins.append((row["conv"], part["pid"], offset, *map(signed, sums)))
            step = power(offset)
            sums = tuple(s + step * value for s, value in zip(sums, part["total"]))
            offset += part["n_part"]
    frame = own.sparkSession.createDataFrame(
        begins, "conv long, pid long, offset long, p1 long, p2 long"
    )
    return parts.drop("total"), F.broadcast(frame)


def heads(own: DataFrame, begins: DataFrame) -> DataFrame:
    """``conv, head``: the first turns of each conversation, in order."""
    place = F.coalesce("offset", F.lit(0)) + F.col("j")
    return (
        own.where(F.col("j") < MOST_HEAD)
        .join(begins.select("conv", "pid", "offset"), ["conv", "pid"], "left")
        .where(place < MOST_HEAD)
        .groupBy("conv")
        .agg(F.sort_array(F.collect_list(F.struct(place.alias("place"), "t1", "t2", "chars"))).alias("head"))
    )


def rebuilding(own: DataFrame, parts: DataFrame, begins: DataFrame) -> DataFrame:
    """One row for each conversation: its length, the turns replaced, and both heads."""
    first = stored(heads(own, begins), "trie-heads")
    sizes = parts.groupBy("conv").agg(F.sum("n_part").alias("n_own"))
    remainder = F.crc32(F.col("conv").cast("string").cast("binary")) % (MOST_HEAD + 1)
    base = first.select(F.col("conv").alias("base"), F.col("head").alias("base_head"))
    return (
        first.join(sizes, "conv")
        .withColumn("h", remainder)
        .withColumn("base", F.col("conv") - F.col("conv") % FAMILY)
        .join(base, "base", "left")
        .select("conv", "n_own", "h", F.coalesce("base_head", F.array()).alias("base_head"), "head")
    )


def polynomials(head: list[dict], count: int) -> list[tuple[int, int]]:
    """The polynomials of the first 0 to ``count`` turns."""
    sums = [(0, 0)]
    for place, turn in enumerate(head[:count]):
        step = power(place)
        sums.append(tuple(s + step * turn[t] for s, t in zip(sums[-1], ("t1", "t2"))))
    return sums


def head_rows(info: DataFrame) -> DataFrame:
    """The root and the nodes of the turns taken over, for each conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                taken = min(row["h"], len(row["base_head"]))
                length = taken + max(0, row["n_own"] - row["h"])
                keys = polynomials(row["base_head"], taken)
                out.append((row["conv"], 0, 0, 0, None, None, 0, length == 0))
                for depth in range(1, taken + 1):
                    own, parent = map(signed, keys[depth]), map(signed, keys[depth - 1])
                    chars = row["base_head"][depth - 1]["chars"]
                    out.append((row["conv"], depth, *own, *parent, chars, length == depth))
            yield batch_of(out, ROW)

    return info.mapInArrow(run, ROW)


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [field.split() for field in schema.split(", ")]
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(column), kinds[kind]) for column, (_, kind) in zip(columns, fields)],
        [name for name, _ in fields],
    )


PLAN = "conv long, pid long, h long, offset long, taken long, length long, a1 long, a2 long, m long"


def part_plans(info: DataFrame, parts: DataFrame, begins: DataFrame) -> DataFrame:
    """What makes a key of a part's polynomial: ``a + m * l``, for both lanes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                taken = min(row["h"], len(row["base_head"]))
                step = power(taken - row["h"])
                theirs = polynomials(row["base_head"], taken)[-1]
                mine = polynomials(row["head"], row["h"])[-1]
                shifts = [
                    signed(t - step * o + step * p)
                    for t, o, p in zip(theirs, mine, (row["p1"], row["p2"]))
                ]
                length = taken + max(0, row["n_own"] - row["h"])
                m = signed(step * power(row["offset"]))
                out.append((row["conv"], row["pid"], row["h"], row["offset"], taken, length, *shifts, m))
            yield batch_of(out, PLAN)

    return (
        info.join(parts.select("conv", "pid"), "conv")
        .join(begins, ["conv", "pid"], "left")
        .fillna(0, ["offset", "p1", "p2"])
        .mapInArrow(run, PLAN)
    )


def own_rows(own: DataFrame, plans: DataFrame) -> DataFrame:
    """The nodes of the turns that conversations keep. Parts join, so no conversation is hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {name: batch.column(name).to_numpy() for name in batch.schema.names}
            word = {name: column[name].view(np.uint64) for name in ("m", "t1", "t2", "l1", "l2", "a1", "a2")}
            depth = column["offset"] + column["j"] - column["h"] + column["taken"] + 1
            last = word["m"] * powers(column["j"])
            keys = [word[f"a{lane}"] + word["m"] * word[f"l{lane}"] for lane in (1, 2)]
            parents = [key - last * word[f"t{lane}"] for lane, key in zip((1, 2), keys)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), pa.array(depth)]
                + [pa.array(words.view(np.int64)) for words in (*keys, *parents)]
                + [batch.column("chars"), pa.array(depth == column["length"])],
                ["conv", "depth", "k1", "k2", "q1", "q2", "chars", "is_end"],
            )

    kept = own.join(plans, ["conv", "pid"]).where(F.col("offset") + F.col("j") >= F.col("h"))
    return kept.mapInArrow(run, ROW)


class Queue:
    """Totals on their way to parents, least ``(-depth, k1, k2)`` first.

    Beyond ``limit`` messages, all are written as a sorted run, of which only a block is read
    at a time. Messages are lists ``(-depth, k1, k2, leaves, saved)``.
    """

    def __init__(self, folder: str, limit: int) -> None:
        self.folder, self.limit, self.heap, self.runs = folder, limit, [], []

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            path = f"{self.folder}/{uuid.uuid4().hex}.npy"
            np.save(path, np.array(sorted(self.heap), np.int64))
            self.heap = []
            run = self.read(path)
            heapq.heappush(self.runs, (next(run), id(run), run))

    def read(self, path: str) -> Iterator[tuple]:
        messages = np.load(path, mmap_mode="r")
        for start in range(0, len(messages), 4096):
            yield from map(tuple, messages[start : start + 4096].tolist())
        del messages
        os.remove(path)

    def pop(self, key: tuple) -> Iterator[tuple]:
        """All messages for ``key``; none for smaller keys may be left."""
        while self.heap and self.heap[0][:3] == key:
            yield heapq.heappop(self.heap)
        while self.runs and self.runs[0][0][:3] == key:
            message, number, run = self.runs[0]
            yield message
            following = next(run, None)
            if following is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (following, number, run))


def forward(nodes: DataFrame, folder: str, limit: int) -> DataFrame:
    """Totals of nodes sorted from the deepest level up in each partition.

    ``nodes`` have what is known before: ``n_children, n_leaves, saved``, the last with the
    node's own share. Where ``up``, the parent is elsewhere and gets a row with that mark.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = Queue(folder, limit)
        for batch in batches:
            out = []
            for depth, k1, k2, q1, q2, up, children, leaves, saved in zip(
                *(column.to_pylist() for column in batch.columns)
            ):
                for message in queue.pop((-depth, k1, k2)):
                    children, leaves, saved = children + 1, leaves + message[3], saved + message[4]
                leaves = leaves if children else 1
                out.append((depth, k1, k2, False, children, leaves, saved))
                if up:
                    out.append((depth - 1, q1, q2, True, 1, leaves, saved))
                elif q1 is not None:
                    queue.push((1 - depth, q1, q2, leaves, saved))
            yield batch_of(out, TOTAL)

    columns = [*KEY, *PARENT, "up", "n_children", "n_leaves", "saved"]
    return nodes.sortWithinPartitions(F.desc("depth"), "k1", "k2").select(*columns).mapInArrow(run, TOTAL)


def end_digests(rows: DataFrame) -> DataFrame:
    """``depth, k1, k2, ends_sha256`` of the nodes where conversations end.

    Ids are joined in pieces of ``LIST_IDS`` neighbouring numbers, which are hashed one after
    the other as they come: a digest is sequential, but no list is ever held.
    """
    schema = "depth long, k1 long, k2 long, ends_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            out = []
            for *own, ids in zip(*(column.to_pylist() for column in batch.columns)):
                if own != key:
                    if key is not None:
                        out.append((*key, digest.hexdigest()))
                    key, digest = own, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield batch_of(out, schema)
        yield batch_of([(*key, digest.hexdigest())] if key is not None else [], schema)

    ids = F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string"))
    return (
        rows.where("is_end")
        .groupBy(*KEY, F.floor(F.col("conv") / LIST_IDS).alias("piece"))
        .agg(F.array_join(ids, ",").alias("ids"))
        .repartition(*KEY)
        .sortWithinPartitions(*KEY, "piece")
        .select(*KEY, "ids")
        .mapInArrow(run, schema)
    )


def with_parents(nodes: DataFrame) -> DataFrame:
    """``nodes`` with the parent's ``parent_conv_id`` and ``parent_convs``, and whether it is top.

    Only nodes of the top can have many children; they are few and are broadcast.
    """
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("k1").alias("q1"),
        F.col("k2").alias("q2"),
        F.col("conv_id").alias("parent_conv_id"),
        F.col("n_convs").alias("parent_convs"),
        "top",
    )
    key = ["depth", *PARENT]
    marked = nodes.drop("top")
    high = parents.where("top").drop("top")
    below_top = marked.join(F.broadcast(high), key).withColumn("up", F.lit(True))
    rest = marked.join(F.broadcast(high.select(*key)), key, "left_anti").where("depth > 0")
    below = rest.join(parents.where("not top").drop("top"), key).withColumn("up", F.lit(False))
    return below_top.unionByName(below)


def trie(conversations: DataFrame) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations.

    A conversation's turns are ordered by ``turn``, null first, ties by role, then by hashes
    of role and text; a null role or text is empty; repeated rows are repeated turns; rows
    without a ``conv_id`` belong to no conversation. Each is rebuilt as the first ``h`` turns
    of conversation ``c - c % 100`` and its own after the first ``h``, ``h`` being ``crc32`` of
    its id modulo 6 (the remainder has the sign of ``c``). Only ``conv_id``, ``turn``, ``role``
    and ``text`` are read. An empty table gives no rows, not even a root.

    Columns: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256``.
    """
    spark = conversations.sparkSession
    own = stored(numbered(conversations), "trie-turns")
    parts, begins = parts_of(own)
    info = stored(rebuilding(own, parts, begins), "trie-conversations")
    plans = stored(part_plans(info, parts, begins), "trie-plans")
    rows = stored(own_rows(own, plans).unionByName(head_rows(info)), "trie-rows")
    nodes = stored(
        rows.groupBy(*KEY).agg(
            F.min("conv").alias("conv_id"),
            F.count("*").alias("n_convs"),
            F.count_if("is_end").alias("n_ends"),
            *[F.min(name).alias(name) for name in (*PARENT, "chars")],
        ),
        "trie-nodes",
    )
    members = nodes.agg(F.coalesce(F.sum("n_convs"), F.lit(0))).first()[0]
    limit = int(np.ceil(np.sqrt(members)))
    nodes = nodes.withColumn("top", (F.col("n_convs") > limit) | (F.col("depth") == 0))
    top = F.broadcast(nodes.where("top").select(*KEY))
    linked = stored(with_parents(nodes), "trie-linked")
    # Children that are in no shard: nodes of a single conversation.
    tails = (
        linked.where("n_convs = 1 and parent_convs > 1")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("k1"), F.col("q2").alias("k2"))
        .agg(F.count("*").alias("tails"))
    )
    tails = stored(tails, "trie-tails")
    queues = mounted(scratch_path(spark, "trie-queues"))
    os.makedirs(queues)

    def known(own: DataFrame) -> DataFrame:
        return own.join(tails, list(KEY), "left").fillna(0, "tails").select(
            *KEY,
            *PARENT,
            "up",
            *[c for c in ("conv_id",) if c in own.columns],
            F.col("tails").alias("n_children"),
            F.col("tails").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
        )

    shared = linked.where((F.col("n_convs") > 1) & (F.col("n_convs") <= limit))
    parent = [rows["depth"] - 1 == top["depth"], rows["q1"] == top["k1"], rows["q2"] == top["k2"]]
    below = rows.join(top, parent, "left_semi")
    cuts = stored(
        below.join(top, list(KEY), "left_anti").select(
            F.col("conv").alias("conv_id"), F.xxhash64(*KEY).alias("subtree")
        ),
        "trie-subtrees",
    )
    shards = max(1, -(-shared.count() // SHARD_NODES))
    dealt = stored(known(shared), "trie-shared").join(cuts, "conv_id").repartition(
        shards, F.pmod("subtree", F.lit(shards))
    )
    passed = stored(forward(dealt, queues, QUEUE_MESSAGES), "trie-totals")
    sent = passed.where("up").groupBy(*KEY).agg(
        *[F.sum(name).alias("sent_" + name) for name in ("n_children", "n_leaves", "saved")]
    )
    high = known(
        nodes.where("top").withColumn("up", F.lit(False))
    ).join(sent, list(KEY), "left")
    for name in ("n_children", "n_leaves", "saved"):
        high = high.withColumn(name, F.col(name) + F.coalesce("sent_" + name, F.lit(0)))
    totals = stored(
        forward(high.repartition(1), queues, QUEUE_MESSAGES).unionByName(passed.where("not up")),
        "trie-all-totals",
    )
    digests = stored(end_digests(rows), "trie-ends")
    root = nodes.where("depth = 0").drop("top").withColumns(
        {"parent_conv_id": F.lit(None).cast("long"), "parent_convs": F.lit(None).cast("long"), "up": F.lit(False)}
    )
    return (
        linked.unionByName(root)
        .join(totals.drop("up"), list(KEY), "left")
        .join(digests, list(KEY), "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(1) - F.col("n_ends")).alias("n_children"),
            F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
            F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


ORACLE_SQL = """
WITH RECURSIVE own AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), crc_bits AS (
    SELECT n, n AS value, 0 AS step FROM range(256) AS t(n)
    UNION ALL
    SELECT n, CASE WHEN value % 2 = 1 THEN xor(value // 2, 3988292384) ELSE value // 2 END, step + 1
    FROM crc_bits WHERE step < 8
), crc_table AS (
    SELECT list(value ORDER BY n) AS entries FROM crc_bits WHERE step = 8
), crc AS (
    SELECT conv_id, conv_id::VARCHAR AS digits, 0 AS used, 4294967295::BIGINT AS state
    FROM (SELECT DISTINCT conv_id FROM own)
    UNION ALL
    SELECT conv_id, digits, used + 1,
           xor(state // 256, entries[xor(state % 256, ascii(substr(digits, used + 1, 1))) + 1]::BIGINT)
    FROM crc, crc_table WHERE used < length(digits)
), replaced AS (
    SELECT conv_id, xor(state, 4294967295) % 6 AS h FROM crc WHERE used = length(digits)
), built AS (
    SELECT r.conv_id, b.place, b.role, b.text
    FROM replaced r JOIN own b ON b.conv_id = r.conv_id - r.conv_id % 100 AND b.place <= r.h
    UNION ALL
    SELECT r.conv_id, o.place, o.role, o.text
    FROM replaced r JOIN own o ON o.conv_id = r.conv_id AND o.place > r.h
), steps AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth, role, text
    FROM built
), sizes AS (
    SELECT r.conv_id, count(s.depth) AS n
    FROM replaced r LEFT JOIN steps s ON s.conv_id = r.conv_id GROUP BY r.conv_id
), paths AS (
    SELECT conv_id, 0::BIGINT AS depth, '' AS node, '' AS parent, 0::BIGINT AS chars FROM sizes
    UNION ALL
    SELECT s.conv_id, s.depth,
           sha256(p.node || ':' || length(s.role) || ':' || s.role || s.text), p.node, length(s.text)
    FROM paths p JOIN steps s ON s.conv_id = p.conv_id AND s.depth = p.depth + 1
), nodes AS (
    SELECT depth, node, min(parent) AS parent, min(chars) AS chars, min(conv_id) AS conv_id,
           count(*) AS n_convs,
           coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '') AS ends
    FROM paths JOIN sizes USING (conv_id) GROUP BY depth, node
), families AS (
    SELECT n.depth, n.node, count(c.node) AS n_children
    FROM nodes n LEFT JOIN nodes c ON c.depth = n.depth + 1 AND c.parent = n.node
    GROUP BY n.depth, n.node
), subtrees AS (
    SELECT a.depth, a.node, sum((d.n_convs - 1) * d.chars) AS saved_tokens,
           count(*) FILTER (f.n_children = 0) AS n_leaves
    FROM nodes d JOIN families f ON f.depth = d.depth AND f.node = d.node
    JOIN paths a ON a.conv_id = d.conv_id AND a.depth <= d.depth
    GROUP BY a.depth, a.node
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, f.n_children, s.n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN families f ON f.depth = n.depth AND f.node = n.node
JOIN subtrees s ON s.depth = n.depth AND s.node = n.node
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.parent
"""
