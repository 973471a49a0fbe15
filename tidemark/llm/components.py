"""Connected components of links that may form chains, stars and large dense groups.

Alternating large-star and small-star steps (Kiveris et al., "Connected Components in
MapReduce and Beyond", 2014) shrink any graph to stars in a few rounds. Each step is one
aggregate and one join; minima combine in every task before they move, and are stored, so
that adaptive execution can split the join of a hub. Rounds are written to the shared
folder, so a lost executor costs one step and the plan does not grow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import stored


def least_neighbours(edges: DataFrame) -> DataFrame:
    return stored(edges.groupBy("high").agg(F.min("low").alias("least")), "least-neighbours")


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's least neighbour."""
    both = edges.union(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = least_neighbours(both).withColumn("least", F.least("high", "least"))
    moved = both.where("low > high").join(least, "high")
    return moved.select(F.col("low").alias("high"), F.col("least").alias("low")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the least of them."""
    least = least_neighbours(edges)
    moved = edges.join(least, "high").where("low <> least")
    return (
        moved.select(F.col("low").alias("high"), F.col("least").alias("low"))
        .union(least.select("high", F.col("least").alias("low")))
        .distinct()
    )


def digest(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.bit_xor(F.xxhash64("high", "low"))).first()
    )


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component``: the least node reachable, for every node that has a link.

    Self-links, links with a null end and repeated links add nothing; no links, no rows.
    """
    ends = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    edges = stored(
        ends.where("a <> b")
        .select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
        .distinct(),
        "links",
    )
    before = digest(edges)
    while before[0]:
        edges = stored(small_star(stored(large_star(edges), "links")), "links")
        after = digest(edges)
        if after == before:
            break
        before = after
    labels = edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
    roots = edges.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return labels.union(roots)
