"""Connected components of an undirected graph by alternating large-star and small-star steps.

Each step keeps the components and pulls every node nearer to the smallest id of its neighbourhood;
the edges end as stars around the smallest node of each component. All work is aggregates and joins;
a hub with very many neighbours is combined before the shuffle, and the join back to it is one that
Spark may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstat.llm.common import hold, release


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node it knows."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").select(F.col("m").alias("a"), F.col("a").alias("b"))
    own = least.select(F.col("m").alias("a"), "b")
    return moved.unionByName(own).filter("a <> b").distinct()


def _signature(edges: DataFrame) -> tuple:
    """Equal for equal edge sets: three numbers, whatever the size."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` to ``(node, component)``; the component is its smallest node.

    Only nodes with a link to another node come back. Nulls, loops and repeated edges are ignored.
    """
    edges = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = hold(edges, "edges")
    before = _signature(edges)
    while True:
        after = hold(_small_star(_large_star(edges)), "edges")
        release(edges)
        edges, now = after, _signature(after)
        if now == before:
            break
        before = now
    grouped = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return grouped.unionByName(roots)
