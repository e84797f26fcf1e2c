"""Distributed union-find: connected components of a link table.

Alternating large-star and small-star steps (each one grouping and one join)
turn any graph into stars around the smallest id of each component in
O(log^2) rounds.  A node with very many links is no single task: the minimum
is aggregated before the shuffle, and the join's large partitions are split.
Every round is written to the shared folder, so nothing is recomputed after a
loss, and only two numbers a round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.scratch import written

#: Far above log^2 of any graph; a graph that needs more is an error.
MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` hold a > b only."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
    return moved.union(low.select("a", F.col("m").alias("b")))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each linked node with the smallest node reachable.

    Links with a null end and links of a node to itself say nothing and are
    left out, repeated links count once, direction is ignored.  No links: no
    rows.  Nodes without a link are not in the result.
    """
    x, y = F.col(a), F.col(b)
    edges = (links.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"))
             .where(x.isNotNull() & y.isNotNull() & (x != y)).distinct())
    edges = written(edges, "edges")
    seen = None
    for _ in range(MAX_ROUNDS):
        edges = written(_small_star(_large_star(edges).distinct()).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        seen = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
