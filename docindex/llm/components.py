"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docindex.llm.common import join_uneven, staged


def _lowest(edges: DataFrame) -> DataFrame:
    """``(a, m, n)``: each node's smallest neighbour and its number of them."""
    return staged(edges.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")), "lowest")


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Every neighbour above a node moves to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _lowest(both).select("a", F.least("a", "m").alias("m"), "n")
    above = join_uneven(both.filter(F.col("b") > F.col("a")), low, "a", "n", 2 * total)
    return above.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them.
    ``edges`` point downwards (a > b)."""
    low = _lowest(edges)
    moved = join_uneven(edges, low, "a", "n", total).filter(F.col("b") != F.col("m"))
    return (
        moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(low.select("a", F.col("m").alias("b")))
        .distinct()
    )


def _stars(edges: DataFrame) -> tuple[int, bool]:
    """The number of ``edges``, and whether all are stars: no node has two edges down,
    or one down and one from above."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("above"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("above")))
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("above").alias("above"))
    total, inner = nodes.agg(F.sum("down"), F.count_if(F.col("down") + F.col("above") > F.lit(1))).first()
    return total or 0, inner == 0


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; the root is the smallest
    node of the component and is listed too. Each round is written, so no round
    depends on an executor of an earlier one; rounds grow with the logarithm of
    the longest chain, and end when only stars are left.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = staged(edges.filter("a != b").distinct(), "links")
    total, done = _stars(edges)
    while not done:
        # The large star makes no more edges than it is given.
        edges = staged(_small_star(_large_star(edges, total), total), "stars")
        total, done = _stars(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
