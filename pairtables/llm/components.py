"""Connected components of an undirected graph, by alternating stars (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairtables.llm.common import stored

MAX_ROUNDS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(pairs: DataFrame) -> DataFrame:
    """Link every ``b`` of a node ``a`` to the least node among ``a`` and its ``b``."""
    least = pairs.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("_m"))
    return pairs.join(least, "a")


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) from edges ``a``, ``b`` of integers.

    Nodes without an edge to another node are left out. Each round's edges are stored; a
    round joins each edge with one row per node, and the number of edges does not grow.
    """
    edges = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        # Large star: larger neighbours go to the least neighbour.
        large = _star(_both_ways(edges)).where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
        large = large.where("a <> b").distinct()
        # Small star: smaller neighbours, and the node itself, go to the least neighbour.
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        small = _star(down)
        small = small.select(F.col("b").alias("a"), F.col("_m").alias("b")).unionByName(
            small.select("a", F.col("_m").alias("b"))
        )
        edges = stored(small.where("a <> b").distinct(), "edges")
        # Done when all are stars: no node has two parents, or a parent and children.
        ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            edges.select(F.col("b").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down"))
        )
        ends = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if ends.where("up > 1 or up > 0 and down > 0").isEmpty():
            break
    else:
        raise RuntimeError(f"components are not complete after {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
