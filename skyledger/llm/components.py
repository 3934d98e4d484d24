"""Connected components of an undirected graph, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skyledger.session import stage


def _low(pairs: DataFrame) -> DataFrame:
    """(`a`, `low`): the smallest of each vertex and its neighbours."""
    return pairs.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    hung = both.join(_low(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return hung.where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    low = _low(down)
    hung = down.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return hung.union(low.select("a", F.col("low").alias("b"))).where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Smallest vertex reachable from each vertex of `edges` (`a`, `b` long): (`id`, `component`).

    Vertices without an edge to another do not appear; repeated edges, loops and edges
    with a null end change nothing. Each round is written to the shared folder, so no
    lineage grows and no vertex list passes through the driver. Stars end when every
    edge leads from a vertex to its component's smallest, which takes about log(n)
    rounds.
    """
    edges = stage(edges.select("a", "b").where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        # done when no vertex has two neighbours below it and no low neighbour has its own
        tops = edges.groupBy("a").agg(F.count("*").alias("n"))
        forks = tops.where("n > 1").limit(1).select(F.lit(1).alias("x"))
        chains = edges.select(F.col("b").alias("a")).join(edges.select("a"), "a", "left_semi").limit(1)
        if not forks.union(chains.select(F.lit(1).alias("x"))).take(1):
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
                edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
        edges = stage(_small_star(_large_star(edges)), "edges")
