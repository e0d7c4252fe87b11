"""Connected components of an edge table, by alternating large and small stars.

Every round connects each node to the least node that it knows; a graph of
diameter d is a set of stars after about log(d) rounds. Edges stay in tables,
and each round is written to the shared folder, so nothing is collected and a
lost executor costs one round at most."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import dropped, written


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node of its component) for every node of
    edges(a long, b long). Loops and repeated edges are harmless."""
    at = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    at = written(at, "edges")
    before = None
    while True:
        now = at.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).cast("string")).first()
        if now == before or not now[0]:
            break
        before, last = now, at
        at = written(_small_star(_large_star(at)), "edges")
        dropped(last)
    return at.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(at.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node are moved to its least neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are moved to the least of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
