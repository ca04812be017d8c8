"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from matchweave.session import stage


def _to_least(pairs: DataFrame, keep_larger: bool) -> DataFrame:
    """Link the neighbours ``b`` of each ``a`` to the least of them and ``a``: only the larger ones, or the smaller ones and ``a`` itself."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    near = pairs.join(least, "a").where("b > a" if keep_larger else "b < a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return (near if keep_larger else near.union(least.select("a", F.col("m").alias("b")))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node that each node of ``edges`` (a, b) is connected with, itself included.

    Neighbours are linked to the least one of the neighbourhood, first the larger and then the smaller ones, until nothing moves; the edges then are
    stars. Each step is a least per node, combined before the exchange, and a join on the node. Rounds follow the logarithm of the longest path.
    """
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "arestas")
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        now = stage(_to_least(_to_least(both, True).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), False), "arestas")
    return nodes.join(now.select(F.col("a").alias("node"), F.col("b").alias("root")), "node", "left").select("node", F.coalesce("root", "node").alias("root"))
