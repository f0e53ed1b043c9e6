"""Connected components of a link table by alternating stars (large star, small star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venue_analytics.llm.common import cut


def _large(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the smallest of the node and its neighbours."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    return (both.join(low, "u").where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())


def _small(edges: DataFrame) -> DataFrame:
    """Every node and its neighbours below are linked to the smallest of them. Takes and gives u > v."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)``; the root is the smallest node of the component.

    Links are undirected; repeats and loops are harmless, rows with a null end are ignored. No group
    is gathered: each step is an aggregate and a join on a node, so a hub is pre-aggregated on its way
    to the shuffle and its join partition can be split. Each round is checkpointed; the number of
    rounds grows with the logarithm of the longest chain.
    """
    edges = cut(edges.where("u is not null and v is not null and u <> v")
                .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    while True:
        n, s = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (n, s) == state or n == 0:
            break
        state = (n, s)
        edges = cut(_small(_large(edges)))
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
