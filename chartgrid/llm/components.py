"""Connected components of a link table, by large-star and small-star rounds.

Both star steps are a grouped minimum (with a partial step) and an equi-join, so
a node with very many links is neither collected nor expanded into pairs.  A
round moves every link towards the smallest id that is known nearby; the rounds
end when nothing moves.  Each round is checkpointed.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) to ``node, component``: every node of a link with the
    smallest node that it reaches.  Null ends and loops are ignored; an empty
    table gives no rows."""
    edges = cut(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    while True:
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen or not now[0]:
            break
        seen = now
        edges = cut(_small_star(_large_star(edges)))
    # every link is now (node, root); a root stands for itself
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")).select("w", F.least("w", "m").alias("m"))
    # (neighbour above w) - m(w): edges are kept as u > v, so w is their v
    return (edges.join(least, edges.v == least.w).select("u", F.col("m").alias("v"))
            .filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node's smaller neighbours, and the node, to the smallest of them."""
    least = edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    joined = edges.join(least, edges.u == least.w)
    return (joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
            .unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct())
