"""Connected components of a table of links, as joins and map-side combined minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import materialize


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, component (the smallest node it is linked with, over any number of links) of every node
    in ``links`` (a long, b long).  Alternating large-star and small-star steps: each node's links are
    hung on the smallest node of its neighbourhood until every tree is a star.  A node's neighbours are
    reduced by ``min`` before they move, never gathered; rounds are written tables."""
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    if edges.isEmpty():
        return edges.toDF("node", "component")
    size = None
    for _ in range(max_rounds):
        # Large star: every neighbour above a node goes to the smallest of the node's neighbours.
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: every neighbour below a node, and the node, go to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least).filter("u <> v").distinct()
        edges = materialize(small, "stars")
        # Stars: no node is both hung on another and holds others.
        state = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if tuple(state) == size:
            break
        size = tuple(state)
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
