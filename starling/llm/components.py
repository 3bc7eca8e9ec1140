"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm.common import stored


def components(nodes: DataFrame, edges: DataFrame, node: str, label: str) -> DataFrame:
    """(node, label) for every node: label is the smallest node of its component.

    ``edges`` has columns a and b.  Alternates large-star and small-star rounds, which link
    each node to the smallest neighbour and so shrink every component to a star in about
    log(size) rounds; only minima per node move, and each round is a written table.
    """
    both = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    if both.isEmpty():
        return nodes.select(F.col(node), F.col(node).alias(label))
    before = None
    while True:
        # large star: every larger neighbour is linked to the smallest of the neighbourhood
        sides = both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = sides.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (sides.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        # small star: a node and its smaller neighbours are linked to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small = (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        both = stored(small, "edges")
        now = both.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    stars = both.groupBy("a").agg(F.min("b").alias("m"))
    return (nodes.join(stars, nodes[node] == stars["a"], "left")
            .select(F.col(node), F.coalesce("m", node).alias(label)))
