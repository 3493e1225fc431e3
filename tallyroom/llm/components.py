"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Scratch, unless_many


def connected(scratch: Scratch, links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node of ``links``; root is the smallest node of its component.

    Links may repeat, run either way or join a node to itself. Nothing is gathered: each step is an
    aggregation with map-side combine (the smallest neighbour) and a join of two stored tables, which
    AQE may split where a node has very many neighbours. The number of rounds grows with the
    logarithm of the longest chain. It ends when what is left is a forest of stars.
    """
    edges = scratch.write(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "links",
    )
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch.write(
            both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "large"
        )
        large = scratch.write(both.where("v > u").join(unless_many(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")), "wide")
        low = scratch.write(large.groupBy("u").agg(F.min("v").alias("m")), "small")
        small = large.join(unless_many(low), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = scratch.write(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        scratch.drop(edges, least, large, low)
        edges = after
        # a forest of stars: every node has one parent and no parent has one itself
        below = edges.groupBy(F.col("u").alias("child")).agg(F.count("*").alias("n"))
        if below.where("n > 1").isEmpty() and edges.join(below, F.col("v") == F.col("child"), "left_semi").isEmpty():
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
