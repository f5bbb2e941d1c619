"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifeloom.llm.tables import keep


def connected(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from each node that has an edge.

    ``edges`` has columns a and b of one integer type. Each round points every node's larger
    neighbours, and then its smaller ones, at its smallest neighbour; a star stays a star, so
    rounds grow with the logarithm of a component's width. Minima are combined before each
    shuffle and no node's neighbours are ever gathered, so a hub may have any number of edges.
    """
    now = keep(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    while True:
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = keep(large.distinct(), "edges")
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = keep(small.unionByName(down.select("a", F.col("m").alias("b"))).distinct(), "edges")
        # a forest of stars: one edge per node and no node both points and is pointed at
        nodes = after.agg(F.count("*"), F.count_distinct("a")).first()
        centres = after.select(F.col("b").alias("a")).distinct()
        chained = after.join(centres, "a", "left_semi").limit(1).count()
        now = after
        if nodes[0] == nodes[1] and not chained:
            break
    tips = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return tips.unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
