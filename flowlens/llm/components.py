"""Connected components of an edge table, by alternating large-star and
small-star steps (each a group-by on the smaller end plus a join): every step
keeps at most as many edges as it read, and the number of steps grows with the
logarithm of the longest path. No component is ever gathered in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import materialize


def components(edges: DataFrame) -> DataFrame:
    """edges(a long, b long) -> (node, root) of every node that has an edge and
    isn't the smallest of its component; ``root`` is that smallest node (the
    roots themselves aren't listed). Null ends and loops are ignored; no edges
    give an empty table."""
    e = materialize(edges.where("a <> b").select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    while True:
        # large star: all larger neighbours of a node point to its smallest neighbour (or itself)
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        # small star: the smaller neighbours of a node, and itself, point to the smallest
        small = large.groupBy("hi").agg(F.min("lo").alias("m"))
        joined = large.join(small, "hi")
        after = materialize(
            joined.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .union(small.select("hi", F.col("m").alias("lo"))).distinct(), "edges")
        done = e.select("hi", "lo", F.lit(1).alias("s")).union(after.select("hi", "lo", F.lit(-1).alias("s"))) \
            .groupBy("hi", "lo").agg(F.sum("s").alias("s")).where("s <> 0").isEmpty()
        if done:
            return after.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        e = after
