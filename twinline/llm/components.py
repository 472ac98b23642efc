"""Connected components by alternating star contraction, as joins and aggregations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from twinline.sources.scratch import materialize


def _apart(column: str) -> Column:
    """The column, computed, so that what was dealt by it is dealt anew for a join: an exchange of its own splits by skew."""
    return (F.col(column) + F.lit(0)).alias(column)


def connected(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges(a, b)``: the smallest node it can reach.

    Each round points all larger neighbours of a node at its smallest one, then a node's smaller neighbours at the
    smallest of them, until nothing changes; rounds grow with the logarithm of the input. Rows of a hub are never
    gathered: its minimum is a map-side aggregate and the join back splits by skew. Every round is a written table.
    Loops and repeated edges change nothing, null ends are ignored, no edges give no rows.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current = materialize(pairs.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct(), "edges")
    before = None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(_apart("u"), F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "large-star")
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(smallest.select(_apart("u"), "m"), "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = moved.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()
        current = materialize(small, "small-star")
    members = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
