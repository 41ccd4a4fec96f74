"""Connected components of an edge table, by joins and groupings alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bowline.staging import stage


def stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step on edges (a, b). Large: neighbours above a node move to its smallest neighbour or itself. Small: the
    node and its neighbours below it do."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    lowest = both.groupBy("a").agg(F.min("b").alias("low"))
    lowest = lowest.withColumn("low", F.least("low", "a"))
    joined = both.join(lowest, "a")
    if large:
        moved = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        others = joined.filter(F.col("b") != F.col("low")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        moved = others.unionByName(lowest.select("a", F.col("low").alias("b")))
    return moved.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long): the smallest node that it is connected with.

    Large and small star steps in turn, until an iteration leaves the edges as they are; the number of iterations
    grows with the logarithm of the nodes. Every iteration is a written table. No edges: no rows.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()
    now = stage(pairs, "edges")
    seen = None
    while True:
        # In a star forest every node but the centres is in one edge: count and sums stay the same.
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        large = stars(now, True).select(F.col("a"), F.col("b"))
        now = stage(stars(large, False), "edges")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(centres)
