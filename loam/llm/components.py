"""Connected components by alternating large-star and small-star steps, all in joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns ``a``, ``b``); root is the smallest node reachable.

    Each step replaces a node's links by links to the smallest neighbour, and is
    checkpointed in the shared folder; the loop ends when a step changes nothing.
    A node with very many links costs its share of a join, never one group in
    memory.  Nulls and self-links are ignored; no edges give no rows.
    """
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    links = materialize(links.filter(F.col("u") > F.col("v")).distinct())
    state = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = (both.filter(F.col("v") > F.col("u")).join(low, F.col("u") == F.col("k"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        small = large.join(least, F.col("u") == F.col("k"))
        small = (small.select("u", F.col("m").alias("v"))
                 .union(small.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))))
        links = materialize(small.filter(F.col("u") > F.col("v")).distinct())
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == tuple(now):
            break
        state = tuple(now)
    roots = links.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
