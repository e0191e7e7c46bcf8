"""Connected components of a graph of links, as DataFrames all the way."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.runtime import cut_lineage


def connected(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); a component is named by its smallest node.

    Alternating stars: every node hands its larger neighbours, then its smaller ones, to the smallest
    node it sees, until each component is a star. Rounds grow with the logarithm of the longest chain.
    Nodes with many links are joined to one row each, which adaptive execution splits.
    """
    edges = cut_lineage(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")
        )
        edges = cut_lineage(small.distinct())
        forked = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1")
        inner = edges.join(edges.select(F.col("u").alias("v")).distinct(), "v", "left_semi")
        if forked.isEmpty() and inner.isEmpty():
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct()
    )
