"""Connected components of an undirected graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediamix.session import cut_lineage, release


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the smallest of its component.

    Each round points every node's larger neighbours, then its smaller ones, at the least
    node it knows. Least nodes are found by aggregation, which combines before the shuffle,
    and joined back, which splits the rows of a node with very many neighbours. The number
    of rounds grows with the logarithm of the longest path. Loops and repeated edges are
    harmless; edges with a null end are left out.
    """
    proper = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    current = cut_lineage(proper.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        following = cut_lineage(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        # a star forest: no node is pointed at that points at another itself
        roots = following.select(F.col("v").alias("u")).distinct()
        done = following.join(roots, "u", "left_semi").isEmpty()
        release(current)
        current = following
        if done:
            nodes = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return nodes.union(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
