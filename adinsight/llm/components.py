"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adinsight.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (a, b): root is the smallest node reachable.

    Large-star links each node's greater neighbours to its smallest neighbour,
    small-star does so with the smaller ones; both only move links towards the
    smallest node, and repeat until the links no longer change.  A node's
    neighbours are never collected: each step is a minimum per node (summed
    before the shuffle) and an equi-join, whose hot keys adaptive execution can
    split.  Each round is written to the shared checkpoint folder.
    """
    def star(pairs: DataFrame) -> DataFrame:
        """Link every neighbour v of u to the smallest of u and its neighbours."""
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        return pairs.join(least, "u")

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    # Links are kept as (u greater, v smaller).
    edges = cut(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .distinct())
    before = None
    while before != (before := state(edges)):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (star(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        small = star(large)
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(small.select("u", F.col("m").alias("v")))
                 .filter("u <> v").distinct())
        edges = cut(small)
    # Stars now: every node but the roots has one link, to its root.
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
