"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglake.llm.common import settle


def _nearest(edges: DataFrame) -> DataFrame:
    """edges (u, v) with m: the smallest of u and its neighbours v. The minimum is pre-aggregated before the shuffle."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b); component is the smallest node that can be reached.

    Each round is two joins on the shrinking link table, written to reliable storage; the number of rounds grows
    with the logarithm of the longest chain. Nulls and loops are ignored, repeated links count once; an empty
    table gives an empty table.
    """
    edges = settle(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _nearest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = _nearest(large)
        edges = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        edges = settle(edges.where("u <> v").distinct())
        inner = edges.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
        several = edges.groupBy("u").count().where("count > 1").select("u")
        if inner.select("u").unionByName(several).isEmpty():
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
