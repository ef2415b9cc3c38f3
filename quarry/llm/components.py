"""Connected components of a graph that no single machine holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise


def _edges(df: DataFrame, a: Column, b: Column) -> DataFrame:
    return df.select(a.alias("u"), b.alias("v")).where("u <> v").distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of links, where component is the smallest node it can reach.

    Alternating large-star and small-star steps: every step is a grouped minimum (combined on the
    map side) and an equi-join, so a node with very many neighbours is split like any skewed key.
    Each round is written to the shared folder; rounds grow with the logarithm of the nodes. Self-links and nulls are left out; no links give no rows.
    """
    now = materialise(_edges(links.where(F.col(a).isNotNull() & F.col(b).isNotNull()), F.greatest(a, b), F.least(a, b)), "edges")
    while True:
        # large star: every larger neighbour of u moves to the smallest node around u
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _edges(both.where("v > u").join(least, "u"), F.col("v"), F.col("m"))
        # small star: u and its smaller neighbours move to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = _edges(small.select(F.col("v").alias("x"), "m").unionByName(low.select(F.col("u").alias("x"), "m")), F.col("x"), F.col("m"))
        now = materialise(small, "edges")
        # settled: every node hangs on one smaller node, which hangs on none
        twice = now.groupBy("u").count().where("count > 1").select("u")
        if twice.unionByName(now.join(now.select(F.col("v").alias("u")), "u", "left_semi").select("u")).isEmpty():
            break
    member = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return member.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
