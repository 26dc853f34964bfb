"""Connected components of links by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.llm.common import lookup, stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (smallest node reachable) for every node of the links ``a``, ``b``.

    Self-links and repeated links do no harm; nulls are left out. Every step
    aggregates with a map-side combine and writes its links to the shared
    folder, so lineage stays short. The driver sees counts only.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    edges, before = stage(edges, "links"), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "star")
        large = lookup(both.where("v > u"), least, ["u"], "inner", 32).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u > v").distinct(), "large-star")
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")), "star")
        small = lookup(large, least, ["u"], "inner", 32).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u > v").distinct(), "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
