"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize


def components(links: DataFrame, u: str = "u", v: str = "v", label: str = "stars") -> DataFrame:
    """(node, component) of every node in the links; a component is named by its smallest node.

    Each round points the larger neighbours of a node, then the smaller ones, to the smallest around it, until only
    stars are left. Minima are taken before the shuffle, so a node with very many links costs a row per task; every round
    is a written table, so a lost executor does not bring back earlier rounds.
    """
    high, low = F.greatest(u, v).alias("u"), F.least(u, v).alias("v")
    stars, before = materialize(links.where(F.col(u) != F.col(v)).select(high, low).distinct(), label), None
    while True:
        state = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        around = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(around, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = materialize(small.union(least.select("u", F.col("m").alias("v"))).distinct(), label)
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        stars.select("v", "v").distinct())
