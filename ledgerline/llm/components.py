"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import spread_join, stored


def components(links: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(node, root) for every node of `links` (a, b): root is the least node of its component.

    A star step needs each node's least neighbour (partial minimum before the exchange) and one join with it, in which
    the edges of a hub are spread over several tasks. Each step's edges are written to the shared folder, so the plan
    stays short. An empty table gives an empty one; links of a node with itself are left out."""
    edges = stored(links.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).filter("lo < hi").distinct())
    before = edges.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
    if not before[0]:
        return edges.select(F.col("lo").alias("node"), F.col("hi").alias("root"))
    for _ in range(max_rounds):
        both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        # large star: every greater neighbour of u points at the least of u's neighbourhood
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = spread_join(both, least, "u", F.xxhash64("v"), 2 * before[0]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.filter("v < u").distinct())
        # small star: u and its lesser neighbours point at the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        up = spread_join(large, least, "u", F.xxhash64("v"), large.count()).select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        edges = stored(up.unionByName(least.select(F.col("u").alias("hi"), F.col("m").alias("lo"))).filter("lo < hi").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components didn't settle")
    roots = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
