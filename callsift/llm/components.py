"""Connected components of an edge table, without moving any component into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.session import settle


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of edges (u, v); nodes without an edge have no row.

    Alternating large-star and small-star steps: each replaces edges by edges to the smallest neighbour until every
    component is a star. Both steps are a partial aggregation and a join with its written result, so a node with very
    many neighbours is split by AQE or met by a broadcast of checked size. Null ends and loops are dropped.
    """
    edges = settle(
        edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = settle(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "stars")
        large = settle(
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(),
            "edges",
        )
        least = settle(large.groupBy("u").agg(F.min("v").alias("m")), "stars")
        small = large.join(least, "u").where("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        edges = settle(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
