"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from assay.session import materialise

EDGES_PER_TASK = 250_000  # a step writes one file per so many edges, whatever the number of shuffle partitions


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the long pairs (u, v); component is the smallest node reached.

    Each half-step finds the least neighbour of every node by a map-side combined minimum and joins it back,
    so a node with a third of all edges is split by Spark's skew handling and never gathered in one task.
    Loops and repeated pairs are fine; nulls are dropped; no edges give no rows.
    """
    now = materialise(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .filter("u is not null and v is not null and u != v").distinct()
    )
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        parts = 1 + mark[0] // EDGES_PER_TASK
        now = _small_star(_large_star(now, parts), parts)
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.union(now.select("v", "v")).distinct()


def _large_star(edges: DataFrame, parts: int) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).coalesce(parts))
    joined = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return materialise(joined.filter("u != v").distinct().coalesce(parts))


def _small_star(edges: DataFrame, parts: int) -> DataFrame:
    least = materialise(edges.groupBy("u").agg(F.min("v").alias("m")).coalesce(parts))
    joined = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
    return materialise(joined.union(least).distinct().coalesce(parts))
