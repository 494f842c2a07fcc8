"""Exact ranks of whole tables and of hot groups, with no single-task sort.

Rows fall into buckets by a leading piece of the ordering (a digest or text prefix). Bucket sizes give
each bucket's first rank; rows are then numbered inside their bucket only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# 65,536 buckets: a trillion rows leave about fifteen million per bucket.
DIGEST_PREFIX = 4


def rank_rows(df: DataFrame, by: list[str], order: Column, bucket: Column, name: str = "rank") -> DataFrame:
    """Zero-based rank within ``by`` following ``order``; ``bucket`` must never decrease along it."""
    rows = df.withColumn("_order", order).withColumn("_bucket", bucket)
    sizes = rows.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = sizes.select(
        *[F.col(c).alias(f"_by_{c}") for c in by], F.col("_bucket").alias("_by_bucket"),
        (F.sum("_n").over(upto) - F.col("_n")).alias("_first"),
    )
    match = F.col("_bucket").eqNullSafe(F.col("_by_bucket"))
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    inside = Window.partitionBy(*by, "_bucket").orderBy("_order")
    out = rows.join(first, match).withColumn(name, F.col("_first") + F.row_number().over(inside) - 1)
    return out.select(*df.columns, name)


def shuffled_rank(df: DataFrame, by: list[str], digest: Column, name: str = "rank") -> DataFrame:
    """Rank in digest order: a reproducible shuffle of every group."""
    return rank_rows(df, by, digest, F.substring(digest, 1, DIGEST_PREFIX), name)
