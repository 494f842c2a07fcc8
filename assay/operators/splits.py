"""Train/test splits and folds that every run and every engine repeats exactly.

Row order comes from md5 of a row key and a seed. Ranks inside a class are taken through
``shuffled_rank``, so a class that holds most of the table is still numbered by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from assay import thresholds as th
from assay.functions import values as fv
from assay.operators.counts import KEY
from assay.operators.quantiles import weighted_quantiles
from assay.operators.ranks import shuffled_rank


def _digest(row_key: str, seed: int) -> Column:
    return fv.md5_of(F.col(row_key), F.lit(seed))


def _class_sizes(df: DataFrame, label: str) -> DataFrame:
    """(class, class_rows, min_class_rows, n_classes, all_rows); as many rows as there are classes."""
    sizes = df.groupBy(F.col(label).alias("_class")).agg(F.count(F.lit(1)).alias("class_rows"))
    whole = sizes.agg(
        F.min("class_rows").alias("min_class_rows"), F.count(F.lit(1)).alias("n_classes"),
        F.sum("class_rows").alias("all_rows"),
    )
    return sizes.join(whole)


def stratified_split(df: DataFrame, row_key: str, label: str, test_share: float, seed: int = 42) -> DataFrame:
    """Adds is_test: the test share of every class, or a plain split if a class has a single row."""
    df = df.where(F.col(label).isNotNull())
    sizes = _class_sizes(df, label)
    digest = _digest(row_key, seed)
    ranked = shuffled_rank(df, [label], digest, "_rank").join(sizes, F.col(label) == F.col("_class"))
    by_class = (F.col("n_classes") > 1) & (F.col("min_class_rows") >= 2)
    is_test = F.when(by_class, F.col("_rank") < F.ceil(F.col("class_rows") * test_share)).otherwise(
        _below_share(digest, test_share)
    )
    return ranked.select(*df.columns, is_test.alias("is_test"))


def random_split(df: DataFrame, row_key: str, test_share: float, seed: int = 42) -> DataFrame:
    """Adds is_test by digest alone: no shuffle, no sort."""
    return df.withColumn("is_test", _below_share(_digest(row_key, seed), test_share))


def _below_share(digest: Column, share: float) -> Column:
    return fv.hex_prefix_int(digest, 7) < int(share * 16**7)


def stratified_folds(df: DataFrame, row_key: str, label: str, folds: int, seed: int = 42) -> DataFrame:
    """Adds fold (0-based) dealing every class out evenly."""
    ranked = shuffled_rank(df, [label], _digest(row_key, seed), "_rank")
    return ranked.select(*df.columns, (F.col("_rank") % folds).cast("int").alias("fold"))


def folds(df: DataFrame, row_key: str, k: int, seed: int = 42) -> DataFrame:
    """Adds fold by digest bucket: no shuffle."""
    return df.withColumn("fold", (fv.hex_prefix_int(_digest(row_key, seed)) % k).cast("int"))


def time_folds(df: DataFrame, time_column: str, k: int) -> DataFrame:
    """Adds time_block 0..k: fold i trains on blocks below i + 1 and tests on block i + 1.

    Blocks are cut at exact quantiles of the time itself, so equal times never straddle a cut.
    """
    micros = fv.epoch_micros(F.col(time_column), df.schema[time_column].dataType)
    counts = df.groupBy(micros.alias("t")).agg(F.count(F.lit(1)).alias("cnt")).withColumn(KEY, F.lit("table"))
    cuts = weighted_quantiles(counts, [KEY], "t", "cnt", [i / (k + 1) for i in range(1, k + 1)])
    points = cuts.select(F.col("q").alias("_cuts"))
    block = F.size(F.filter("_cuts", lambda c: c <= micros))
    # One row of k numbers, whatever the table's size.
    return df.join(F.broadcast(points)).select(*df.columns, block.alias("time_block"))


def fold_count(rows: Column, smallest_class: Column | None = None, small_rows: int = th.SMALL_ROWS) -> Column:
    """Folds to use: three, or five below ``small_rows`` rows (1,000 if not given); never more than the smallest class; null if under two."""
    wanted = F.when(rows < small_rows, F.lit(th.FOLDS_SMALL)).otherwise(F.lit(th.FOLDS_DEFAULT))
    k = F.least(wanted, rows if smallest_class is None else smallest_class)
    return F.when((rows >= 4) & (k >= 2), k)


def tuning_sample(df: DataFrame, row_key: str, label: str, rows: int, seed: int = 42) -> DataFrame:
    """``rows`` rows in class proportion, each class rounded up; the whole table if it is smaller."""
    sizes = _class_sizes(df, label)
    ranked = shuffled_rank(df, [label], _digest(row_key, seed), "_rank").join(
        sizes, F.col(label).eqNullSafe(F.col("_class"))
    )
    share = F.ceil(F.lit(float(rows)) * F.col("class_rows") / F.col("all_rows"))
    return ranked.where((F.col("all_rows") <= rows) | (F.col("_rank") < share)).select(*df.columns)
