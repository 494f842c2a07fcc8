"""Duplicates, outliers, ranges, class balance and sensitive names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from assay import thresholds as th
from assay.functions import values as fv
from assay.operators.counts import KEY, LONG_TEXT
from assay.operators.quantiles import weighted_quantiles
from assay.operators.schema import NUMERIC_KINDS


def drop_duplicates(df: DataFrame) -> DataFrame:
    """One copy of every row; nulls compare equal."""
    return df.dropDuplicates()


def _row_key(df: DataFrame) -> list[Column]:
    """All columns of a row as grouping keys; long texts and nested values as their SHA-256."""
    out = []
    for f in df.schema.fields:
        c, family = F.col(f"`{f.name}`"), fv.family_of(f.dataType)
        if family == fv.TEXT:
            c = F.when(F.length(c) > LONG_TEXT, F.concat(F.lit("sha256:"), F.sha2(c, 256))).otherwise(c)
        elif family == fv.OTHER:
            c = F.sha2(F.to_json(F.struct(c), {"ignoreNullFields": "false"}), 256)
        out.append(c.alias(f.name))
    return out


def duplicate_stats(df: DataFrame) -> DataFrame:
    """Rows, surplus copies and their share per dataset; copies are collapsed before the shuffle."""
    groups = df.groupBy(*_row_key(df)).agg(F.count(F.lit(1)).alias("_copies"))
    out = groups.groupBy(KEY).agg(F.sum("_copies").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"))
    extra = F.col("n_rows") - F.col("n_distinct")
    return out.select(
        KEY, "n_rows", extra.alias("duplicate_count"),
        (extra / F.greatest(F.col("n_rows"), F.lit(1)) * 100).alias("duplicate_pct"),
    )


def numeric_counts(counts: DataFrame, stats: DataFrame, kinds=NUMERIC_KINDS) -> DataFrame:
    """Value counts of the numeric columns, text numbers parsed: (dataset, pos, x, cnt)."""
    kept = stats.where(F.col("kind").isin(*kinds)).select(KEY, "pos", "column_name", "n_rows")
    x = F.coalesce(F.col("num"), fv.parse_number(F.col("txt")))
    rows = counts.select(KEY, "pos", x.alias("x"), "cnt").where(F.col("x").isNotNull())
    return rows.join(kept, [KEY, "pos"])


def column_cuts(counts: DataFrame, stats: DataFrame, kinds=NUMERIC_KINDS + ("datetime",)) -> DataFrame:
    """(dataset_id, pos, q): exact 5 %, 10 %, ..., 95 % quantiles of every numeric column.

    The quartiles serve the outlier fences and the whole list cuts columns into bins.
    """
    numbers = numeric_counts(counts, stats, kinds)
    probs = [i / th.MI_BINS for i in range(1, th.MI_BINS)]
    return weighted_quantiles(numbers, [KEY, "pos"], "x", "cnt", probs, "n_rows").select(KEY, "pos", "q")


def outlier_shares(counts: DataFrame, stats: DataFrame, cuts: DataFrame | None = None) -> DataFrame:
    """Share of values outside the 1.5 IQR fences per numeric column; no row where the IQR is zero."""
    numbers = numeric_counts(counts, stats)
    by = [KEY, "pos", "column_name"]
    if cuts is None:
        quartiles = weighted_quantiles(numbers, by, "x", "cnt", [0.25, 0.75], "n_rows")
        quartiles = quartiles.select(KEY, "pos", F.get("q", 0).alias("q1"), F.get("q", 1).alias("q3"))
    else:
        first, third = th.MI_BINS // 4 - 1, 3 * th.MI_BINS // 4 - 1
        quartiles = cuts.select(KEY, "pos", F.get("q", first).alias("q1"), F.get("q", third).alias("q3"))
    reach = th.FENCE * (F.col("q3") - F.col("q1"))
    fences = quartiles.where(F.col("q3") - F.col("q1") != 0).select(
        KEY, "pos", "q1", "q3", (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high")
    )
    outside = (F.col("x") < F.col("low")) | (F.col("x") > F.col("high"))
    return (
        numbers.join(fences, [KEY, "pos"])
        .groupBy(*by)
        .agg(
            F.max("q1").alias("q1"), F.max("q3").alias("q3"),
            (F.coalesce(F.sum(F.when(outside, F.col("cnt"))), F.lit(0)) / F.sum("cnt")).alias("outlier_share"),
        )
        .withColumn("is_outlier_column", F.col("outlier_share") > th.OUTLIER_SHARE)
    )


def scale_ranges(stats: DataFrame) -> DataFrame:
    """Range of every numeric column beside its dataset's range ratio and mismatch flag."""
    ranges = stats.where(F.col("kind").isin(*NUMERIC_KINDS)).select(
        KEY, "pos", "column_name", "min_num", "max_num", (F.col("max_num") - F.col("min_num")).alias("num_range")
    )
    return ranges.join(scale_summary(stats), KEY)


def scale_summary(stats: DataFrame) -> DataFrame:
    """Largest range over median positive range; the list per dataset is as long as the table is wide."""
    width = F.col("max_num") - F.col("min_num")
    positive = (
        stats.where(F.col("kind").isin(*NUMERIC_KINDS))
        .groupBy(KEY)
        .agg(F.sort_array(F.collect_list(F.when(width > 0, width))).alias("r"))
    )
    k = F.size("r")
    half = F.floor(k / 2).cast("int")
    median = F.when(k % 2 == 1, F.get("r", half)).otherwise((F.get("r", half - 1) + F.get("r", half)) / 2)
    ratio = F.when(k < 2, F.lit(1.0)).otherwise(F.get("r", k - 1) / median)
    return positive.select(
        KEY, ratio.alias("scale_ratio"), ((k >= 2) & (ratio >= th.SCALE_MISMATCH)).alias("scale_mismatch")
    )


def class_counts(df: DataFrame, target: str) -> DataFrame:
    """Rows per class, null being a class of its own."""
    return df.groupBy(KEY, F.col(target).cast("string").alias("class_label")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def class_balance(df: DataFrame, target: str) -> DataFrame:
    """Largest class over smallest class per dataset."""
    return balance_of(class_counts(df, target))


def balance_of(classes: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    ratio = F.max("n_rows") / F.greatest(F.min("n_rows"), F.lit(1))
    return classes.groupBy(KEY).agg(
        n.alias("n_classes"), F.when(n >= 2, ratio).otherwise(F.lit(1.0)).alias("imbalance_ratio")
    )


def sensitive_columns(columns: DataFrame) -> DataFrame:
    """Columns whose lower-cased name holds a protected word, over any (.., column_name) table."""
    return columns.withColumn("is_sensitive", fv.any_word(F.col("column_name"), th.SENSITIVE_WORDS))
