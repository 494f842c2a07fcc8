"""One row of signals per dataset: everything the rules downstream look at."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from assay import thresholds as th
from assay.functions import values as fv
from assay.operators import leakage, pairs, quality, schema
from assay.operators.counts import KEY, TableInfo, value_counts
from assay.session import materialise
from assay.settings import Limits

EMPTY = "array<string>"


def _names(cond) -> F.Column:
    """Sorted names of the columns that meet a condition; as long as the table is wide at most."""
    return F.sort_array(F.collect_list(F.when(cond, F.col("column_name"))))


def _from_stats(stats: DataFrame, target: str) -> DataFrame:
    feature = F.col("column_name") != target
    u, n, kind = F.col("n_unique"), F.col("n_rows"), F.col("kind")
    high_card = feature & (
        ((kind == "categorical") & (u > th.ONE_HOT_MAX_UNIQUE))
        | ((kind == "text") & (u > th.ONE_HOT_MAX_UNIQUE) & (u < n * th.TEXT_MAX_SHARE))
    )
    return stats.groupBy(KEY).agg(
        F.max("n_rows").alias("rows"),
        F.count(F.lit(1)).alias("cols"),
        F.max("missing_pct").alias("max_missing"),
        _names(feature & (F.col("top_share") >= th.NEAR_CONSTANT)).alias("near_constant_cols"),
        _names(fv.any_word(F.col("column_name"), th.SENSITIVE_WORDS)).alias("sensitive_cols"),
        _names(feature & (kind == "ordinal")).alias("ordinal_cols"),
        F.coalesce(F.bool_or(feature & (kind == "datetime")), F.lit(False)).alias("has_datetime"),
        F.coalesce(F.bool_or(high_card), F.lit(False)).alias("high_card"),
        F.max(F.struct("missing_pct", (-F.col("pos")).alias("p"), "column_name")).getField("column_name").alias("most_missing"),
    )


def _listed(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy(KEY).agg(F.sort_array(F.collect_list("column_name")).alias(name))


def signals(
    df: DataFrame, target: str, classification: bool = True, joint: DataFrame | None = None, stats: DataFrame | None = None,
    limits: Limits = Limits(),
) -> DataFrame:
    """Signals of every dataset in a keyed table.

    All statistics come from one joint count of (column, value, target), written once and read by each
    part, one pairwise aggregate and one digest count; what is joined afterwards is one row per dataset.
    """
    info = TableInfo.of(df)
    joint = materialise(value_counts(df, target=target)) if joint is None else joint
    stats = materialise(schema.column_stats(joint, info)) if stats is None else stats
    base = _from_stats(stats, target)

    cuts = materialise(quality.column_cuts(joint, stats))
    outliers = quality.outlier_shares(joint, stats, cuts).where(
        F.col("is_outlier_column") & (F.col("column_name") != target)
    )
    hard = leakage.hard_leakage(joint, stats, target, all_columns=False).where(F.col("reason").isNotNull())
    corr = pairs.strongest_pairs(pairs.correlation_pairs(df), stats, th.HIGH_CORR, limits.corr_drop_pairs)
    clear = (F.col("col_a") != target) & (F.col("col_b") != target)
    corr = corr.groupBy(KEY).agg(
        F.max("abs_corr").alias("max_abs_corr"),
        F.sort_array(F.collect_set(F.when(clear & (F.round("abs_corr", 4) >= th.CORR_DROP), F.col("col_b")))).alias("corr_cols"),
    )
    out = (
        base.join(quality.scale_summary(stats), KEY, "left")
        .join(quality.duplicate_stats(df).select(KEY, "duplicate_count", "duplicate_pct"), KEY, "left")
        .join(_listed(outliers, "outlier_cols"), KEY, "left")
        .join(_listed(hard, "hard_cols"), KEY, "left")
        .join(corr, KEY, "left")
    )
    if classification:
        soft = leakage.mutual_information(joint, stats, target, cuts).where(F.col("normalised_mi") >= th.LEAKAGE_MI)
        soft = soft.join(hard.select(KEY, "column_name"), [KEY, "column_name"], "left_anti")
        out = out.join(_listed(soft, "soft_cols"), KEY, "left").join(quality.class_balance(df, target), KEY, "left")
    else:
        none = F.array().cast(EMPTY)
        out = out.select("*", none.alias("soft_cols"), F.lit(None).cast("bigint").alias("n_classes"),
                         F.lit(None).cast("double").alias("imbalance_ratio"))
    lists = ["outlier_cols", "hard_cols", "soft_cols", "corr_cols"]
    filled = {c: F.coalesce(F.col(c), F.array().cast(EMPTY)) for c in lists}
    features = F.greatest(F.col("cols") - 1, F.lit(1))
    return (
        out.withColumns(filled)
        .withColumn("is_classification", F.lit(classification))
        .withColumn("max_abs_corr", F.coalesce("max_abs_corr", F.lit(0.0)))
        .withColumn("features", features)
        .withColumn(
            "high_dim",
            (features >= th.WIDE_FEATURES) | (features / F.greatest(F.col("rows"), F.lit(1)) >= th.WIDE_FEATURE_RATIO),
        )
    )


def profile_notes(sig: DataFrame) -> DataFrame:
    """Notes that the thresholds trigger, in a fixed order: (dataset_id, pos, note)."""
    some = lambda c: F.size(c) > 0
    first5 = lambda c: F.concat_ws(", ", F.slice(c, 1, 5))
    every = lambda c: F.concat_ws(", ", c)
    say = lambda *parts: F.concat(*[p if isinstance(p, F.Column) else F.lit(p) for p in parts])
    notes = fv.drop_null_items(
        F.when(F.col("rows") < th.SMALL_ROWS, F.lit("small_dataset")),
        F.when(F.col("cols") > 100, F.lit("high_dimensionality")),
        F.when(some("ordinal_cols"), say("ordinal: ", first5("ordinal_cols"))),
        F.when(F.col("duplicate_count") > 0, say("duplicates: ", F.col("duplicate_count").cast("string"))),
        F.when(some("near_constant_cols"), say("near_constant: ", first5("near_constant_cols"))),
        F.when(some("outlier_cols"), say("outliers: ", first5("outlier_cols"))),
        F.when(some("hard_cols"), say("hard_leakage: ", every("hard_cols"))).when(
            some("soft_cols"), say("soft_leakage: ", every("soft_cols"))
        ),
        F.when(some("sensitive_cols"), say("sensitive: ", every("sensitive_cols"))),
        F.when(F.col("scale_mismatch"), F.lit("scale_mismatch")),
        F.when(F.col("imbalance_ratio") >= th.IMBALANCED, F.lit("imbalance")),
        F.when(~F.col("is_classification"), F.lit("regression_target")),
    )
    return sig.select(KEY, F.posexplode(notes).alias("pos", "note"))


def profile_long(df: DataFrame, target: str) -> DataFrame:
    """The whole profile in long form: (dataset_id, column_name, stat, value)."""
    joint = materialise(value_counts(df, target=target))
    stats = materialise(schema.column_stats(joint, TableInfo.of(df)))
    numbers = ["n_rows", "n_present", "n_unique", "missing_pct", "top_share", "int_share", "min_num", "max_num"]
    texts = ["kind", "family"]
    cells = [x for c in numbers + texts for x in (F.lit(c), F.col(c).cast("string"))]
    columns = stats.select(KEY, "column_name", F.stack(F.lit(len(cells) // 2), *cells).alias("stat", "value"))
    sig = signals(df, target, joint=joint, stats=stats)
    lists = ["near_constant_cols", "sensitive_cols", "outlier_cols", "hard_cols", "soft_cols", "corr_cols"]
    scalars = ["rows", "cols", "max_missing", "imbalance_ratio", "scale_ratio", "max_abs_corr", "duplicate_count"]
    cells = [x for c in lists for x in (F.lit(c), F.concat_ws(",", c))]
    cells += [x for c in scalars for x in (F.lit(c), F.col(c).cast("string"))]
    whole = sig.select(KEY, F.lit("*").alias("column_name"), F.stack(F.lit(len(cells) // 2), *cells).alias("stat", "value"))
    classes = quality.class_counts(df, target).select(
        KEY, F.lit(target).alias("column_name"),
        F.concat(F.lit("class_count:"), F.coalesce("class_label", F.lit("null"))).alias("stat"),
        F.col("n_rows").cast("string").alias("value"),
    )
    return columns.unionByName(whole).unionByName(classes)
