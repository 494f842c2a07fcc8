"""Feature preparation: statistics fitted by aggregates, applied as plain column expressions."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window, functions as F

from assay import thresholds as th
from assay.functions import values as fv
from assay.operators.counts import KEY
from assay.operators.quantiles import column_quantiles, weighted_quantiles
from assay.operators.ranks import rank_rows
from assay.settings import Limits


def factorize(df: DataFrame, column: str) -> DataFrame:
    """Adds code: dense integers in text order, ranked over the distinct values only."""
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("_v")).distinct()
    text = F.col("_v").cast("string")
    codes = rank_rows(values, [], text, F.substring(text, 1, 2), "code")
    return df.join(codes, F.col(column) == F.col("_v"), "left").drop("_v")


def one_row_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """Quantiles of a few columns as one wide row: <column>_q<i>."""
    keyed = df.withColumn(KEY, F.lit("table"))
    long = column_quantiles(keyed, [KEY], columns, probs)
    picks = [
        F.max(F.when(F.col("column_name") == c, F.get("q", i))).alias(f"{c}_q{i}")
        for c in columns for i in range(len(probs))
    ]
    return long.agg(*picks)


def impute_median(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls of numeric columns become the exact column median."""
    medians = one_row_quantiles(df, columns, [0.5])
    # One row: as many numbers as columns.
    joined = df.join(F.broadcast(medians))
    return joined.select(
        *[
            F.coalesce(F.col(c).cast("double"), F.col(f"{c}_q0")).alias(c) if c in columns else F.col(c)
            for c in df.columns
        ]
    )


def modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Most frequent value per column, smallest on ties; counted per value, never per column."""
    cells = [x for c in columns for x in (F.lit(c), F.col(c).cast("string"))]
    long = df.select(F.stack(F.lit(len(columns)), *cells).alias("column_name", "v")).where("v is not null")
    counts = long.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column_name").agg(
        F.min(F.struct((-F.col("n")).alias("less"), F.col("v").alias("v"))).getField("v").alias("mode_value")
    )


def impute_mode(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls of categorical columns become the most frequent value."""
    top = modes(df, columns).agg(
        *[F.max(F.when(F.col("column_name") == c, F.col("mode_value"))).alias(f"{c}_mode") for c in columns]
    )
    joined = df.join(F.broadcast(top))  # one row
    return joined.select(
        *[
            F.coalesce(F.col(c).cast("string"), F.col(f"{c}_mode")).alias(c) if c in columns else F.col(c)
            for c in df.columns
        ]
    )


def impute_robust(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """Median plus a missing indicator for numbers, the text '__missing__' for categories."""
    flags = [F.col(c).isNull().cast("int").alias(f"{c}_missing") for c in numeric]
    marked = df.select(*df.columns, *flags)
    filled = impute_median(marked, numeric) if numeric else marked
    return filled.select(
        *[
            F.coalesce(F.col(c).cast("string"), F.lit("__missing__")).alias(c) if c in categorical else F.col(c)
            for c in filled.columns
        ]
    )


def standard_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """(x - mean) / population deviation; a constant column becomes zero."""
    fit = df.agg(
        *[F.avg(c).alias(f"{c}_avg") for c in columns], *[F.stddev_pop(c).alias(f"{c}_std") for c in columns]
    )
    joined = df.join(F.broadcast(fit))  # one row
    scaled = lambda c: (
        (F.col(c) - F.col(f"{c}_avg")) / F.when(F.col(f"{c}_std") > 0, F.col(f"{c}_std")).otherwise(F.lit(1.0))
    )
    return joined.select(*[scaled(c).alias(c) if c in columns else F.col(c) for c in df.columns])


def robust_scale(df: DataFrame, columns: list[str], unit_variance: bool = False) -> DataFrame:
    """(x - median) / IQR, the IQR over 1.349 with unit variance; a zero IQR only centres."""
    fit = one_row_quantiles(df, columns, [0.25, 0.5, 0.75])
    joined = df.join(F.broadcast(fit))  # one row
    divisor = th.NORMAL_IQR if unit_variance else 1.0
    def scaled(c: str) -> Column:
        iqr = F.col(f"{c}_q2") - F.col(f"{c}_q0")
        return (F.col(c) - F.col(f"{c}_q1")) / F.when(iqr == 0, F.lit(1.0)).otherwise(iqr / divisor)
    return joined.select(*[scaled(c).alias(c) if c in columns else F.col(c) for c in df.columns])


def polynomial_columns(columns: list[str]) -> dict[str, Column]:
    """Degree-two terms without a constant: each column, then each product."""
    out = {c: F.col(c) for c in columns}
    for a, b in combinations_with_replacement(columns, 2):
        out[f"{a}_x_{b}"] = F.col(a) * F.col(b)
    return out


def polynomial(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """Degree-two terms of the columns, each standard scaled."""
    terms = polynomial_columns(columns)
    wide = df.select(*keep, *[e.alias(n) for n, e in terms.items()])
    return standard_scale(wide, list(terms))


def category_levels(df: DataFrame, columns: list[str], max_levels: int = th.ONE_HOT_MAX_UNIQUE) -> dict[str, list[str]]:
    """Sorted levels per column; only for columns whose level count the schema step has bounded."""
    cells = [x for c in columns for x in (F.lit(c), F.col(c).cast("string"))]
    long = df.select(F.stack(F.lit(len(columns)), *cells).alias("column_name", "v")).where("v is not null").distinct()
    out: dict[str, list[str]] = {c: [] for c in columns}
    for row in long.limit(len(columns) * max_levels + 1).collect():
        out[row["column_name"]].append(row["v"])
    if sum(map(len, out.values())) > len(columns) * max_levels:
        raise ValueError("one-hot columns hold more levels than the routing step allows")
    return {c: sorted(v) for c, v in out.items()}


def one_hot_columns(levels: dict[str, list[str]]) -> dict[str, Column]:
    """0/1 columns per level; a binary column keeps one; unknown values are zero everywhere."""
    out: dict[str, Column] = {}
    for c, values in levels.items():
        for v in values[1:] if len(values) == 2 else values:
            hit = (F.col(c).cast("string") == v).cast("double")
            out[f"{c}_{v}"] = F.coalesce(hit, F.lit(0.0))
    return out


def target_encode(
    df: DataFrame, column: str, target: str, fold: str, smoothing: float | None = None, out: str = "encoded"
) -> DataFrame:
    """Adds the out-of-fold target mean of the row's category, shrunk to the out-of-fold global mean.

    Sums per (category, fold) are small partial aggregates; a category's own folds are subtracted
    there, so no row ever meets all rows of its category. ``smoothing`` is the weight of the global
    mean in rows; without it the weight is the ratio of variance inside the category to variance of
    the target.
    """
    y = F.col(target).cast("double")
    parts = df.groupBy(F.col(column).alias("_c"), F.col(fold).alias("_f")).agg(
        F.sum(y).alias("s"), F.sum(y * y).alias("ss"), F.count(y).alias("n")
    )
    per_fold = parts.groupBy("_f").agg(F.sum("s").alias("fs"), F.sum("ss").alias("fss"), F.sum("n").alias("fn"))
    all_folds = per_fold.agg(F.sum("fs").alias("ts"), F.sum("fss").alias("tss"), F.sum("fn").alias("tn"))
    rest = per_fold.join(F.broadcast(all_folds)).select(  # one row
        "_f", (F.col("ts") - F.col("fs")).alias("gs"), (F.col("tss") - F.col("fss")).alias("gss"),
        (F.col("tn") - F.col("fn")).alias("gn"),
    )
    per_category = parts.groupBy("_c").agg(F.sum("s").alias("cs"), F.sum("ss").alias("css"), F.sum("n").alias("cn"))
    per_category = per_category.withColumnRenamed("_c", "_cc")
    mine = parts.join(per_category, F.col("_c").eqNullSafe(F.col("_cc"))).select(
        "_c", "_f", (F.col("cs") - F.col("s")).alias("os"), (F.col("css") - F.col("ss")).alias("oss"),
        (F.col("cn") - F.col("n")).alias("on"),
    ).join(rest, "_f")
    g_mean = F.col("gs") / F.when(F.col("gn") > 0, F.col("gn"))
    g_var = F.col("gss") / F.when(F.col("gn") > 0, F.col("gn")) - g_mean * g_mean
    o_mean = F.col("os") / F.when(F.col("on") > 0, F.col("on"))
    if smoothing is not None:
        encoded = (F.col("os") + g_mean * smoothing) / (F.col("on") + F.lit(float(smoothing)))
    else:
        o_var = F.col("oss") / F.when(F.col("on") > 0, F.col("on")) - o_mean * o_mean
        weight = F.col("on") * g_var / F.when(F.col("on") * g_var + o_var > 0, F.col("on") * g_var + o_var)
        encoded = weight * o_mean + (1 - weight) * g_mean
    table = mine.select(F.col("_c").alias("_tc"), F.col("_f").alias("_tf"), F.coalesce(encoded, g_mean).alias(out))
    match = F.col(column).eqNullSafe(F.col("_tc")) & (F.col(fold) == F.col("_tf"))
    return df.join(table, match, "left").drop("_tc", "_tf")


def target_means(df: DataFrame, column: str, target: str, smoothing: float | None = None, out: str = "encoded") -> DataFrame:
    """Category to shrunk target mean over all rows, for scoring new rows; unseen ones take the global mean."""
    y = F.col(target).cast("double")
    per = df.groupBy(F.col(column).alias("_c")).agg(
        F.sum(y).alias("s"), F.avg(y).alias("m"), F.var_pop(y).alias("v"), F.count(y).alias("n")
    )
    whole = df.agg(F.avg(y).alias("g_mean"), F.var_pop(y).alias("g_var"))
    n = F.col("n")
    if smoothing is not None:
        encoded = (F.col("s") + F.col("g_mean") * smoothing) / (n + F.lit(float(smoothing)))
    else:
        weight = n * F.col("g_var") / F.when(n * F.col("g_var") + F.col("v") > 0, n * F.col("g_var") + F.col("v"))
        encoded = weight * F.col("m") + (1 - weight) * F.col("g_mean")
    return per.join(F.broadcast(whole)).select("_c", F.coalesce(encoded, F.col("g_mean")).alias(out), "g_mean")


def category_means(df: DataFrame, column: str, targets: list[str]) -> DataFrame:
    """(column, means): every category's shrunk means of several targets at once, by the ratio of variances.

    One aggregate over the rows serves all targets; the means over all rows follow from its sums.
    """
    sums = [x for i, t in enumerate(targets) for x in (
        F.avg(t).alias(f"m{i}"), F.var_pop(t).alias(f"v{i}"), F.count(t).alias(f"n{i}"))]
    per = df.groupBy(column).agg(*sums)
    whole = df.agg(*[x for i, t in enumerate(targets) for x in (F.avg(t).alias(f"g{i}"), F.var_pop(t).alias(f"gv{i}"))])
    means = []
    for i in range(len(targets)):
        n, pull = F.col(f"n{i}"), F.col(f"n{i}") * F.col(f"gv{i}") + F.col(f"v{i}")
        weight = n * F.col(f"gv{i}") / F.when(pull > 0, pull)
        shrunk = weight * F.col(f"m{i}") + (1 - weight) * F.col(f"g{i}")
        means.append(F.coalesce(shrunk, F.col(f"g{i}"), F.lit(0.0)))
    return per.join(F.broadcast(whole)).select(column, F.array(*means).alias("means"))  # whole is one row


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight per class: rows / (classes x class rows)."""
    sizes = df.groupBy(F.col(label).alias("class_label")).agg(F.count(F.lit(1)).alias("class_rows"))
    whole = sizes.agg(F.sum("class_rows").alias("n"), F.count(F.lit(1)).alias("k"))
    return sizes.join(F.broadcast(whole)).select(
        "class_label", "class_rows", (F.col("n") / (F.col("k") * F.col("class_rows"))).alias("class_weight")
    )


def missing_limit(rows: Column, limits: Limits = Limits()) -> Column:
    """Missing share above which a column is dropped; one limit unless ``limits`` has several by row count."""
    out = F.lit(limits.missing_limits[-1][1])
    for below, percent in reversed(limits.missing_limits[:-1]):
        out = F.when(rows < below, F.lit(percent)).otherwise(out)
    return out


def encoding_route(groups: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Route per feature: scaled number, one-hot, target encoding or left out.

    ``groups`` carries feature_group, n_unique, n_rows and missing_pct per column.
    """
    u, n = F.col("n_unique"), F.col("n_rows")
    group = F.col("feature_group")
    few = (u < th.ONE_HOT_MAX_UNIQUE) & (u / F.greatest(n, F.lit(1)) < th.ONE_HOT_MAX_SHARE)
    like_category = (u > th.ONE_HOT_MAX_UNIQUE) & (u < n * th.TEXT_MAX_SHARE)
    route = (
        F.when(F.col("missing_pct") > missing_limit(n, limits), "too_many_missing")
        .when(group.isin("ordinal", "continuous"), "numeric")
        .when((group == "binary") | ((group == "multiclass") & few), "one_hot")
        .when((group == "multiclass") | ((group == "text") & like_category), "target_encoding")
        .otherwise("left_out")
    )
    return groups.withColumn("route", route)


def keep_list(routes: DataFrame, dropped: DataFrame) -> DataFrame:
    """Kept features per dataset with their count; zero kept is the feature cascade.

    ``dropped`` lists (dataset_id, column_name, drop_reason) that apply under the dataset's flags.
    """
    marked = routes.join(dropped, [KEY, "column_name"], "left")
    kept = F.col("drop_reason").isNull() & F.col("route").isin("numeric", "one_hot", "target_encoding")
    return marked.withColumn("kept", kept)


def cascade(kept: DataFrame) -> DataFrame:
    """Datasets and their kept feature count, flagged where nothing is left."""
    out = kept.groupBy(KEY).agg(F.count_if("kept").alias("n_kept"))
    return out.withColumn("feature_cascade", F.col("n_kept") == 0)
