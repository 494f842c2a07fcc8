"""Column statistics and the semantic kind of every column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from assay import thresholds as th
from assay.functions import values as fv
from assay.operators.counts import KEY, TableInfo, value_counts, without_target

NUMERIC_KINDS = ("ordinal", "continuous")
TEXT_KINDS = ("categorical", "text", "boolean", "all_missing")


_WORDS = [w for pair in th.BOOLEAN_WORD_PAIRS for w in pair]


def word_bit(text: Column) -> Column:
    """One bit per word that can stand for a boolean, one more for any other text."""
    known = F.create_map(*[F.lit(x) for i, w in enumerate(_WORDS) for x in (w, 1 << i)])
    return F.when(text.isNotNull(), F.coalesce(F.try_element_at(known, fv.lower_trim(text)), F.lit(1 << len(_WORDS))))


def kind_of(family: Column, max_unique: int) -> Column:
    """Semantic kind of a column from its sums (int_like, n_numeric, words, ...) and distinct counts."""
    pair = F.lit(False)
    for a, b in th.BOOLEAN_WORD_PAIRS:
        pair = pair | (F.col("words") == (1 << _WORDS.index(a)) + (1 << _WORDS.index(b)))
    share = fv.safe_divide(F.col("int_like"), F.col("n_numeric"))
    numeric = F.when(
        F.col("numeric_unique").between(1, max_unique) & (share >= th.INTEGER_SHARE), "ordinal"
    ).otherwise("continuous")
    zero_one = (F.col("n_numeric") == F.col("n_present")) & (F.col("n_zero_one") == F.col("n_present"))
    return (
        F.when(F.col("n_present") == 0, "all_missing")
        .when((family == fv.BOOL) | ((family != fv.TIME) & zero_one) | pair, "boolean")
        .when(family.isin(fv.LONG, fv.DOUBLE), numeric)
        .when(family == fv.TIME, "datetime")
        .when(F.col("n_numeric") / F.col("n_present") > th.NUMERIC_TEXT_SHARE, numeric)
        .when(F.col("n_unique") <= max_unique, "categorical")
        .otherwise("text")
    )


def column_stats(counts: DataFrame, info: TableInfo, max_unique: int = th.CATEGORY_MAX_UNIQUE) -> DataFrame:
    """One row per (dataset, column) from value counts.

    Distinct parsed numbers are the only extra distinct; Spark shuffles it by value, never by column.
    """
    family = info.family_at(F.col("pos"))
    x = F.coalesce(F.col("num"), fv.parse_number(F.col("txt")))
    present = F.col("num").isNotNull() | F.col("txt").isNotNull()
    whole = F.abs(x - F.rint(x)) <= th.INTEGER_TOLERANCE
    rows = without_target(counts).select(
        KEY, "pos", "cnt",
        present.alias("present"),
        x.alias("x"),
        whole.alias("whole"),
        (family == fv.TEXT).alias("is_text"),
        F.when(family == fv.TEXT, word_bit(F.col("txt"))).alias("word"),
    )
    cnt, given = F.col("cnt"), F.col("present")
    n = lambda cond: F.coalesce(F.sum(F.when(cond, cnt)), F.lit(0))
    stats = rows.groupBy(KEY, "pos").agg(
        F.sum(cnt).alias("n_rows"),
        n(given).alias("n_present"),
        F.count_if(given).alias("n_unique"),
        F.max(cnt).alias("top_count"),
        n(F.col("x").isNotNull()).alias("n_numeric"),
        n(F.col("x").isin(0.0, 1.0)).alias("n_zero_one"),
        n(F.col("whole")).alias("int_like"),
        n(F.col("x") % 1 == 0).alias("n_whole"),
        F.min("x").alias("min_num"),
        F.max("x").alias("max_num"),
        F.coalesce(F.bit_or("word"), F.lit(0)).alias("words"),
        F.count_distinct(F.when(F.col("is_text"), F.col("x"))).alias("text_numbers"),
    )
    stats = stats.withColumn(
        "numeric_unique",
        F.when(info.family_at(F.col("pos")) == fv.TEXT, F.col("text_numbers")).otherwise(F.col("n_unique")),
    )
    return stats.select(
        KEY, "pos",
        info.name_of(F.col("pos")).alias("column_name"),
        info.family_at(F.col("pos")).alias("family"),
        info.float_at(F.col("pos")).alias("is_float"),
        "n_rows", "n_present",
        ((F.col("n_rows") - F.col("n_present")) / F.col("n_rows") * 100).alias("missing_pct"),
        "n_unique", "numeric_unique", "top_count",
        (F.col("top_count") / F.col("n_rows")).alias("top_share"),
        "n_numeric", "n_whole",
        fv.safe_divide(F.col("int_like"), F.col("n_numeric")).alias("int_share"),
        "min_num", "max_num",
        kind_of(info.family_at(F.col("pos")), max_unique).alias("kind"),
    )


def profile_columns(df: DataFrame, max_unique: int = th.CATEGORY_MAX_UNIQUE) -> DataFrame:
    """Column statistics of a table with a dataset key."""
    return column_stats(value_counts(df), TableInfo.of(df), max_unique)


def infer_schema(df: DataFrame, max_unique: int = th.CATEGORY_MAX_UNIQUE) -> DataFrame:
    """Semantic kind per column."""
    return profile_columns(df, max_unique).select(KEY, "pos", "column_name", "kind", "n_unique")


def missing_pct(df: DataFrame) -> DataFrame:
    """Missing share per column in one pass that shuffles one row per task and dataset."""
    info = TableInfo.of(df)
    missing = [
        F.avg(_is_missing(df, c).cast("int")).alias(f"m{i}") for i, c in enumerate(info.columns)
    ]
    wide = df.groupBy(KEY).agg(*missing)
    cells = [v for i, c in enumerate(info.columns) for v in (F.lit(c), F.col(f"m{i}") * 100)]
    return wide.select(KEY, F.stack(F.lit(len(info.columns)), *cells).alias("column_name", "missing_pct"))


def _is_missing(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    if df.schema[name].dataType.typeName() in ("float", "double"):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def near_constant(stats: DataFrame, threshold: float = th.NEAR_CONSTANT) -> DataFrame:
    """Columns where one value, null included, fills the threshold share of rows."""
    return stats.where(F.col("top_share") >= threshold).select(KEY, "pos", "column_name", "top_share")


def ordinal_report(stats: DataFrame, max_unique: int = th.CATEGORY_MAX_UNIQUE) -> DataFrame:
    """Ordinal columns with their distinct count and integer share, fewest values first."""
    return (
        stats.where((F.col("kind") == "ordinal") & F.col("n_unique").between(1, max_unique))
        .select(KEY, "pos", "column_name", "n_unique", "int_share")
        .orderBy(KEY, "n_unique", "pos")
    )


def feature_groups(stats: DataFrame, target: str) -> DataFrame:
    """Feature group of every column but the target."""
    kind = F.col("kind")
    group = (
        F.when((kind == "boolean") | ((kind == "categorical") & (F.col("n_unique") <= 2)), "binary")
        .when(kind == "categorical", "multiclass")
        .otherwise(kind)
    )
    return stats.where(F.col("column_name") != target).select(
        KEY, "pos", "column_name", "kind", "n_unique", group.alias("feature_group")
    )


def task_type(stats: DataFrame) -> DataFrame:
    """Would each column, as a target, be a classification one."""
    n, u = F.col("n_rows"), F.col("n_unique")
    whole_labels = (F.col("n_present") > 0) & (F.col("n_whole") == F.col("n_present")) & (u <= 20)
    is_cls = (
        F.when(F.col("family").isin(fv.TEXT, fv.OTHER), F.lit(True))
        .when(F.col("is_float"), whole_labels)
        .otherwise((u / n <= 0.05) | (u <= 50))
    )
    return stats.select(KEY, "pos", "column_name", is_cls.alias("is_classification"))
