"""Target leakage from joint counts of every feature value with the target value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from assay import thresholds as th
from assay.functions import values as fv
from assay.operators.counts import KEY, normal_text
from assay.operators.quality import column_cuts
from assay.operators.schema import TEXT_KINDS
from assay.session import materialise


def _number_text(num: Column) -> Column:
    """Numbers as text, whole ones without a fraction, for boolean-kind columns."""
    return F.when((num % 1 == 0) & (F.abs(num) < 1e15), num.cast("long").cast("string")).otherwise(
        num.cast("string")
    )


def _normal_form(num: Column, txt: Column, kind: Column) -> Column:
    """(text, number) a column is compared in; text kinds turn a null into the text 'nan'."""
    text = F.coalesce(normal_text(F.coalesce(txt, _number_text(num))), F.lit("nan"))
    number = F.coalesce(num, fv.parse_number(txt))
    is_text = kind.isin(*TEXT_KINDS)
    return F.when(is_text, F.struct(text.alias("t"), F.lit(None).cast("double").alias("x"))).otherwise(
        F.when(number.isNotNull(), F.struct(F.lit(None).cast("string").alias("t"), number.alias("x")))
    )


def _entropy_sum(n: Column) -> Column:
    return F.sum(n * F.log(n))


def _can_match(stats: DataFrame, target: str) -> DataFrame:
    """Columns that could still be a copy or mapping of the target.

    With a gap-free target, a numeric column of more distinct values than the mapping bound can be
    neither, so its values need not be compared at all.
    """
    table = Window.partitionBy(KEY)  # one row per column of the dataset
    is_target = F.col("column_name") == target
    y_values = F.max(F.when(is_target, F.col("n_unique"))).over(table)
    y_full = F.max(F.when(is_target, F.col("n_present") == F.col("n_rows"))).over(table)
    marked = stats.withColumns({"_y_values": y_values, "_y_full": y_full})
    too_many = F.col("n_unique") > F.greatest(F.lit(20), F.col("_y_values") * 4)
    measured = F.col("family").isin(fv.LONG, fv.DOUBLE, fv.TIME) & ~F.col("kind").isin(*TEXT_KINDS)
    return marked.where(is_target | ~(F.col("_y_full") & measured & too_many)).drop("_y_values", "_y_full")


def hard_leakage(joint: DataFrame, stats: DataFrame, target: str, all_columns: bool = True) -> DataFrame:
    """Per feature: exact copy of the target, or low-cardinality two-way mapping onto it.

    Three count levels: (feature, target) pairs, feature values, columns. A two-way mapping means
    every value sees one target value and no target value is seen twice. ``all_columns=False`` leaves
    out columns whose distinct count alone rules both out.
    """
    stats = stats if all_columns else _can_match(stats, target)
    table = Window.partitionBy(KEY)  # one row per column of the dataset
    is_target = F.col("column_name") == target
    # Written out, so that Spark knows how small it is and never sends the counts to every task in its place.
    kinds = materialise(stats.select(
        KEY, "pos", "column_name", "kind", F.max(F.when(is_target, F.col("kind"))).over(table).alias("y_kind")
    ))
    pairs = (
        joint.join(kinds, [KEY, "pos"])
        .select(
            KEY, "pos", "column_name",
            _normal_form(F.col("num"), F.col("txt"), F.col("kind")).alias("f"),
            _normal_form(F.col("y_num"), F.col("y_txt"), F.col("y_kind")).alias("y"),
        )
        .where(F.col("f").isNotNull() & F.col("y").isNotNull())
        .distinct()
    )
    same = F.coalesce(F.col("f.t") == F.col("y.t"), F.col("f.x") == F.col("y.x"), F.lit(False))
    per_value = pairs.groupBy(KEY, "pos", "column_name", "f").agg(
        F.count(F.lit(1)).alias("n_y"), F.min("y").alias("y0"), F.bool_and(same).alias("same")
    )
    columns = per_value.groupBy(KEY, "pos", "column_name").agg(
        F.count(F.lit(1)).alias("n_values"),
        F.max("n_y").alias("max_y"),
        F.bool_and("same").alias("all_same"),
        F.count_distinct("y0").alias("n_y0"),
    ).withColumn("y_values", F.max(F.when(is_target, F.col("n_values"))).over(table))
    low_card = F.col("n_values").between(2, F.greatest(F.lit(20), F.col("y_values") * 4))
    two_way = (F.col("max_y") == 1) & (F.col("n_y0") == F.col("n_values")) & low_card
    reason = F.when(F.col("all_same"), "exact_target_copy").when(two_way, "deterministic_target_mapping")
    return columns.where(~is_target).select(KEY, "pos", "column_name", "n_values", reason.alias("reason"))


def mutual_information(joint: DataFrame, stats: DataFrame, target: str, cuts: DataFrame | None = None) -> DataFrame:
    """Bias-corrected mutual information of every feature with a class target, over target entropy.

    Numbers and times are cut at exact quantiles, other values count as they are. Both marginals come
    from one grouping-sets aggregate, so neither a hot value nor a hot class is ever gathered. Text
    columns with more distinct values than half the rows are skipped: any identifier would look like
    a perfect proxy.
    """
    kinds = stats.where(F.col("column_name") != target)
    kinds = kinds.where(~((F.col("kind") == "text") & (F.col("n_unique") / F.col("n_rows") > 0.5)))
    x = F.coalesce(F.col("num"), fv.parse_number(F.col("txt")))
    rows = joint.join(kinds.select(KEY, "pos", "column_name", "kind"), [KEY, "pos"]).select(
        KEY, "pos", "column_name", "num", "txt", "y_num", "y_txt", "cnt",
        F.when(~F.col("kind").isin(*TEXT_KINDS), x).alias("x"), (~F.col("kind").isin(*TEXT_KINDS)).alias("is_number"),
    )
    if cuts is None:
        cuts = column_cuts(joint, stats)
    cuts = cuts.select(KEY, "pos", F.col("q").alias("cuts"), F.get("q", th.MI_BINS // 2 - 1).alias("median"))
    filled = F.coalesce(F.col("x"), F.col("median"))
    passed = [F.when(F.get("cuts", i) <= filled, 1).otherwise(0) for i in range(th.MI_BINS - 1)]
    bin_no = sum(passed[1:], passed[0]).cast("string")
    code = F.when(F.col("is_number"), bin_no).otherwise(
        F.coalesce(F.concat(F.lit("v:"), F.coalesce(F.col("txt"), F.col("num").cast("string"))), F.lit("null"))
    )
    cells = (
        rows.join(cuts, [KEY, "pos"], "left")
        .select(KEY, "pos", "column_name", code.alias("b"), F.struct("y_num", "y_txt").alias("y"), "cnt")
        .groupBy(KEY, "pos", "column_name", "b", "y").agg(F.sum("cnt").alias("n"))
    )
    by = [KEY, "pos", "column_name"]
    margins = cells.groupingSets([[*by, "b"], [*by, "y"]], *by, "b", "y").agg(
        F.grouping("y").alias("is_x"), F.sum("n").alias("n"), _entropy_sum(F.col("n")).alias("cell_sum"),
        F.count(F.lit(1)).alias("cells"),
    )
    of_x, of_y = F.col("is_x") == 1, F.col("is_x") == 0
    m = F.col("n")
    sums = margins.groupBy(*by).agg(
        F.sum(F.when(of_x, m)).alias("n"),
        F.sum(F.when(of_x, F.col("cell_sum"))).alias("a_xy"), F.sum(F.when(of_x, F.col("cells"))).alias("k_xy"),
        F.sum(F.when(of_x, m * F.log(m))).alias("a_x"), F.count_if(of_x).alias("k_x"),
        F.sum(F.when(of_y, m * F.log(m))).alias("a_y"), F.count_if(of_y).alias("k_y"),
    )
    bias = (F.col("k_xy") - F.col("k_x") - F.col("k_y") + 1) / (m * 2)
    mi = F.log(m) + (F.col("a_xy") - F.col("a_x") - F.col("a_y")) / m - bias
    entropy = F.log(m) - F.col("a_y") / m
    return sums.select(
        *by, mi.alias("mi"), entropy.alias("target_entropy"),
        F.when(F.col("k_y") > 1, F.greatest(mi, F.lit(0.0)) / F.when(F.col("k_y") > 1, entropy)).alias("normalised_mi"),
    )


def target_entropy(classes: DataFrame) -> DataFrame:
    """Entropy of the class counts in nats."""
    n = F.col("n_rows")
    return classes.groupBy(KEY).agg(
        (F.log(F.sum(n)) - _entropy_sum(n) / F.sum(n)).alias("target_entropy")
    )


def leakage_report(joint: DataFrame, stats: DataFrame, target: str, threshold: float = th.LEAKAGE_MI) -> DataFrame:
    """Hard evidence first, then soft evidence by score: (dataset, column, level, reason, score)."""
    hard = hard_leakage(joint, stats, target, False).where(F.col("reason").isNotNull())
    hard = hard.select(KEY, "column_name", F.lit("hard").alias("level"), "reason", F.lit(None).cast("double").alias("normalised_mi"))
    soft = mutual_information(joint, stats, target).where(F.col("normalised_mi") >= threshold)
    soft = soft.join(hard.select(KEY, "column_name"), [KEY, "column_name"], "left_anti").select(
        KEY, "column_name", F.lit("soft").alias("level"), F.lit("high_mutual_information").alias("reason"), "normalised_mi"
    )
    return hard.unionByName(soft).orderBy(
        KEY, "level", F.coalesce("normalised_mi", F.lit(0.0)).desc(), "column_name"
    )
