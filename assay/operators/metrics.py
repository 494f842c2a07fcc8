"""Scores of predictions, all from counts of (label, prediction) or sums of errors.

``by`` names the grouping columns, for example dataset, model and fold. A class that holds most rows
reaches the shuffle as one partial count per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from assay import thresholds as th


def confusion_counts(predictions: DataFrame, by: list[str]) -> DataFrame:
    """(by..., label, prediction, n) with both sides as text."""
    text = predictions.select(*by, F.col("label").cast("string"), F.col("prediction").cast("string"))
    return text.groupBy(*by, "label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(confusion: DataFrame, by: list[str], labels: list[str]) -> DataFrame:
    """One row per true label, one column per predicted label, over the union of both."""
    sides = F.explode(F.array_distinct(F.array("label", "prediction"))).alias("label")
    every = confusion.select(*by, sides).distinct()
    pivoted = confusion.groupBy(*by, "label").pivot("prediction", labels).agg(F.sum("n"))
    return every.join(pivoted, [*by, "label"], "left").na.fill(0, labels)


def class_report(confusion: DataFrame, by: list[str]) -> DataFrame:
    """Precision, recall, F1 and support per class of the label union; a zero division gives zero."""
    n = F.col("n")
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(zero)
    sides = F.array(
        F.struct(F.col("label").alias("class_label"), n.alias("true_n"), zero.alias("pred_n"), hit.alias("hit_n")),
        F.struct(F.col("prediction").alias("class_label"), zero.alias("true_n"), n.alias("pred_n"), zero.alias("hit_n")),
    )
    per = confusion.select(*by, F.inline(sides)).groupBy(*by, "class_label").agg(
        F.sum("hit_n").alias("hits"), F.sum("true_n").alias("support"), F.sum("pred_n").alias("predicted")
    )
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    precision, recall = share(F.col("hits"), F.col("predicted")), share(F.col("hits"), F.col("support"))
    f1 = share(F.col("hits") * 2, F.col("support") + F.col("predicted"))
    return per.select(
        *by, "class_label", "support", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "hits"
    )


def class_metrics(report: DataFrame, by: list[str]) -> DataFrame:
    """Accuracy, balanced accuracy over true classes, and macro scores over the label union."""
    return report.groupBy(*by).agg(
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.avg("f1").alias("f1_macro"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
    )


def score_classes(predictions: DataFrame, by: list[str]) -> DataFrame:
    return class_metrics(class_report(confusion_counts(predictions, by), by), by)


def score_numbers(predictions: DataFrame, by: list[str]) -> DataFrame:
    """R2, MAE and RMSE in one pass; R2 is null where the label does not vary."""
    error = F.col("label") - F.col("prediction")
    total = F.var_pop("label") * F.count("label")
    return predictions.groupBy(*by).agg(
        (1 - F.sum(error * error) / F.when(total > 0, total)).alias("r2"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
    )


def leaderboard(metrics: DataFrame, by: list[str], classification: bool, order: Column) -> DataFrame:
    """Adds rank: best first, the earlier candidate (lower ``order``) winning ties."""
    best = [F.col("balanced_accuracy").desc(), F.col("f1_macro").desc()] if classification else [F.col("r2").desc()]
    ranked = Window.partitionBy(*by).orderBy(*best, order)
    return metrics.withColumn("rank", F.row_number().over(ranked))


def demographic_parity(scored: DataFrame, by: list[str], group: str, top: int | None = None) -> DataFrame:
    """Selection rate of the positive class in every group, and smallest over largest rate.

    ``top`` limits the report to the largest groups.

    Two predicted classes with '1' or 'true' among them: that one is positive; else the rarest.
    """
    counts = scored.groupBy(*by, F.col(group).cast("string").alias("group_value"), F.col("prediction").cast("string").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )
    per_class = counts.groupBy(*by, "prediction").agg(F.sum("n").alias("n"))
    word = F.lower("prediction")
    classes = per_class.groupBy(*by).agg(
        F.count(F.lit(1)).alias("k"),
        F.max(F.when(word.isin("1", "1.0", "true"), F.col("prediction"))).alias("yes"),
        F.min(F.struct("n", "prediction")).getField("prediction").alias("rarest"),
    )
    positive = F.when((F.col("k") == 2) & F.col("yes").isNotNull(), F.col("yes")).otherwise(F.col("rarest"))
    rates = (
        counts.where("group_value is not null")
        .join(classes.select(*by, positive.alias("positive")), by)
        .groupBy(*by, "group_value", "positive")
        .agg(
            F.sum("n").alias("n"),
            (F.coalesce(F.sum(F.when(F.col("prediction") == F.col("positive"), F.col("n"))), F.lit(0)) / F.sum("n")).alias("selection_rate"),
        )
    )
    if top is not None:
        size = Window.partitionBy(*by).orderBy(F.col("n").desc(), "group_value")
        rates = rates.withColumn("size_rank", F.row_number().over(size)).where(F.col("size_rank") <= top)
    # Extremes by a map-side aggregate: a key column has as many groups as rows.
    ends = rates.groupBy(*by).agg(F.min("selection_rate").alias("lowest"), F.max("selection_rate").alias("highest"))
    rates = rates.join(ends, by)
    ratio = F.when(F.col("highest") > 0, F.col("lowest") / F.col("highest")).otherwise(F.lit(1.0))
    return rates.select(*by, "group_value", "positive", "n", "selection_rate", ratio.alias("parity_ratio"))


def class_scores(report: DataFrame) -> DataFrame:
    """Chart table of per-class F1 with a flag below the balanced floor."""
    return report.withColumn("below_floor", F.col("f1") < th.F1_FLOOR)


def residuals(predictions: DataFrame) -> DataFrame:
    """Chart table of predicted against actual values."""
    return predictions.withColumn("residual", F.col("label") - F.col("prediction"))


def cv_summary(fold_metrics: DataFrame, by: list[str], classification: bool) -> DataFrame:
    """Mean, population deviation and ordered fold scores per model, ranked by the primary mean."""
    primary = "balanced_accuracy" if classification else "r2"
    names = ["accuracy", "balanced_accuracy", "f1_macro"] if classification else ["r2", "mae", "rmse"]
    stats = [x for c in names for x in (F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std"))]
    scores = F.transform(F.sort_array(F.collect_list(F.struct("fold", primary))), lambda s: s[primary])
    out = fold_metrics.groupBy(*by, "model").agg(
        *stats, scores.alias("fold_scores"), F.count(F.lit(1)).alias("n_splits")
    )
    ranked = Window.partitionBy(*by).orderBy(F.col(f"{primary}_mean").desc(), "model")
    return (
        out.withColumn("primary_mean", F.col(f"{primary}_mean")).withColumn("primary_std", F.col(f"{primary}_std"))
        .withColumn("cv_rank", F.row_number().over(ranked))
    )
