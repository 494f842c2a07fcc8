"""Diagnostic findings and verdicts: rules over one row of evidence per dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from assay import thresholds as th
from assay.functions import values as fv
from assay.functions.tails import paired_t_p_value
from assay.operators.counts import KEY

IS_BASELINE = "Dummy"


def paired_t(summary: DataFrame) -> DataFrame:
    """Paired t-test between the fold scores of the two best models of every dataset."""
    two = summary.where(F.col("cv_rank") <= 2).groupBy(KEY).agg(
        F.max(F.when(F.col("cv_rank") == 1, F.col("model"))).alias("model_a"),
        F.max(F.when(F.col("cv_rank") == 2, F.col("model"))).alias("model_b"),
        F.max(F.when(F.col("cv_rank") == 1, F.col("fold_scores"))).alias("a"),
        F.max(F.when(F.col("cv_rank") == 2, F.col("fold_scores"))).alias("b"),
    )
    usable = two.where("model_b is not null").where((F.size("a") >= 2) & (F.size("a") == F.size("b")))
    diffs = usable.withColumn("d", F.zip_with("a", "b", lambda x, y: x - y)).withColumn("k", F.size("d"))
    add = lambda acc, x: acc + x
    mean = F.aggregate("d", F.lit(0.0), add) / F.col("k")
    squares = F.aggregate(F.transform("d", lambda x: (x - F.col("mean")) * (x - F.col("mean"))), F.lit(0.0), add)
    deviation = F.sqrt(squares / (F.col("k") - 1))
    same = F.forall("d", lambda x: x == 0)
    t = F.when(same, F.lit(0.0)).otherwise(
        F.col("mean") / F.when(F.col("deviation") > 0, F.col("deviation") / F.sqrt(F.col("k").cast("double")))
    )
    # Equal non-zero differences in every fold: no spread at all, so the gap is certain.
    p = F.when(same, F.lit(1.0)).when(F.col("deviation") == 0, F.lit(0.0)).otherwise(
        paired_t_p_value(F.col("t"), F.col("k") - 1)
    )
    return (
        diffs.withColumn("mean", mean).withColumn("deviation", deviation).withColumn("t", t).withColumn("p_value", p)
        .select(KEY, "model_a", "model_b", F.col("t").alias("t_statistic"), "p_value",
                (F.col("p_value") <= th.ALPHA).alias("significant"))
    )


def evidence(
    sig: DataFrame, metrics: DataFrame, summary: DataFrame, flags: DataFrame | None = None,
    warnings: DataFrame | None = None, reports: DataFrame | None = None, history: DataFrame | None = None,
    classification: bool = True,
) -> DataFrame:
    """One row per dataset with all the diagnostics look at.

    ``metrics`` is a leaderboard; ``summary`` a fold summary; ``reports`` per-class scores of the
    winners; ``warnings`` (dataset_id, warnings); ``history`` (dataset_id, prev_score, prev_status).
    """
    base = F.contains("model", F.lit(IS_BASELINE))
    score = "balanced_accuracy" if classification else "r2"
    perfect = F.col(score) >= th.NEAR_PERFECT
    if classification:
        perfect = perfect & (F.col("f1_macro") >= th.NEAR_PERFECT)
    best = F.col("rank") == 1
    pick = lambda cond, c: F.max(F.when(cond, F.col(c)))
    boards = [
        pick(best, "model").alias("best_model"), pick(best, score).alias("score"), pick(base, score).alias("base_score"),
        F.count_if(~base & perfect).alias("n_perfect"), F.count(F.lit(1)).alias("n_models"),
    ]
    if classification:
        boards += [pick(best, "f1_macro").alias("f1"), (F.max("f1_macro") - F.min("f1_macro")).alias("f1_range")]
    out = sig.join(metrics.groupBy(KEY).agg(*boards), KEY)
    cv = summary.select(
        KEY, F.col("model").alias("best_model"), F.col("primary_mean").alias("cv_mean"), F.col("primary_std").alias("cv_std")
    )
    winners = summary.where("cv_rank = 1").select(KEY, F.col("model").alias("cv_best"))
    out = out.join(cv, [KEY, "best_model"], "left").join(winners, KEY, "left")
    test = paired_t(summary).select(KEY, "model_a", "model_b", "p_value", "significant")
    out = out.join(test, KEY, "left")
    if flags is not None:
        out = out.join(flags, KEY, "left")
    else:
        out = out.withColumn("drop_leaky", F.lit(False)).withColumn("is_replan", F.lit(False))
    if warnings is not None:
        out = out.join(warnings, KEY, "left")
    else:
        out = out.withColumn("warnings", F.array().cast("array<string>"))
    if reports is not None:
        weak = reports.where(F.col("f1") < th.WEAK_CLASS_F1).groupBy(KEY).agg(
            F.min(F.struct("f1", "class_label")).alias("w")
        )
        out = out.join(weak.select(KEY, F.col("w.class_label").alias("weak_class"), F.col("w.f1").alias("weak_f1")), KEY, "left")
    else:
        out = out.withColumn("weak_class", F.lit(None).cast("string")).withColumn("weak_f1", F.lit(None).cast("double"))
    if history is not None:
        out = out.join(history, KEY, "left")
    else:
        out = out.withColumn("prev_score", F.lit(None).cast("double"))
    return out


def _floor() -> Column:
    ratio = F.coalesce("imbalance_ratio", F.lit(1.0))
    return (
        F.when(ratio >= th.VERY_IMBALANCED, F.lit(th.F1_FLOOR_SEVERE))
        .when(ratio >= th.IMBALANCED, F.lit(th.F1_FLOOR_IMBALANCED)).otherwise(F.lit(th.F1_FLOOR))
    )


def _rules(classification: bool) -> list[tuple[str, str, bool, Column, Column]]:
    """(rule, severity, review, condition, value) in report order."""
    hard, soft = F.size("hard_cols") > 0, F.size("soft_cols") > 0
    open_leaks = ~F.coalesce("drop_leaky", F.lit(False))
    replanned = F.coalesce("is_replan", F.lit(False))
    score = F.col("score")
    margin = score - F.col("base_score")
    no_gain = F.col("base_score").isNotNull() & (margin < th.BASELINE_MARGIN)
    unstable = F.exists(F.coalesce("warnings", F.array().cast("array<string>")), lambda w: fv.any_word(w, th.UNSTABLE_WORDS))
    gap = F.abs(score - F.col("cv_mean"))
    gap_max, std_max = (th.CV_GAP_CLS, th.CV_STD_CLS) if classification else (th.CV_GAP_REG, th.CV_STD_REG)
    low_r2 = score < th.R2_LOW
    none = F.lit(None).cast("double")
    cv_rules = [
        ("cv_gap", "issue", True, gap > gap_max, gap),
        ("cv_unstable", "issue", True, F.col("cv_std") > std_max, F.col("cv_std")),
        ("cv_other_winner", "suggestion", False, F.col("cv_mean").isNotNull() & (F.col("cv_best") != F.col("best_model")), none),
    ]
    last = [
        ("tied_models", "suggestion", False, ~F.col("significant"), F.col("p_value")),
        ("history_gain", "suggestion", False, score - F.col("prev_score") > th.HISTORY_DELTA, score - F.col("prev_score")),
        ("history_drop", "issue", False, score - F.col("prev_score") < -th.HISTORY_DELTA, score - F.col("prev_score")),
    ]
    first = [
        ("hard_leakage", "issue", True, hard & open_leaks, none),
        ("hard_leakage_dropped", "suggestion", False, hard & ~open_leaks, none),
        ("soft_leakage", "issue", True, soft & open_leaks, none),
        ("sensitive_columns", "suggestion", False, F.size("sensitive_cols") > 0, none),
        ("no_gain_after_replan", "issue", False, no_gain & replanned, margin),
        ("weak_margin", "issue", False, no_gain & ~replanned, margin),
    ]
    if not classification:
        return first + [
            ("low_r2", "issue", False, low_r2, score),
            ("instability", "suggestion", False, unstable, none),
            ("instability_low_r2", "issue", True, unstable & low_r2, none),
            ("near_perfect", "issue", True, F.col("n_perfect") >= 2, none),
            ("outliers_low_r2", "issue", False, (F.size("outlier_cols") > 0) & low_r2, score),
        ] + cv_rules + last
    f1, ratio = F.col("f1"), F.coalesce("imbalance_ratio", F.lit(1.0))
    severe = ratio >= th.VERY_IMBALANCED
    severe_margin = score - F.coalesce("base_score", F.lit(0.0))
    return first + [
        ("overfitting", "issue", False, (score > th.OVERFIT_ACCURACY) & (f1 < th.OVERFIT_F1), f1),
        ("f1_below_floor", "issue", False, f1 < _floor(), f1),
        ("severe_imbalance_weak", "issue", False, severe & (severe_margin < th.BASELINE_MARGIN_SEVERE), severe_margin),
        ("severe_imbalance", "suggestion", False, severe, ratio),
        ("imbalance", "suggestion", False, ~severe & (ratio >= th.IMBALANCED), ratio),
        ("near_perfect", "issue", True, F.col("n_perfect") >= 2, none),
        ("weak_class", "issue", False, F.col("weak_f1").isNotNull(), F.col("weak_f1")),
    ] + cv_rules + [
        ("low_diversity", "issue", False, (F.col("n_models") > 1) & (F.col("f1_range") < th.DIVERSITY_GAP), F.col("f1_range")),
        ("instability", "suggestion", False, unstable, none),
        ("instability_weak_f1", "issue", True, unstable & (f1 < th.F1_FLOOR), f1),
    ] + last


# --- fixed values: wording of the issues; the plan edits look for these key words ---
ISSUE_TEXT = {
    "hard_leakage": "hard target leakage evidence",
    "soft_leakage": "soft target-proxy risk",
    "no_gain_after_replan": "replan attempted, still no better than baseline",
    "weak_margin": "best model hardly better than baseline",
    "low_r2": "R² is very low",
    "instability_low_r2": "numerical instability beside low R², scaling may be the cause",
    "near_perfect": "near-perfect scores of several models are suspicious",
    "outliers_low_r2": "outliers present and R² is low",
    "overfitting": "high balanced accuracy with low F1 suggests overfitting",
    "f1_below_floor": "macro F1 is below its floor",
    "severe_imbalance_weak": "severe class imbalance and weak gain over baseline",
    "weak_class": "a class has very low F1",
    "cv_gap": "held-out score differs from the cross-validation mean",
    "cv_unstable": "scores vary across folds",
    "low_diversity": "all models score alike",
    "instability_weak_f1": "numerical instability beside weak F1, scaling may be the cause",
    "history_drop": "score dropped against the earlier run",
}


def issue_texts(found: DataFrame) -> DataFrame:
    """(dataset_id, issues): wording of the issues in report order."""
    table = F.create_map(*[F.lit(x) for kv in ISSUE_TEXT.items() for x in kv])
    rows = found.where(F.col("severity") == "issue")
    texts = F.transform(F.sort_array(F.collect_list(F.struct("pos", "rule"))), lambda r: F.element_at(table, r["rule"]))
    return rows.groupBy(KEY).agg(texts.alias("issues"))


def findings(ev: DataFrame, classification: bool = True) -> DataFrame:
    """(dataset_id, pos, rule, severity, review, value): every rule that fires, in report order."""
    fired = [
        F.when(cond, F.struct(F.lit(i).alias("pos"), F.lit(rule).alias("rule"), F.lit(severity).alias("severity"),
                              F.lit(review).alias("review"), value.cast("double").alias("value")))
        for i, (rule, severity, review, cond, value) in enumerate(_rules(classification))
    ]
    return ev.select(KEY, F.inline(F.array_compact(F.array(*fired))))


def reflection(ev: DataFrame, classification: bool = True) -> DataFrame:
    """Status, review flag and replan flag per dataset."""
    def fires(names: tuple[str, ...]) -> Column:
        out = F.lit(False)
        for rule, _, _, cond, _ in _rules(classification):
            if rule in names:
                out = out | F.coalesce(cond, F.lit(False))
        return out

    rules = _rules(classification)
    issues = fires(tuple(r for r, s, _, _, _ in rules if s == "issue"))
    before_history = fires(tuple(r for r, s, _, _, _ in rules if s == "issue" and r != "history_drop"))
    review = fires(tuple(r for r, _, rev, _, _ in rules if rev))
    cv = fires(("cv_gap", "cv_unstable"))
    weak = F.coalesce(F.col("f1") < _floor() if classification else F.col("score") < th.R2_LOW, F.lit(False))
    garbage = fires(("no_gain_after_replan",))
    # The history comparison comes after the replan decision.
    replan = before_history & (weak | cv) & ~garbage
    return ev.select(
        "*", F.when(issues, "needs_attention").otherwise("ok").alias("status"), review.alias("review_required"),
        replan.alias("replan_recommended"), cv.alias("cv_concern"),
    )


def verdicts(reflected: DataFrame) -> DataFrame:
    """First matching verdict: hard leak, soft leak, fold alert, open findings, else reliable."""
    open_leaks = ~F.coalesce("drop_leaky", F.lit(False))
    follow_up = (
        F.col("review_required") | (F.col("status") == "needs_attention") | F.col("replan_recommended")
        | F.contains("best_model", F.lit(IS_BASELINE))
    )
    label = (
        F.when((F.size("hard_cols") > 0) & open_leaks, th.INVALID)
        .when((F.size("soft_cols") > 0) & open_leaks, th.CAUTION)
        .when(F.col("cv_concern"), th.CAUTION)
        .when(follow_up, th.CAUTION)
        .otherwise(th.RELIABLE)
    )
    reason = (
        F.when((F.size("hard_cols") > 0) & open_leaks, "hard_leakage")
        .when((F.size("soft_cols") > 0) & open_leaks, "soft_leakage")
        .when(F.col("cv_concern"), "cv_alert").when(F.col("review_required"), "review")
        .when(follow_up, "follow_up").otherwise("none")
    )
    return reflected.withColumn("verdict", label).withColumn("verdict_reason", reason)


def suggestion_rank(rows: DataFrame, text: str, order: str = "pos") -> DataFrame:
    """Critical texts first, then medium ones, original order inside each: adds priority and rank."""
    level = F.when(fv.any_word(F.col(text), th.CRITICAL_WORDS), 0).when(
        fv.any_word(F.col(text), th.MEDIUM_WORDS), 1).otherwise(2)
    ranked = Window.partitionBy(KEY).orderBy("priority", order)
    return rows.withColumn("priority", level).withColumn("rank", F.row_number().over(ranked))


def warning_triage(rows: DataFrame, text: str) -> DataFrame:
    """Environment notices apart from warnings about the model."""
    return rows.withColumn("triage", F.when(fv.any_word(F.col(text), th.NOTICE_WORDS), "notice").otherwise("actionable"))


def tuning_skip(board: DataFrame, warnings: DataFrame, classification: bool = True) -> DataFrame:
    """Reason to skip tuning per dataset, null to go ahead; first reason wins."""
    score = "balanced_accuracy" if classification else "r2"
    base = F.contains("model", F.lit(IS_BASELINE))
    rows = board.groupBy(KEY).agg(
        F.max(F.when(F.col("rank") == 1, F.col("model"))).alias("best_model"),
        F.max(F.when(F.col("rank") == 1, F.col(score))).alias("score"), F.max(F.when(base, F.col(score))).alias("base_score"),
    ).join(warnings, KEY, "left")
    unstable = F.exists(F.coalesce("warnings", F.array().cast("array<string>")), lambda w: fv.any_word(w, th.TUNING_UNSTABLE_WORDS))
    margin = F.col("score") - F.col("base_score")
    reason = F.when(F.contains("best_model", F.lit(IS_BASELINE)), "baseline_wins").when(unstable, "unstable").when(
        F.col("base_score").isNull(), F.lit(None).cast("string")
    ).when(F.col("score") >= th.NEAR_PERFECT, "near_perfect")
    if not classification:
        reason = reason.when(F.col("score") < th.R2_LOW, "low_r2")
    reason = reason.when(margin < th.BASELINE_MARGIN, "weak_margin")
    return rows.select(KEY, "best_model", "score", "base_score", reason.alias("skip_reason"))


def model_rank(name: Column) -> Column:
    """Complexity rank of a model name, from a fixed table."""
    table = F.create_map(*[x for k, v in th.MODEL_RANK.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.get(F.array(F.try_element_at(table, name)), F.lit(0)), F.lit(th.MODEL_RANK_OTHER))


def tie_break(ev: DataFrame) -> DataFrame:
    """The simpler of two statistically tied models takes the winner's place."""
    a, b = F.col("model_a"), F.col("model_b")
    first = (model_rank(a) < model_rank(b)) | ((model_rank(a) == model_rank(b)) & (a <= b))
    preferred = F.when(~F.col("significant"), F.when(first, a).otherwise(b))
    return ev.select(
        KEY, "best_model", preferred.alias("tied_choice"), F.coalesce(preferred, F.col("best_model")).alias("final_model")
    )


def target_unsuitable(judged: DataFrame, classification: bool = True) -> DataFrame:
    """Would an inferred target be given up: invalid, baseline wins, or too little gain."""
    gain = F.col("score") - F.coalesce("base_score", F.lit(0.0))
    bad = (
        (F.col("verdict") == th.INVALID) | F.contains("best_model", F.lit(IS_BASELINE)) | (gain < th.BASELINE_MARGIN)
    )
    if not classification:
        bad = bad | (F.col("score") < th.R2_LOW)
    return judged.select(KEY, "best_model", "verdict", bad.alias("unsuitable"))
