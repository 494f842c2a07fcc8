import pytest
from pyspark.sql import functions as F

from assay.operators import diagnose, history, metrics, models
from assay.plans import replan as rp, rules
from assay.settings import PUBLISHED

SIG = (
    "dataset_id string, rows bigint, cols bigint, max_missing double, near_constant_cols array<string>, sensitive_cols array<string>,"
    " has_datetime boolean, high_card boolean, scale_mismatch boolean, outlier_cols array<string>, hard_cols array<string>,"
    " soft_cols array<string>, corr_cols array<string>, imbalance_ratio double, is_classification boolean, features bigint, high_dim boolean"
)


def sig(spark, **kw):
    row = dict(dataset_id="d", rows=5000, cols=30, max_missing=0.0, near_constant_cols=[], sensitive_cols=[], has_datetime=False,
               high_card=False, scale_mismatch=False, outlier_cols=[], hard_cols=[], soft_cols=[], corr_cols=[], imbalance_ratio=1.0,
               is_classification=True)
    row.update(kw)
    row["features"] = max(row["cols"] - 1, 1)
    row["high_dim"] = row["features"] >= 100 or row["features"] / max(row["rows"], 1) >= 0.25
    return spark.createDataFrame([tuple(row[c.split()[0]] for c in SIG.split(", "))], SIG)


def plan(spark, hint=None, **kw):
    hints = None if hint is None else spark.createDataFrame([("d", *hint)], "dataset_id string, hint_model string, hint_steps array<string>")
    return [r["step"] for r in rules.plan_rows(rules.recommend(sig(spark, **kw), hints, PUBLISHED)).orderBy("pos").collect()]


def test_medium_plan_has_core_steps_and_tuning(spark):
    assert plan(spark) == ["profile_dataset", "build_preprocessor", "select_models", "train_models", "tune_hyperparameters",
                           "evaluate", "validate_with_cross_validation", "reflect", "write_report"]


@pytest.mark.parametrize("kw, step, there", [
    ({"imbalance_ratio": 5.0}, "apply_oversampling", True), ({"imbalance_ratio": 4.99}, "apply_oversampling", False),
    ({"imbalance_ratio": 3.0}, "consider_imbalance_strategy", True), ({"imbalance_ratio": 2.99}, "consider_imbalance_strategy", False),
    ({"imbalance_ratio": 5.0}, "consider_imbalance_strategy", False), ({"rows": 999}, "use_simple_models_only", True),
    ({"rows": 1000}, "use_simple_models_only", False), ({"rows": 10000}, "use_ensemble_models", True),
    ({"rows": 9999}, "use_ensemble_models", False), ({"rows": 20000, "cols": 101}, "use_ensemble_models", False),
    ({"cols": 101}, "apply_regularization", True), ({"cols": 100}, "apply_regularization", False),
    ({"has_datetime": True}, "use_time_aware_validation", True), ({"high_card": True}, "apply_target_encoding", True),
    ({"outlier_cols": ["a"]}, "handle_outliers", True), ({"max_missing": 20.1}, "handle_severe_missing_data", True),
    ({"max_missing": 20.0}, "handle_severe_missing_data", False), ({"rows": 20000}, "reduce_tuning_budget", True),
    ({"rows": 16666}, "reduce_tuning_budget", False), ({"rows": 66667}, "validate_with_cross_validation", False),
    ({"rows": 66666}, "validate_with_cross_validation", True), ({"cols": 251}, "validate_with_cross_validation", False),
    ({"scale_mismatch": True}, "apply_robust_scaling", True), ({"hard_cols": ["a"]}, "drop_leaky_features", True),
    ({"near_constant_cols": ["a"]}, "drop_near_constant_features", True), ({"corr_cols": ["a"]}, "drop_correlated_features", True),
    ({"corr_cols": ["a"], "cols": 3}, "drop_correlated_features", False), ({"sensitive_cols": ["age"]}, "drop_sensitive_features", True),
    ({"cols": 16}, "apply_feature_engineering", True), ({"cols": 17}, "apply_feature_engineering", False),
])
def test_rule_at_its_threshold(spark, kw, step, there):
    assert (step in plan(spark, **kw)) is there


def test_hint_replays_allowed_steps_once(spark):
    steps = plan(spark, ("RandomForest", ["handle_outliers", "reflect", "use_ensemble_models", "apply_regularization"]), outlier_cols=["a"])
    assert steps.count("handle_outliers") == 1 and steps.count("reflect") == 1
    assert steps.index("use_ensemble_models") == steps.index("select_models") - 1
    assert steps.index("apply_regularization") == steps.index("train_models") - 1
    assert steps[-1] == "prioritize_model:RandomForest"


def test_replan_edits_and_diff(spark):
    df = spark.createDataFrame(
        [("d", ["build_preprocessor", "train_models", "evaluate"], ["Macro F1 low", "imbalance", "far from the cross-validation mean"])],
        "dataset_id string, steps array<string>, issues array<string>")
    row = rp.replan(df).first()
    assert row["new_steps"] == ["build_preprocessor", "consider_imbalance_strategy", "apply_regularization", "train_models", "evaluate",
                                "use_ensemble_models", "replan_attempt"]
    assert row["widen_test"]
    diff = {(r["change"], r["step"]) for r in rp.plan_diff(rp.replan(df)).collect()}
    assert diff == {("added", s) for s in ("consider_imbalance_strategy", "apply_regularization", "use_ensemble_models")}


@pytest.mark.parametrize("share, wide", [(0.2, 0.3), (0.3, 0.35), (0.4, 0.4)])
def test_widened_share(spark, share, wide):
    assert spark.range(1).select(rp.widened_test_share(F.lit(share))).first()[0] == pytest.approx(wide)


def test_candidates_by_size_and_flags(spark):
    def names(**kw):
        flags = {k: kw.pop(k, None) for k in ("simple_models_only", "prefer_ensemble", "preferred_model")}
        df = sig(spark, **kw).withColumns({k: F.lit(v).cast("string" if k == "preferred_model" else "boolean") for k, v in flags.items()})
        return [r["model"] for r in models.candidates(df, PUBLISHED).orderBy("pos").collect()]
    assert names(rows=500, simple_models_only=True) == ["DummyMostFrequent", "LogisticRegression", "RandomForest", "SVC_RBF"]
    assert names() == ["DummyMostFrequent", "LogisticRegression", "RandomForest", "GradientBoosting", "HistGradientBoosting"]
    assert names(rows=20000) == ["DummyMostFrequent", "LogisticRegression", "RandomForest"]
    assert names(rows=20000, prefer_ensemble=True)[-1] == "HistGradientBoosting"
    assert names(is_classification=False, preferred_model="Ridge")[:2] == ["Ridge", "DummyMean"]


@pytest.mark.parametrize("a, b, significant", [
    ([.90, .91, .89, .92, .90], [.50, .52, .48, .53, .49], True), ([.81, .79, .82, .78, .80], [.80, .80, .79, .81, .80], False),
    ([.5, .6], [.5, .6], False),
])
def test_paired_t(spark, a, b, significant):
    df = spark.createDataFrame([("d", "m1", 1, a), ("d", "m2", 2, b)], "dataset_id string, model string, cv_rank int, fold_scores array<double>")
    row = diagnose.paired_t(df).first()
    assert row["significant"] is significant
    if a == b:
        assert row["p_value"] == 1.0


def test_macro_scores_over_the_label_union(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "c")], "label string, prediction string").withColumn("model", F.lit("m"))
    row = metrics.score_classes(df, ["model"]).first()
    assert row["accuracy"] == pytest.approx(1 / 3) and row["balanced_accuracy"] == pytest.approx(0.25)
    assert row["f1_macro"] == pytest.approx((2 / 3) / 3) and row["recall_macro"] == pytest.approx(0.5 / 3)


def test_history_weight_and_upsert(spark):
    weights = [r[0] for r in spark.createDataFrame([(0,), (90,), (200,), (None,)], "d int").select(history.decay(F.col("d"))).collect()]
    assert weights == [1.0, 0.5, 0.5, 1.0]
    log = spark.createDataFrame(
        [("fp1", "y", 10, 3, "2024-01-01"), ("fp2", "y", 10, 3, "2024-02-01"), ("fp3", "z", 10, 3, "2024-01-01"), ("fp3", "z", 11, 3, "2024-03-01")],
        "fingerprint string, target string, rows bigint, cols bigint, seen_at string")
    assert {(r["fingerprint"], r["rows"]) for r in history.latest(log).collect()} == {("fp2", 10), ("fp3", 11)}


def test_every_issue_has_a_text(spark):
    for cls in (True, False):
        issues = {r for r, severity, *_ in diagnose._rules(cls) if severity == "issue"}
        assert issues <= set(diagnose.ISSUE_TEXT)


def test_param_grid_sizes(spark):
    df = spark.createDataFrame([(m,) for m in models.GRIDS] + [("SVC_RBF",)], "model string")
    sizes = {r["model"]: r["count"] for r in models.param_grid(df).groupBy("model").count().collect()}
    assert sizes == {"RandomForest": 144, "RandomForestRegressor": 144, "GradientBoosting": 54, "GradientBoostingRegressor": 54,
                     "HistGradientBoosting": 81, "HistGradientBoostingRegressor": 81, "LogisticRegression": 5, "Ridge": 5}
    assert models.parse_params("max_depth=None;subsample=0.8;max_iter=100;penalty=l2;") == {
        "max_depth": None, "subsample": 0.8, "max_iter": 100, "penalty": "l2"}


def test_no_step_or_model_is_lost_to_size_by_default(spark):
    big = sig(spark, rows=50_000_000)
    steps = [r["step"] for r in rules.plan_rows(rules.recommend(big)).collect()]
    assert {"validate_with_cross_validation", "tune_hyperparameters"} <= set(steps) and "reduce_tuning_budget" not in steps
    flags = big.withColumns({"simple_models_only": F.lit(False), "prefer_ensemble": F.lit(False), "preferred_model": F.lit(None).cast("string")})
    assert len(models.candidates(flags).collect()) == 6
    published = [r["step"] for r in rules.plan_rows(rules.recommend(big, None, PUBLISHED)).collect()]
    assert "validate_with_cross_validation" not in published and "reduce_tuning_budget" in published


def test_parity_covers_every_group(spark):
    rows = [(f"g{i}", int(j < i)) for i in range(7) for j in range(10)]
    df = spark.createDataFrame(rows, "g string, prediction int").withColumn("a", F.lit("g"))
    got = metrics.demographic_parity(df, ["a"], "g").collect()
    assert len(got) == 7 and {r["parity_ratio"] for r in got} == {0.0}
    assert len(metrics.demographic_parity(df, ["a"], "g", top=5).collect()) == 5
