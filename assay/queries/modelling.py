"""Model queries: candidates and grids are checked exactly, fitted models by rows only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from assay.operators import importance, models, oversample, report, training
from assay.operators.counts import KEY, value_counts, TableInfo
from assay.operators.fitting import FeaturePlan
from assay.operators.models import Spec
from assay.operators import diagnose
from assay.plans import rules
from assay.queries.base import query, table
from assay.queries.findings import _reflected, study_board, study_evidence
from assay.queries.study import NUMERIC, PLAN_CTES, SIGNAL_CTES, TARGET, study_plan, study_signals, study_stats
from assay.run import auto_model as run_auto_model
from assay.session import materialise
from assay.settings import PUBLISHED

CANDIDATE_CTES = PLAN_CTES + """,
  st2 as (select dataset_id, list(step) as steps from plan group by all),
  cd as (select sig.dataset_id, n_row, list_contains(steps, 'use_simple_models_only') as simple, list_contains(steps, 'use_ensemble_models') as ens,
           list_contains(steps, 'prioritize_model:RandomForest') as pref, n_col from sig join st2 using (dataset_id)),
  offer as (select dataset_id, pref, 0 as o, 'DummyMostFrequent' as model from cd union all select dataset_id, pref, 1, 'LogisticRegression' from cd
    union all select dataset_id, pref, 2, 'RandomForest' from cd union all select dataset_id, pref, 3, 'SVC_RBF' from cd where n_row < 1000 and n_col <= 50
    union all select dataset_id, pref, 4, 'GradientBoosting' from cd where not simple and n_row < 10000
    union all select dataset_id, pref, 5, 'HistGradientBoosting' from cd where not simple and (ens or n_row < 10000)),
  cand as (select dataset_id, model, cast(row_number() over (partition by dataset_id order by case when pref and model = 'RandomForest' then -1 else o end) - 1 as int) as pos from offer)"""


def study_candidates(spark, folder) -> DataFrame:
    planned = study_plan(spark, folder)
    flags = rules.flags(planned).select(KEY, "simple_models_only", "prefer_ensemble")
    return models.candidates(planned.join(flags, KEY).withColumn("preferred_model", F.col("hint_model")), PUBLISHED)


@query("model_candidates", f"with {CANDIDATE_CTES} select dataset_id, pos, model from cand")
def model_candidates(spark, folder):
    return study_candidates(spark, folder)


def _grid_sql() -> str:
    parts = []
    for model, grid in models.GRIDS.items():
        names = list(grid)
        frm = ", ".join(f"(select unnest([{', '.join(repr(str(v)) for v in grid[n])}]) as v, generate_subscripts([{', '.join(repr(str(v)) for v in grid[n])}], 1) as i) t{k}" for k, n in enumerate(names))
        text = " || ".join(f"'{n}=' || t{k}.v || ';'" for k, n in enumerate(names))
        order = ", ".join(f"t{k}.i" for k in range(len(names)))
        parts.append(f"select '{model}' as model, cast(row_number() over (order by {order}) - 1 as int) as grid_no, {text} as params from {frm}")
    return " union all ".join(f"({p})" for p in parts)


@query("param_grid", f"with {CANDIDATE_CTES}, grids as ({_grid_sql()}) select dataset_id, model, grid_no, params from cand join grids using (model)")
def param_grid(spark, folder):
    return models.param_grid(study_candidates(spark, folder)).select(KEY, "model", "grid_no", "params")


# --- quality findings and report ---

@query("quality_findings", f"""with {SIGNAL_CTES},
    gaps as (select dataset_id, column_name, cast(row_number() over (partition by dataset_id order by missing_pct desc, pos) as int) as r from st where missing_pct > 0),
    f as (select dataset_id, 0 as pos, 'duplicates' as finding, cast(duplicate_count as varchar) as item from sig where duplicate_count > 0
      union all select dataset_id, r, 'missing', column_name from gaps where r <= 3
      union all select dataset_id, 4, 'near_constant', array_to_string(near_cols[1:5], ',') from sig where len(near_cols) > 0
      union all select dataset_id, 5, 'outliers', array_to_string(outlier_cols[1:5], ',') from sig where len(outlier_cols) > 0
      union all select dataset_id, 6, 'correlation', null from sig where max_abs_corr >= 0.8
      union all select dataset_id, 7, 'scale_mismatch', null from sig where scale_mismatch
      union all select dataset_id, 8, 'hard_leakage', array_to_string(hard_cols[1:5], ',') from sig where len(hard_cols) > 0
      union all select dataset_id, 8, 'soft_leakage', array_to_string(soft_cols[1:5], ',') from sig where len(soft_cols) > 0 and len(hard_cols) = 0)
    select * from f""")
def quality_findings(spark, folder):
    out = report.quality_findings(study_signals(spark, folder), study_stats(spark, folder), TARGET)
    # Numbers rendered as text differ between engines; those items are left to the tests.
    return out.withColumn("item", F.when(~F.col("finding").isin("correlation", "scale_mismatch"), F.col("item")))


@query("run_report", f"""with {PLAN_CTES}, {_reflected(True)[len(SIGNAL_CTES) + 1:]}
    select dataset_id, 'profile' as section, item, cast(value as varchar) as value from
      (select dataset_id, unnest(['rows', 'cols', 'duplicate_count', 'n_classes', 'features']) as item,
         unnest([cast(n_row as bigint), n_col, duplicate_count, n_classes, features]) as value from sig)
    union all select dataset_id, 'plan', lpad(cast(pos as varchar), 2, '0'), case
      {' '.join(f"when step = '{s}' then '{t}'" for s, t in report.STEP_TEXT.items())} else 'try first: ' || replace(step, 'prioritize_model:', '') end from plan
    union all select dataset_id, 'metrics', model, printf('%.4f', round(balanced_accuracy, 4)) from board
    union all select dataset_id, 'cross_validation', model, printf('%.4f', round(cv_mean, 4)) from cvr
    union all select dataset_id, 'verdict', best_model, verdict from ver
    union all select dataset_id, 'findings', rule, severity from found""")
def run_report(spark, folder):
    ev = study_evidence(spark, folder)
    board, summary, _ = study_board(spark, folder)
    judged = diagnose.verdicts(diagnose.reflection(ev))
    plan = rules.plan_rows(study_plan(spark, folder))
    return report.run_report(study_signals(spark, folder), plan, board, summary, judged, diagnose.findings(ev))


# --- fitted models, rows only ---

def quality_table(spark, folder) -> DataFrame:
    """Labelled documents with plain features; the target is the quality label."""
    docs = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")
    words = F.split("text", r"\s+")
    return docs.select(
        "n_chars", "lang", "source", F.size(words).alias("words"), F.size(F.array_distinct(words)).alias("distinct_words"),
        (F.length(F.regexp_replace("text", r"[^0-9]", "")) / F.col("n_chars")).alias("digit_share"), "quality",
    )


def _quality_task(spark, folder, **kw) -> tuple[training.Task, DataFrame, DataFrame]:
    df = training.with_row_key(quality_table(spark, folder).dropDuplicates())
    plan = FeaturePlan(("n_chars", "words", "distinct_words", "digit_share"), (), ("lang", "source"), (), 400)
    task = training.Task("quality", True, plan, training.class_labels(df, "quality"), True, **kw)
    return (task, *training.split(df, task, 0.2))


CLASSIFIERS = ["DummyMostFrequent", "LogisticRegression", "RandomForest", "SVC_RBF", "GradientBoosting", "HistGradientBoosting"]
REGRESSORS = ["DummyMean", "LinearRegression", "Ridge", "RandomForestRegressor", "GradientBoostingRegressor", "HistGradientBoostingRegressor"]


@query("fit_classifiers")
def fit_classifiers(spark, folder):
    """Leaderboard of all six classifiers on labelled documents."""
    task, train, test = _quality_task(spark, folder)
    return training.train_models(train, test, task, [Spec(n) for n in CLASSIFIERS]).board


def _price_task(spark, folder):
    part = table(spark, folder, "part").select("p_brand", "p_type", "p_size", (F.col("p_partkey") % 997).alias("group_no"), "p_retailprice")
    df = training.with_row_key(part.dropDuplicates())
    plan = FeaturePlan(("p_size", "group_no"), (), ("p_type",), ("p_brand",), 2000)
    task = training.Task("p_retailprice", False, plan)
    return (task, *training.split(df, task, 0.2))


@query("fit_regressors")
def fit_regressors(spark, folder):
    """Leaderboard of all six regressors on part prices."""
    task, train, test = _price_task(spark, folder)
    return training.train_models(train, test, task, [Spec(n) for n in REGRESSORS]).board


@query("cross_validate")
def cross_validate(spark, folder):
    """Fold summary of the best two regressors."""
    task, train, test = _price_task(spark, folder)
    trained = training.train_models(train, test, task, [Spec(n) for n in REGRESSORS])
    return training.cross_validate(trained, 2)


@query("random_search")
def random_search(spark, folder):
    """Sampled grid points of Ridge or the forest, whichever wins, with their fold scores."""
    task, train, test = _price_task(spark, folder)
    trained = training.train_models(train, test, task, [Spec("Ridge"), Spec("RandomForestRegressor")])
    return training.random_search(trained)


@query("tuned_model")
def tuned_model(spark, folder):
    """Leaderboard after the winner was replaced by its tuned version."""
    task, train, test = _price_task(spark, folder)
    trained = training.train_models(train, test, task, [Spec("DummyMean"), Spec("Ridge"), Spec("RandomForestRegressor")])
    return training.tune(trained).board


@query("native_importance")
def native_importance(spark, folder):
    """Forest importances per prepared feature."""
    task, train, test = _quality_task(spark, folder)
    trained = training.train_models(train, test, task, [Spec("RandomForest")])
    return importance.native_importance(spark, trained.models["RandomForest"], trained.preparation.names)


@query("permutation_importance")
def permutation_importance(spark, folder):
    """Score lost per shuffled raw column, whole test table, five shuffles."""
    task, train, test = _price_task(spark, folder)
    trained = training.train_models(train, test, task, [Spec("Ridge")])

    def predict(df):
        ready = trained.preparation.transform(df).withColumn("y", task.y())
        return trained.models["Ridge"].transform(ready).withColumn("label", F.col("y"))

    return importance.permutation_importance(test, training.ROW, list(task.plan.raw), predict, False)


@query("top_features")
def top_features(spark, folder):
    """Five strongest features of the fitted winner."""
    task, train, test = _quality_task(spark, folder)
    trained = training.train_models(train, test, task, [Spec("LogisticRegression")])
    return training.feature_importance(trained, "LogisticRegression")


@query("evaluate_best")
def evaluate_best(spark, folder):
    """Per-class report of every candidate beside the winner's name."""
    task, train, test = _quality_task(spark, folder)
    trained = training.train_models(train, test, task, [Spec(n) for n in CLASSIFIERS])
    out = training.evaluate(trained, trained.ranking[0], ["lang"])
    return out["class_report"].withColumn("winner", F.lit(trained.ranking[0]))


@query("smote")
def smote(spark, folder):
    """Class sizes after oversampling embedding vectors by label."""
    from pyspark.ml.functions import array_to_vector
    rows = table(spark, folder, "embeddings").select(
        "vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    return oversample.smote(rows, "vec_id", "label", "features").groupBy("label", "synthetic").agg(F.count(F.lit(1)).alias("n_rows"))


@query("auto_model")
def auto_model(spark, folder):
    """Whole run on labelled documents: every report row."""
    result = run_auto_model(quality_table(spark, folder), "auto", "documents")
    return result.tables.get("report", result.tables["notes"])
