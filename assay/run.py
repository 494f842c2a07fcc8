"""One call from table to verdict, composed of the operators.

Every heavy step is a Spark job over the whole table. Loops are bounded: at most three inferred
targets, at most ``max_replans`` + 1 passes each.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, functions as F

from assay import thresholds as th
from assay.functions import values as fv
from assay.operators import diagnose, history, models, prepare, quality, report, schema, target as tg, training
from assay.operators.counts import KEY, TableInfo, value_counts, with_dataset
from assay.operators.fitting import feature_plan
from assay.operators.models import Budget, Spec
from assay.operators.signals import profile_notes, signals
from assay.plans import replan as rp, rules
from assay.sources import runlog
from assay.sources.artefacts import append_history, read_history
from assay.session import materialise
from assay.settings import Limits

NAME = "table"
NO_SUMMARY = (
    "dataset_id string, model string, primary_mean double, primary_std double, cv_rank int, n_splits bigint, fold_scores array<double>"
)


@dataclass
class RunResult:
    """Outcome of a run: small facts plus result tables ready for the sinks."""

    target: str
    verdict: str
    best_model: str
    passes: int
    tables: dict[str, DataFrame] = field(default_factory=dict)
    record: DataFrame | None = None
    failed_targets: list[str] = field(default_factory=list)
    target_failed: bool = False
    trained: training.Trained | None = None


def auto_model(
    df: DataFrame, target: str = "auto", dataset: str = "table", seed: int = 42, test_share: float = 0.2,
    max_replans: int = 1, budget: Budget = Budget(), store: DataFrame | None = None,
    failed: list[str] | None = None, as_of: str = "2000-01-01 00:00:00", tune_samples: int | None = None,
    limits: Limits = Limits(), history_folder: str | None = None,
) -> RunResult:
    """Profile, plan, train, tune, validate, diagnose and judge one table.

    ``store`` is the run history (latest records), ``failed`` the targets given up before. No step is skipped
    and no row or column left out because of the table's size unless ``limits`` says so. With a
    ``history_folder`` the run's record is appended there, and the log there is the store if none is given;
    files of that log with broken lines are moved to its quarantine folder first.
    """
    if history_folder is not None and store is None:
        runlog.quarantine(df.sparkSession, history_folder)
        store = history.latest(read_history(df.sparkSession, history_folder)[0])
    before = df.count()
    df = materialise(quality.drop_duplicates(df))
    keyed = with_dataset(df, name=NAME)
    info = TableInfo.of(keyed)
    rows = df.count()
    wanted, origin = [target], "manual"
    stats0 = None
    if target.strip().lower() == "auto":
        known = _remembered_target(store, dataset, failed or [])
        if known:
            wanted, origin = [known], "manual"
        else:
            stats0 = materialise(schema.profile_columns(keyed))
            gone = df.sparkSession.createDataFrame([(NAME, c) for c in failed or []], "dataset_id string, column_name string")
            best = tg.target_candidates(tg.target_scores(stats0, info), gone).orderBy("rank").collect()  # three rows
            wanted, origin = [r["column_name"] for r in best], "inferred"
    if not wanted:
        raise ValueError("no column looks like a target; name one")
    lost: list[str] = []
    result = None
    for name in wanted:
        result = _one_target(
            df, keyed, name, dataset, origin, rows, before, seed, test_share, max_replans, budget, store, as_of, tune_samples, limits)
        if history_folder is not None and result.record is not None:
            append_history(result.record, history_folder)
        if origin != "inferred" or not _given_up(result):
            break
        lost.append(name)
    assert result is not None
    if result.target_failed and result.target not in lost:
        lost.append(result.target)
    result.failed_targets = lost
    return result


def _remembered_target(store: DataFrame | None, dataset: str, failed: list[str]) -> str | None:
    if store is None:
        return None
    same = store.where((F.col("dataset") == dataset) & (F.col("verdict") == th.RELIABLE) & (F.col("target_origin") == "manual"))
    row = same.orderBy(F.col("seen_at").desc()).select("target").first()
    return row["target"] if row and row["target"] not in failed else None


def _given_up(result: RunResult) -> bool:
    judged = result.tables.get("judged")
    if judged is None:
        return True
    cls = judged.first()["is_classification"]
    return bool(diagnose.target_unsuitable(judged, cls).first()["unsuitable"])


def _hints(sig: DataFrame, store: DataFrame | None, dataset: str, target: str, fingerprint: DataFrame, as_of: str) -> DataFrame | None:
    """Hint of an exact earlier run, else of a similar reliable one with the same task."""
    if store is None:
        return None
    want = sig.join(fingerprint, KEY).select(
        KEY, "rows", "cols", "fingerprint", F.lit(dataset).alias("dataset"), F.lit(target).alias("target"))
    exact = history.lookup(want, store, reliable_only=True).select(KEY, "hint_model", "hint_steps")
    alike = history.similar_runs(sig, store, as_of).where("same_task").select(
        KEY, F.col("hint_model").alias("m2"))
    return exact.join(alike, KEY, "full").select(
        KEY, F.coalesce("hint_model", "m2").alias("hint_model"), "hint_steps")


def _one_target(
    df, keyed, target, dataset, origin, rows, before, seed, test_share, max_replans, budget, store, as_of, tune_samples, limits
) -> RunResult:
    info = TableInfo.of(keyed)
    joint = materialise(value_counts(keyed, target=target))
    stats = materialise(schema.column_stats(joint, info))
    kind = schema.task_type(stats.where(F.col("column_name") == target)).first()
    cls = bool(kind["is_classification"])
    sig = signals(keyed, target, cls, joint=joint, stats=stats, limits=limits).withColumns({
        "duplicate_count": F.lit(before - rows), "duplicate_pct": F.lit((before - rows) / max(before, 1) * 100)})
    sig = materialise(sig)
    fingerprint = tg.fingerprints(stats, target, dataset)
    hints = _hints(sig, store, dataset, target, fingerprint, as_of)
    planned = rules.recommend(sig, hints, limits)
    past = _past_score(store, dataset, target)
    steps = planned.select(F.transform("plan", lambda p: p["step"]).alias("s")).first()["s"]  # a few dozen names
    groups = schema.feature_groups(stats, target).join(stats.select(KEY, "pos", "n_rows", "missing_pct"), [KEY, "pos"])
    routes = prepare.encoding_route(groups, limits)
    facts = sig.first()
    keyed_rows = training.with_row_key(df)
    passes = 0
    while True:
        passes += 1
        on = {flag: step in steps for step, flag in rules.STEP_FLAGS.items()}
        gone = rules.dropped_columns(sig)
        applies = F.lit(False)
        for reason, flag in (("correlated", "drop_high_corr"), ("leaky", "drop_leaky"), ("sensitive", "drop_sensitive")):
            applies = applies | ((F.col("drop_reason") == reason) & F.lit(on[flag]))
        gone = gone.where((F.col("drop_reason") == "near_constant") | applies)
        kept = materialise(prepare.keep_list(routes, gone))
        if prepare.cascade(kept).first()["feature_cascade"]:
            judged = sig.select(
                "*", F.lit(th.INVALID).alias("verdict"), F.lit("needs_attention").alias("status"), F.lit("Dummy").alias("best_model"),
                F.lit(None).cast("double").alias("score"))
            record = _record(judged, fingerprint, dataset, target, origin, steps, as_of)
            return RunResult(target, th.INVALID, "Dummy", passes, {"notes": profile_notes(sig)}, record, target_failed=True)
        preferred = next((s.split(":", 1)[1] for s in steps if s.startswith("prioritize_model:")), None)
        offered = models.candidates(sig.withColumns({
            "simple_models_only": F.lit(on["simple_models_only"]), "prefer_ensemble": F.lit(on["prefer_ensemble"]),
            "preferred_model": F.lit(preferred).cast("string")}), limits).orderBy("pos").collect()  # at most six rows
        weigh = on["use_class_weights"] or (cls and (facts["imbalance_ratio"] or 1.0) >= th.IMBALANCED)
        task = training.Task(
            target, cls, replace(feature_plan(kept, on, rows), unit_variance_min_rows=limits.unit_variance_min_rows), training.class_labels(df, target) if cls else [], weigh and cls,
            on["apply_oversampling"] and cls, th.LOGIT_C_STRONG if on["use_regularization"] else th.LOGIT_C, budget, seed, limits)
        train, test = training.split(keyed_rows, task, test_share)
        trained = training.train_models(train, test, task, [Spec(r["model"]) for r in offered])
        time_column = _time_column(stats, target) if on["time_aware_validation"] else None
        notes = []
        if "tune_hyperparameters" in steps:
            skip = diagnose.tuning_skip(trained.board, _warnings(sig, trained), cls).first()["skip_reason"]
            if skip is None:
                trained = training.tune(trained, on["reduce_tuning_budget"], tune_samples, time_column)
            else:
                notes.append(f"tuning skipped: {skip}")
        summary = None
        if "validate_with_cross_validation" in steps:
            top = th.CV_TOP_SMALL if rows < limits.small_rows else th.CV_TOP
            summary = training.cross_validate(trained, top, time_column)
        fold_table = summary if summary is not None else df.sparkSession.createDataFrame([], NO_SUMMARY)
        best = trained.ranking[0]
        warned = _warnings(sig, trained)
        ev = _evidence(trained, best, sig, fold_table, on, steps, cls, past, warned)
        tied = diagnose.tie_break(ev).first()["final_model"]
        if tied != best and tied in trained.models:
            best = tied
            notes.append(f"simpler tied model chosen: {tied}")
            # The simpler model takes the winner's place in the folds too.
            ev = _evidence(trained, best, sig, fold_table, on, steps, cls, past, warned).withColumn("cv_best", F.lit(best))
        judged = materialise(diagnose.verdicts(diagnose.reflection(ev, cls)))
        found = materialise(diagnose.findings(ev, cls))
        outcome = judged.first()
        plan_rows = sig.select(KEY, F.posexplode(F.array(*[F.lit(s) for s in steps])).alias("pos", "step"))
        tables = training.evaluate(trained, best, list(facts["sensitive_cols"]))
        tables.update({
            "profile": stats, "plan": plan_rows, "findings": found, "judged": judged,
            "notes": profile_notes(sig), "cross_validation": fold_table,
            "report": report.run_report(sig, plan_rows, trained.board, summary, judged, found, cls),
        })
        record = _record(judged, fingerprint, dataset, target, origin, steps, as_of)
        kept_record = history.records(judged.withColumns({
            "target": F.lit(target), "steps": F.array(*[F.lit(s) for s in steps])}))
        tables["outcome_record"] = kept_record
        result = RunResult(
            target, outcome["verdict"], best, passes, tables, record, [], bool(kept_record.first()["target_failed"]), trained)
        if not outcome["replan_recommended"] or passes > max_replans:
            return result
        issues = diagnose.issue_texts(found)
        edited = rp.replan(sig.select(KEY, F.array(*[F.lit(s) for s in steps]).alias("steps")).join(issues, KEY)).first()
        steps = edited["new_steps"]
        if edited["widen_test"]:
            test_share = max(test_share, min(test_share + th.TEST_SHARE_STEP, th.TEST_SHARE_MAX))


def _record(judged: DataFrame, fingerprint: DataFrame, dataset: str, target: str, origin: str, steps: list[str], as_of: str) -> DataFrame:
    """What the history keeps of a run."""
    return judged.join(fingerprint.select(KEY, "fingerprint"), KEY).select(
        F.lit(dataset).alias("dataset"), "fingerprint", F.lit(target).alias("target"), "rows", "cols", "verdict",
        "best_model", "score", "status", F.lit(origin).alias("target_origin"), "is_classification", "imbalance_ratio",
        "max_missing", F.array(*[F.lit(s) for s in steps]).alias("steps"), F.lit(as_of).cast("timestamp").alias("seen_at"))


def _past_score(store: DataFrame | None, dataset: str, target: str) -> DataFrame | None:
    """Score of the latest earlier run of the same table and target, as history evidence."""
    if store is None:
        return None
    same = store.where((F.col("dataset") == dataset) & (F.col("target") == target) & F.col("score").isNotNull())
    return same.groupBy(F.lit(NAME).alias(KEY)).agg(F.max_by("score", F.struct("seen_at", "fingerprint")).alias("prev_score"))


def _warnings(sig: DataFrame, trained) -> DataFrame:
    """What the fits reported about themselves: (dataset_id, warnings)."""
    told = [f"{name}: {w}" for name, model in trained.models.items() for w in models.fit_warnings(model)]
    return sig.select(KEY, F.array(*[F.lit(w) for w in told]).cast("array<string>").alias("warnings"))


def _evidence(
    trained, best: str, sig: DataFrame, fold_table: DataFrame, on: dict, steps: list[str], cls: bool, past: DataFrame | None,
    warned: DataFrame,
) -> DataFrame:
    """Evidence row with the chosen model in the winner's place."""
    board = trained.board.drop("rank").withColumn(
        "rank", F.when(F.col("model") == best, 1).otherwise(2))
    flags = sig.select(KEY, F.lit(on["drop_leaky"]).alias("drop_leaky"), F.lit("replan_attempt" in steps).alias("is_replan"))
    reports = None
    if cls:
        from assay.operators import metrics
        chosen = trained.predictions.where(F.col("model") == best)
        reports = metrics.class_report(metrics.confusion_counts(chosen, ["model"]), ["model"]).withColumn(KEY, F.lit(NAME))
    return diagnose.evidence(sig, board, fold_table, flags, warned, reports, past, cls)


def _time_column(stats: DataFrame, target: str) -> str | None:
    row = stats.where((F.col("kind") == "datetime") & (F.col("column_name") != target)).orderBy("pos").select("column_name").first()
    return row["column_name"] if row else None
