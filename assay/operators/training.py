"""Train, cross-validate, tune and evaluate the candidates of one dataset."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from assay import thresholds as th
from assay.functions import values as fv
from assay.operators import importance, metrics, normal, oversample, prepare, splits, strata
from assay.operators.fitting import FeaturePlan, Preparation, fit_preparation
from assay.operators.models import Budget, Spec, fit, fit_predict, sampled_params
from assay.operators.stages import LabelNames
from assay.session import materialise
from assay.settings import Limits

ROWS_PER_TASK = 20_000
LEAST_ROWS_PER_TASK = 2_000  # a table smaller than the cluster is spread over its cores down to so many
FITS_AT_ONCE = 4  # fits the driver keeps running side by side; each broadcasts its own model
BROADCAST_CLASSES = 100_000
ROW = "_row"


@dataclass
class Task:
    """What is learnt and how: shared by training, validation and tuning."""

    target: str
    classification: bool
    plan: FeaturePlan
    classes: list[str] = field(default_factory=list)
    class_weights: bool = False
    oversampling: bool = False
    logit_c: float = th.LOGIT_C
    budget: Budget = Budget()
    seed: int = 42
    limits: Limits = Limits()

    def y(self) -> Column:
        """Label as a number: the class index, or the value."""
        if not self.classification:
            return F.col(self.target).cast("double")
        index = F.create_map(*[x for i, c in enumerate(self.classes) for x in (F.lit(c), F.lit(float(i)))])
        return F.try_element_at(index, F.col(self.target).cast("string"))

    def label_of(self, y: Column) -> Column:
        if not self.classification:
            return y
        return F.element_at(F.array(*[F.lit(c) for c in self.classes]), y.cast("int") + 1)

    def encoder_targets(self) -> list[Column]:
        if self.classification and len(self.classes) > 2:
            return [(self.y() == i).cast("double") for i in range(len(self.classes))]
        return [self.y()]


@dataclass
class Trained:
    """Fitted candidates with their board; predictions hold (model, label, prediction)."""

    task: Task
    train: DataFrame
    test: DataFrame
    preparation: Preparation
    models: dict[str, Transformer]
    predictions: DataFrame
    board: DataFrame
    ranking: list[str]
    params: dict[str, dict] = field(default_factory=dict)


def with_row_key(df: DataFrame) -> DataFrame:
    """A deduplicated table's rows told apart by their own digest."""
    return df.withColumn(ROW, F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}), 256))


def class_labels(df: DataFrame, target: str) -> list[str]:
    """Sorted class labels: as many as the models have outputs."""
    rows = df.where(F.col(target).isNotNull()).select(F.col(target).cast("string").alias("c")).distinct().collect()
    return sorted(r["c"] for r in rows)


def _prepared(task: Task, train: DataFrame) -> tuple[Preparation, DataFrame, dict]:
    """Fit the preparation and return model-ready train rows (features, y, w) with label facts."""
    targets = task.encoder_targets()
    preparation = fit_preparation(train, task.plan, targets)
    ready = preparation.transform_train(train, ROW, targets, task.seed).select(ROW, "features", task.y().alias("y"))
    ready = materialise(ready)
    if task.classification and task.oversampling:
        ready = materialise(oversample.smote(ready, ROW, "y", "features", task.seed).drop("synthetic"))
    if task.classification and task.class_weights:
        weights = prepare.class_weights(ready, "y").select(F.col("class_label").alias("_c"), F.col("class_weight").alias("w"))
        # One row per class, whose labels the driver holds already.
        ready = ready.join(F.broadcast(weights) if len(task.classes) <= BROADCAST_CLASSES else weights, F.col("y") == F.col("_c")).drop("_c")
    else:
        ready = ready.withColumn("w", F.lit(1.0))
    top = F.lit(None).cast("double")
    if task.classification:
        top = prepare.modes(ready, ["y"]).first()["mode_value"]
    facts = ready.agg(F.count("y").alias("n"), F.avg("y").alias("mean"), F.stddev_pop("y").alias("std")).first().asDict()
    facts["mode"] = top if task.classification else 0.0
    if task.classification:
        # Without this the tree learners guess the class count, and only up to a hundred.
        nominal = {"ml_attr": {"type": "nominal", "name": "y", "num_vals": len(task.classes)}}
        ready = ready.withColumn("y", F.col("y").alias("y", metadata=nominal))
    # Iterative fits run one small job per step: a tiny table must not be spread over many tasks.
    n = int(facts["n"])
    cores = train.sparkSession.sparkContext.defaultParallelism
    return preparation, ready.repartition(max(1, -(-n // ROWS_PER_TASK), min(cores, -(-n // LEAST_ROWS_PER_TASK)))), facts


def side_by_side(spark: SparkSession, jobs: list[Callable[[], object]]) -> list:
    """Results of independent driver jobs in order, FITS_AT_ONCE at a time; the first error is raised.

    Small iterative fits leave most of the cores idle, so several share them. Each thread is bound to a scheduler
    pool of its own, which counts where the session schedules fairly and is ignored where it does not.
    """
    if len(jobs) < 2:
        return [job() for job in jobs]
    sc = spark.sparkContext

    def run(at: int) -> object:
        sc.setLocalProperty("spark.scheduler.pool", f"fit-{at % FITS_AT_ONCE}")
        return jobs[at]()

    with ThreadPoolExecutor(FITS_AT_ONCE) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(run), i) for i in range(len(jobs))]]


def fit_all(task: Task, specs: list[Spec], ready: DataFrame, facts: dict) -> list[Transformer]:
    """Every spec fitted on the same prepared rows, which are held while that lasts."""
    ready = ready.persist()
    try:
        return side_by_side(ready.sparkSession, [
            partial(fit, s, ready, task.budget, task.seed, len(task.classes), facts, task.logit_c) for s in specs])
    finally:
        ready.unpersist()


def _predict(task: Task, model: Transformer, ready: DataFrame, name: str) -> DataFrame:
    return _named(task, model.transform(ready), name)


def _named(task: Task, scored: DataFrame, name: str) -> DataFrame:
    label = task.label_of(F.col("y"))
    return scored.select(F.lit(name).alias("model"), label.alias("label"), task.label_of(F.col("prediction")).alias("prediction"))


def _score(task: Task, predictions: DataFrame, by: list[str]) -> DataFrame:
    return metrics.score_classes(predictions, by) if task.classification else metrics.score_numbers(predictions, by)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _board(task: Task, predictions: DataFrame, order: list[str]) -> tuple[DataFrame, list[str]]:
    """Leaderboard written once; a handful of rows, so the ranking may be read."""
    place = F.array_position(F.array(*[F.lit(n) for n in order]), F.col("model"))
    scored = _score(task, predictions, ["model"]).withColumn("dataset_id", F.lit("table"))
    board = materialise(metrics.leaderboard(scored, ["dataset_id"], task.classification, place))
    return board, [r["model"] for r in board.orderBy("rank").select("model").collect()]


def split(df: DataFrame, task: Task, test_share: float) -> tuple[DataFrame, DataFrame]:
    """Train and test rows with a target; by class where the target is one, by value where every number repeats."""
    given = df.where(F.col(task.target).isNotNull())
    if task.classification:
        marked = splits.stratified_split(given, ROW, task.target, test_share, task.seed)
    elif strata.repeats(given, task.target):
        marked = strata.value_split(given, ROW, task.target, test_share, task.seed)
    else:
        marked = splits.random_split(given, ROW, test_share, task.seed)
    marked = materialise(marked)
    return marked.where(~F.col("is_test")).drop("is_test"), marked.where("is_test").drop("is_test")


def train_models(train: DataFrame, test: DataFrame, task: Task, specs: list[Spec]) -> Trained:
    """Fit every candidate on the same prepared rows and rank them on the test rows."""
    preparation, ready, facts = _prepared(task, train)
    test_ready = materialise(preparation.transform(test).select(ROW, "features", task.y().alias("y")).where("y is not null"))
    fitted = dict(zip([s.name for s in specs], fit_all(task, specs, ready, facts)))
    predictions = materialise(_union([_predict(task, m, test_ready, n) for n, m in fitted.items()]))
    board, ranking = _board(task, predictions, [s.name for s in specs])
    return Trained(task, train, test, preparation, fitted, predictions, board, ranking, {s.name: s.params for s in specs})


def _fold_count(task: Task, train: DataFrame) -> int:
    rows = train.count()
    smallest = None
    if task.classification:
        smallest = train.groupBy(task.target).count().agg(F.min("count")).first()[0]
    wanted = th.FOLDS_SMALL if rows < task.limits.small_rows else th.FOLDS_DEFAULT
    k = min(wanted, rows if smallest is None else smallest)
    return k if rows >= 4 and k >= 2 else 0


def with_folds(task: Task, train: DataFrame, k: int, time_column: str | None = None) -> list[tuple[DataFrame, DataFrame]]:
    """(fit rows, check rows) per fold: by class, by digest, or expanding in time."""
    if time_column is not None:
        marked = materialise(splits.time_folds(train, time_column, k))
        block = F.col("time_block")
        return [(marked.where(block <= i).drop("time_block"), marked.where(block == i + 1).drop("time_block")) for i in range(k)]
    if task.classification:
        marked = splits.stratified_folds(train, ROW, task.target, k, task.seed)
    else:
        marked = splits.folds(train, ROW, k, task.seed)
    marked = materialise(marked)
    return [(marked.where(F.col("fold") != i).drop("fold"), marked.where(F.col("fold") == i).drop("fold")) for i in range(k)]


def _fold_scored(task: Task, specs: list[Spec], ready: DataFrame, check: DataFrame, facts: dict) -> list[DataFrame]:
    """The check rows with the predictions of every spec, written when it is fitted: no model outlives its turn."""
    def job(s: Spec) -> DataFrame:
        scored = fit_predict(s, ready, check, task.budget, task.seed, len(task.classes), facts, task.logit_c)
        return materialise(scored.select("y", "prediction"))

    ready = ready.persist()
    try:
        return side_by_side(ready.sparkSession, [partial(job, s) for s in specs])
    finally:
        ready.unpersist()


def fold_predictions(task: Task, train: DataFrame, specs: list[Spec], k: int, time_column: str | None = None) -> DataFrame:
    """(model, label, prediction, fold): the preparation is fitted again inside every fold."""
    parts = []
    for i, (fit_rows, check_rows) in enumerate(with_folds(task, train, k, time_column)):
        preparation, ready, facts = _prepared(task, fit_rows)
        check = materialise(preparation.transform(check_rows).select("features", task.y().alias("y")).where("y is not null"))
        for n, (s, scored) in enumerate(zip(specs, _fold_scored(task, specs, ready, check, facts))):
            name = s.name if len({x.name for x in specs}) == len(specs) else f"{s.name}#{n}"
            parts.append(_named(task, scored, name).withColumn("fold", F.lit(i)))
    return materialise(_union(parts))


LINEAR = ("Ridge", "LinearRegression")


def linear_fold_scores(task: Task, train: DataFrame, specs: list[Spec], k: int, time_column: str | None = None) -> DataFrame:
    """(trial, fold, r2) of linear specs: two passes a fold for all of them, the preparation fitted inside every fold."""
    rows = []
    for i, (fit_rows, check_rows) in enumerate(with_folds(task, train, k, time_column)):
        preparation, ready, _ = _prepared(task, fit_rows)
        check = preparation.transform(check_rows).select("features", task.y().alias("y"))
        both = ready.select("features", "y", F.lit(0).alias("part")).union(check.select("features", "y", F.lit(1)))
        parts = normal.grams(both, "features", "y", "part")
        for n, s in enumerate(specs):
            penalty = s.params.get("alpha", 1.0) if s.name == "Ridge" else 0.0
            if 1 in parts:
                rows.append((n, i, normal.solve(parts[0], penalty).score(parts[1])[0]))
    return train.sparkSession.createDataFrame(rows, "trial int, fold int, r2 double")


def cross_validate(trained: Trained, top_k: int, time_column: str | None = None) -> DataFrame | None:
    """Fold summary of the best candidates on the train rows; None without enough rows."""
    task = trained.task
    k = _fold_count(task, trained.train)
    if k == 0:
        return None
    specs = [Spec(n, trained.params.get(n, {})) for n in trained.ranking[:max(1, top_k)]]
    scores = _score(task, fold_predictions(task, trained.train, specs, k, time_column), ["model", "fold"])
    return materialise(metrics.cv_summary(scores.withColumn("dataset_id", F.lit("table")), ["dataset_id"], task.classification))


def random_search(trained: Trained, reduced: bool = False, samples: int | None = None, time_column: str | None = None) -> DataFrame:
    """(trial, params, score) of sampled grid points for the winner, scored by folds on train rows.

    All train rows are used unless the limits name a sample size for reduced tuning.
    """
    task, name = trained.task, trained.ranking[0]
    spark = trained.train.sparkSession
    n = samples or (th.TUNE_SAMPLES_REDUCED if reduced else th.TUNE_SAMPLES)
    trials = [Spec(name, p) for p in sampled_params(spark, name, n, task.seed)]
    train = trained.train
    if reduced and task.limits.tune_rows is not None:
        by = task.target if task.classification else "_one"
        train = splits.tuning_sample(train.withColumn("_one", F.lit(0)), ROW, by, task.limits.tune_rows, task.seed).drop("_one")
        train = materialise(train)
    if name in LINEAR:
        means = linear_fold_scores(task, train, trials, th.TUNE_FOLDS, time_column).groupBy("trial").agg(F.avg("r2").alias("score"))
    else:
        folds = fold_predictions(task, train, trials, th.TUNE_FOLDS, time_column)
        score = "balanced_accuracy" if task.classification else "r2"
        per_fold = _score(task, folds, ["model", "fold"])
        place = F.when(F.contains("model", F.lit("#")), F.substring_index("model", "#", -1)).otherwise("0").cast("int")
        means = per_fold.groupBy(place.alias("trial")).agg(F.avg(score).alias("score"))
    texts = spark.createDataFrame([(i, str(s.params)) for i, s in enumerate(trials)], "trial int, params string")
    return materialise(means.join(texts, "trial"))


def tune(trained: Trained, reduced: bool = False, samples: int | None = None, time_column: str | None = None) -> Trained:
    """The winner refitted with its best sampled parameters; unchanged without a grid or enough rows."""
    name = trained.ranking[0]
    spark = trained.train.sparkSession
    if not sampled_params(spark, name, 1, 0) or trained.train.count() < th.TUNE_FOLDS * 2:
        return trained
    tried = random_search(trained, reduced, samples, time_column)
    best = tried.orderBy(F.col("score").desc(), "trial").first()
    n = samples or (th.TUNE_SAMPLES_REDUCED if reduced else th.TUNE_SAMPLES)
    params = sampled_params(spark, name, n, trained.task.seed)[best["trial"]]
    redone = train_models(trained.train, trained.test, trained.task, [Spec(name, params)])
    others = trained.predictions.where(F.col("model") != name)
    predictions = others.unionByName(redone.predictions)
    board, _ = _board(trained.task, predictions, trained.ranking)
    models = {**trained.models, name: redone.models[name]}
    # The tuned winner stays the winner; its new score is only recorded.
    return Trained(trained.task, trained.train, trained.test, redone.preparation, models, predictions, board,
                   trained.ranking, {**trained.params, name: params})


def predictor(trained: Trained, name: str | None = None) -> PipelineModel:
    """The whole way from raw rows to predicted_label as one pipeline that can be saved: the winner's, or a named model's."""
    labels = LabelNames.of(trained.task.classes if trained.task.classification else [])
    return PipelineModel([*trained.preparation.stages(), trained.models[name or trained.ranking[0]], labels])


def feature_importance(trained: Trained, name: str, top: int = 5) -> DataFrame:
    """Top features of a model: native where it has them, else permutation on the whole test table."""
    spark = trained.train.sparkSession
    native = importance.native_importance(spark, trained.models[name], trained.preparation.names)
    if native is not None:
        return importance.top_features(native, top).withColumn("method", F.lit("native"))
    task = trained.task

    def predict(df: DataFrame) -> DataFrame:
        ready = trained.preparation.transform(df).withColumn("y", task.y())
        out = trained.models[name].transform(ready)
        return out.withColumns({"label": task.label_of(F.col("y")), "prediction": task.label_of(F.col("prediction"))})

    drops = importance.permutation_importance(
        trained.test, ROW, list(trained.preparation.plan.raw), predict, task.classification, task.seed
    )
    return importance.top_features(drops, top).withColumn("method", F.lit("permutation"))


def evaluate(trained: Trained, name: str, sensitive: list[str]) -> dict[str, DataFrame]:
    """Tables of the chosen model: metrics of all models, confusion, per-class report, fairness, drivers."""
    task = trained.task
    chosen = trained.predictions.where(F.col("model") == name)
    out = {"metrics": trained.board, "drivers": feature_importance(trained, name)}
    if not task.classification:
        out["pred_vs_actual"] = metrics.residuals(chosen)
        return out
    counts = metrics.confusion_counts(trained.predictions, ["model"])
    out["confusion"] = counts.where(F.col("model") == name)
    out["class_report"] = metrics.class_scores(metrics.class_report(counts, ["model"]))
    if sensitive:
        ready = trained.preparation.transform(trained.test).withColumn("y", task.y())
        scored = trained.models[name].transform(ready).withColumn("prediction", task.label_of(F.col("prediction")))
        parts = [
            metrics.demographic_parity(scored.select(F.lit(c).alias("attribute"), c, "prediction"), ["attribute"], c)
            for c in sensitive if c != task.target
        ]
        if parts:
            out["fairness"] = _union(parts)
    return out
