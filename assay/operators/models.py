"""Candidate models: which ones a dataset gets, and their Spark ML estimators."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml import Transformer
from pyspark.ml import classification as mc, regression as mr
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame, functions as F

from assay import thresholds as th
from assay.operators import forests
from assay.operators.counts import KEY
from assay.settings import Limits


@dataclass(frozen=True)
class Budget:
    """Model sizes; the defaults are the full settings, tests and small clusters pick less."""

    trees: int = th.TREES
    depth: int = 30
    rounds: int = 100
    iterations: int = 2000


@dataclass
class Spec:
    """One candidate: its name and its settings."""

    name: str
    params: dict = field(default_factory=dict)


# --- which candidates ---

def candidates(sig: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(dataset_id, pos, model) from signals joined with flags; a preferred model comes first.

    No model is left out for a table's size unless ``limits`` says so.

    Needs rows, cols, is_classification, simple_models_only, prefer_ensemble and preferred_model.
    """
    rows, simple = F.col("rows"), F.coalesce("simple_models_only", F.lit(False))
    ensemble = F.coalesce("prefer_ensemble", F.lit(False))
    under = lambda value, limit: F.lit(True) if limit is None else value < limit
    medium, cls = under(rows, limits.boosting_max_rows), F.col("is_classification")
    boosted = ~simple & (ensemble | medium)
    margin = under(rows, limits.margin_max_rows) & under(F.col("cols") - 1, limits.margin_max_cols)
    rules: list[tuple[str, Column]] = [
        ("DummyMostFrequent", cls), ("LogisticRegression", cls), ("RandomForest", cls), ("SVC_RBF", cls & margin),
        ("GradientBoosting", cls & boosted & medium), ("HistGradientBoosting", cls & boosted),
        ("DummyMean", ~cls), ("LinearRegression", ~cls), ("Ridge", ~cls), ("RandomForestRegressor", ~cls & ~simple),
        ("GradientBoostingRegressor", ~cls & ~simple & medium), ("HistGradientBoostingRegressor", ~cls & ~simple),
    ]
    names = F.array_compact(F.array(*[F.when(cond, F.lit(n)) for n, cond in rules]))
    first = F.filter(names, lambda n: n.eqNullSafe(F.col("preferred_model")))
    rest = F.filter(names, lambda n: ~n.eqNullSafe(F.col("preferred_model")))
    return sig.select(KEY, F.posexplode(F.concat(first, rest)).alias("pos", "model"))


# --- baselines and closed forms ---

def baseline_class(df: DataFrame, label: str) -> DataFrame:
    """Adds prediction: the most frequent class, smallest on ties."""
    sizes = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("c")).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.agg(F.min(F.struct((-F.col("n")).alias("less"), "c")).getField("c").alias("prediction"))
    return df.join(F.broadcast(top))  # one row


def baseline_number(df: DataFrame, label: str) -> DataFrame:
    """Adds prediction: the mean label."""
    return df.join(F.broadcast(df.agg(F.avg(label).alias("prediction"))))  # one row


def single_feature_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line through one feature."""
    return df.agg(
        F.regr_slope(F.col(y), F.col(x)).alias("slope"), F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
        F.count(F.lit(1)).alias("n_rows"),
    )


# --- estimators ---

def constant_model(value: float) -> Transformer:
    """A fitted baseline that can be saved like any other stage."""
    return SQLTransformer(statement=f"SELECT *, CAST({value!r} AS DOUBLE) AS prediction FROM __THIS__")


def _trees(cls, spec: Spec, budget: Budget, seed: int, **kw):
    p = spec.params
    depth = p.get("max_depth", budget.depth)
    return cls(
        featuresCol="features", labelCol="y", seed=seed, numTrees=p.get("n_estimators", budget.trees),
        maxDepth=min(depth or budget.depth, 30), minInstancesPerNode=p.get("min_samples_leaf", 1),
        cacheNodeIds=True, **kw,  # else every round of a fit ships the growing trees to the tasks
    )


def _boosted(cls, spec: Spec, budget: Budget, seed: int, histogram: bool, **kw):
    p = spec.params
    depth = p.get("max_depth", 5 if histogram else 3)
    return cls(
        featuresCol="features", labelCol="y", seed=seed, stepSize=p.get("learning_rate", 0.1),
        maxIter=p.get("n_estimators", p.get("max_iter", budget.rounds)), maxDepth=min(depth or 10, 30),
        maxBins=255 if histogram else 32, minInstancesPerNode=p.get("min_samples_leaf", 20 if histogram else 1),
        subsamplingRate=p.get("subsample", 1.0), **kw,
    )


FORESTS = ("RandomForest", "RandomForestRegressor")


def fit(
    spec: Spec, train: DataFrame, budget: Budget, seed: int, n_classes: int, facts: dict, logit_c: float = th.LOGIT_C
) -> Transformer:
    """Fit one candidate on (features, y, w). ``facts`` brings n, mode, mean and std of y."""
    if spec.name == "DummyMostFrequent":
        return constant_model(float(facts["mode"]))
    if spec.name == "DummyMean":
        return constant_model(float(facts["mean"]))
    est = estimator(spec, budget, seed, n_classes, facts, logit_c)
    return forests.fit(est, train, int(facts["n"])) if spec.name in FORESTS else est.fit(train)


def fit_predict(
    spec: Spec, train: DataFrame, check: DataFrame, budget: Budget, seed: int, n_classes: int, facts: dict, logit_c: float = th.LOGIT_C
) -> DataFrame:
    """``check`` with the predictions of a candidate that nothing else needs; a large forest is not kept."""
    if spec.name in FORESTS:
        return forests.fit_predict(estimator(spec, budget, seed, n_classes, facts, logit_c), train, int(facts["n"]), check)
    return fit(spec, train, budget, seed, n_classes, facts, logit_c).transform(check)


def estimator(spec: Spec, budget: Budget, seed: int, n_classes: int, facts: dict, logit_c: float = th.LOGIT_C):
    """The Spark ML estimator of a candidate that is no baseline."""
    n, name, weight = max(int(facts["n"]), 1), spec.name, {"weightCol": "w"}
    if name == "LogisticRegression":
        c = spec.params.get("C", logit_c)
        est = mc.LogisticRegression(
            featuresCol="features", labelCol="y", regParam=1.0 / (c * n), elasticNetParam=0.0, standardization=False,
            maxIter=budget.iterations, **weight,
        )
    elif name == "RandomForest":
        est = _trees(mc.RandomForestClassifier, spec, budget, seed, **weight)
    elif name == "SVC_RBF":
        svc = mc.LinearSVC(featuresCol="features", labelCol="y", regParam=1.0 / n, maxIter=min(100, budget.iterations), **weight)
        est = svc if n_classes <= 2 else mc.OneVsRest(classifier=svc, featuresCol="features", labelCol="y", **weight)
    elif name in ("GradientBoosting", "HistGradientBoosting"):
        gbt = _boosted(mc.GBTClassifier, spec, budget, seed, name.startswith("Hist"))
        est = gbt if n_classes <= 2 else mc.OneVsRest(classifier=gbt, featuresCol="features", labelCol="y")
    elif name == "LinearRegression":
        est = mr.LinearRegression(featuresCol="features", labelCol="y", regParam=0.0)
    elif name == "Ridge":
        # Spark scales the label: the penalty must carry its deviation to mean alpha on the raw scale.
        alpha = spec.params.get("alpha", 1.0)
        est = mr.LinearRegression(
            featuresCol="features", labelCol="y", solver="normal", standardization=False,
            elasticNetParam=0.0, regParam=alpha / n * float(facts["std"] or 1.0),
        )
    elif name == "RandomForestRegressor":
        est = _trees(mr.RandomForestRegressor, spec, budget, seed)
    elif name in ("GradientBoostingRegressor", "HistGradientBoostingRegressor"):
        est = _boosted(mr.GBTRegressor, spec, budget, seed, name.startswith("Hist"))
    else:
        raise ValueError(f"unknown candidate {name}")
    return est


def fit_warnings(model: Transformer) -> list[str]:
    """What a fitted model says about its own fit: coefficients or objective that are no numbers, unfinished iterations."""
    out = []
    for part in getattr(model, "stages", None) or getattr(model, "models", None) or [model]:
        try:
            values = part.coefficientMatrix.toArray() if hasattr(part, "coefficientMatrix") else part.coefficients.toArray()
            if not all(math.isfinite(x) for x in values.ravel().tolist()):
                out.append("invalid value in coefficients")
        except AttributeError:
            continue
        if getattr(part, "hasSummary", False):
            # Some models bring their summary as a property, others as a method.
            summary = part.summary() if callable(part.summary) else part.summary
            history = list(summary.objectiveHistory or [])
            if any(not math.isfinite(x) for x in history):
                out.append("overflow in objective")
            elif part.hasParam("maxIter") and len(history) > part.getOrDefault("maxIter"):
                out.append("iteration limit reached before convergence")
    return out


# --- fixed values: tuning grids per candidate ---
_FOREST = {
    "n_estimators": [100, 200, 300, 500], "max_depth": [None, 5, 10, 20],
    "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2, 4],
}
_BOOSTING = {"n_estimators": [100, 200, 300], "learning_rate": [0.05, 0.1, 0.2], "max_depth": [3, 4, 5], "subsample": [0.8, 1.0]}
_HISTOGRAM = {"max_iter": [100, 200, 300], "learning_rate": [0.05, 0.1, 0.2], "max_depth": [None, 5, 10], "min_samples_leaf": [20, 50, 100]}
GRIDS: dict[str, dict[str, list]] = {
    "RandomForest": _FOREST, "RandomForestRegressor": _FOREST,
    "GradientBoosting": _BOOSTING, "GradientBoostingRegressor": _BOOSTING,
    "HistGradientBoosting": _HISTOGRAM, "HistGradientBoostingRegressor": _HISTOGRAM,
    "LogisticRegression": {"C": [0.01, 0.1, 1.0, 10.0, 100.0], "penalty": ["l2"]},
    "Ridge": {"alpha": [0.01, 0.1, 1.0, 10.0, 100.0]},
}


IGNORED_PARAMS = ("min_samples_split",)  # no counterpart in Spark's trees


def param_grid(models: DataFrame) -> DataFrame:
    """Every grid point of every (.., model) row: adds grid_no and params as 'name=value' text.

    The cross product of one model's values is a fixed, small array; models without a grid drop out.
    """
    per_model = []
    for model, grid in GRIDS.items():
        points = F.array(F.lit(""))
        for name, values in grid.items():
            texts = F.array(*[F.lit(f"{name}={v};") for v in values])
            points = F.flatten(_extend(points, texts))
        per_model += [F.lit(model), points]
    table = F.create_map(*per_model)
    return models.select("*", F.posexplode(F.try_element_at(table, F.col("model"))).alias("grid_no", "params"))


def _extend(points: Column, texts: Column) -> Column:
    return F.transform(points, lambda p: F.transform(texts, lambda t: F.concat(p, t)))


def parse_params(text: str) -> dict:
    out: dict = {}
    for item in filter(None, text.split(";")):
        name, value = item.split("=")
        out[name] = None if value == "None" else value if value == "l2" else float(value) if "." in value else int(value)
    return out


def sampled_params(spark, model: str, n: int, seed: int) -> list[dict]:
    """The first n grid points in digest order that differ in what Spark is told, or all of them if there are fewer."""
    grid = param_grid(spark.createDataFrame([(model,)], "model string"))
    rows = grid.orderBy(F.md5(F.concat_ws("|", "params", F.lit(seed)))).collect()  # a fixed grid of a few hundred points
    points = [parse_params(r["params"]) for r in rows]
    told = {tuple((k, v) for k, v in p.items() if k not in IGNORED_PARAMS): p for p in reversed(points)}
    return [p for p in points if p in list(told.values())][:n]
