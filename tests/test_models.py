import ast
import os
import subprocess
import sys
import threading
import time
from functools import partial

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from assay.operators import fitting, importance, models, oversample, prepare, ranks, splits, training
from assay.operators.fitting import FeaturePlan
from assay.operators.models import Budget, Spec
from assay.run import auto_model
from assay.sources import artefacts

TINY = Budget(trees=5, depth=4, rounds=5, iterations=50)


def planted(spark, n=300):
    return spark.range(n).selectExpr(
        "cast(id as double) + 0.25D as num1", "rand(3) as num2", "chr(65 + id % 3) as cat", "concat('h', id % 60) as hi",
        f"if(id < {n} / 2 and id % 3 <> 1, 'no', 'yes') as target")


@pytest.fixture(scope="module")
def trained(spark):
    df = training.with_row_key(planted(spark))
    plan = FeaturePlan(("num1", "num2"), (), ("cat",), ("hi",), 300, polynomial=True)
    task = training.Task("target", True, plan, training.class_labels(df, "target"), True, budget=TINY)
    train, test = training.split(df, task, 0.2)
    return training.train_models(train, test, task, [Spec(n) for n in ("DummyMostFrequent", "LogisticRegression", "RandomForest")])


def test_models_beat_the_baseline_on_planted_signal(trained):
    scores = {r["model"]: r["balanced_accuracy"] for r in trained.board.collect()}
    assert scores["RandomForest"] > 0.9 > 0.5 >= scores["DummyMostFrequent"]


def test_split_is_disjoint_and_stratified(trained):
    train, test = trained.train, trained.test
    assert train.join(test, training.ROW, "left_semi").count() == 0
    sizes = {r["target"]: r["count"] for r in test.groupBy("target").count().collect()}
    assert sizes == {"no": 20, "yes": 40}


def test_fold_summary_shape(trained):
    rows = training.cross_validate(trained, 2).collect()
    assert len(rows) == 2 and all(len(r["fold_scores"]) == 5 for r in rows)


def test_drivers_and_pipeline_sink(spark, trained, tmp_path):
    top = training.feature_importance(trained, "RandomForest").collect()
    assert len(top) == 5 and top[0]["rank"] == 1
    path = artefacts.save_pipeline(trained.preparation.pipeline, str(tmp_path), "r1")
    assert len(artefacts.load_pipeline(path).stages) == 2


@pytest.mark.parametrize("name", ["RandomForest", "LogisticRegression", "DummyMostFrequent", None])
def test_saved_run_predicts_like_the_fitted_one(spark, trained, tmp_path, name):
    """Target-encoded plan; unseen and missing categories; columns the training rows did not have."""
    new = planted(spark, 40).drop("target").withColumns({
        "hi": F.when(F.col("num1") < 20, F.col("hi")).when(F.col("num1") < 30, F.lit("never seen")), "extra": F.lit(1)})
    model = training.predictor(trained, name)
    path = artefacts.save_pipeline(model, str(tmp_path), "r1")
    path = artefacts.save_pipeline(model, str(tmp_path), "r1")  # a repeated write replaces the run's
    want = {r["num1"]: r["predicted_label"] for r in model.transform(new).collect()}
    again = PipelineModel.load(path)
    rows = again.transform(new).collect()
    assert {r["num1"]: r["predicted_label"] for r in rows} == want and len(rows) == 40
    assert set(want.values()) <= {"no", "yes"} and rows[0]["extra"] == 1
    assert [type(s).__name__ for s in again.stages][:2] == ["CategoryMeans", "SQLTransformer"]


def test_saved_regression_predicts_in_another_process(spark, tmp_path):
    rows = spark.range(300).selectExpr("cast(id % 17 as double) as x", "concat('c', id % 60) as hi", "id % 17 * 2.0D + id % 60 as y")
    task = training.Task("y", False, FeaturePlan(("x",), (), (), ("hi",), 300), budget=TINY)
    train, test = training.split(training.with_row_key(rows.dropDuplicates()), task, 0.2)
    fitted = training.train_models(train, test, task, [Spec("Ridge")])
    rows.limit(20).coalesce(1).write.parquet(f"{tmp_path}/rows")
    path = artefacts.save_pipeline(training.predictor(fitted), str(tmp_path), "r1")
    want = [r["predicted_label"] for r in training.predictor(fitted).transform(spark.read.parquet(f"{tmp_path}/rows")).orderBy("x", "hi").collect()]
    code = f"""
from pyspark.sql import SparkSession
from assay.sources.artefacts import load_pipeline
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
out = load_pipeline({path!r}).transform(spark.read.parquet("{tmp_path}/rows")).orderBy("x", "hi")
print("got", [r["predicted_label"] for r in out.collect()])"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=root, timeout=200)
    line = [x for x in out.stdout.splitlines() if x.startswith("got ")]
    assert line and ast.literal_eval(line[0][4:]) == pytest.approx(want), out.stderr[-2000:]


def test_a_missing_category_takes_the_most_frequent_one(spark):
    df = training.with_row_key(spark.createDataFrame([("a", 1.0)] * 3 + [("b", 0.0)] * 2 + [(None, 0.5)], "c string, y double").withColumn("n", F.monotonically_increasing_id()))
    for robust, category in ((False, "a"), (True, "__missing__")):
        fitted = fitting.fit_preparation(df, FeaturePlan(target_encoded=("c",), robust_imputation=robust), [F.col("y")])
        got = {r["c"]: r["_te_c_0"] for r in fitted.transform(df).collect()}
        table = {r["category"]: r["means"][0] for r in fitted.encoder.table.collect()}
        assert got[None] == table[category] and set(table) == ({"a", "b"} if not robust else {"a", "b", "__missing__"})


def test_unseen_category_takes_the_global_mean(spark, trained):
    new = planted(spark, 1).withColumns({"hi": F.lit("new"), "cat": F.lit("Z")})
    x = trained.preparation.transform(new).select(vector_to_array("features").alias("x")).first()["x"]
    at = trained.preparation.names.index("hi target mean")
    assert x[at] == pytest.approx(trained.preparation.globals["hi"][0]) and len(x) == len(trained.preparation.names)


def test_permuted_columns_keep_their_values(spark):
    df = spark.range(5000).selectExpr("id", "id * 2 as v")
    out = importance.permuted(df, "id", ["v"], 1, 0)
    assert out.count() == 5000 and out.select("v").distinct().count() == 5000
    assert out.where("v = id * 2").count() < 50


def test_ranks_of_a_hot_group_are_dense(spark):
    df = spark.range(20000).selectExpr("id", "if(id % 3 = 0, null, 'hot') as g")
    out = ranks.shuffled_rank(df, ["g"], F.md5(F.col("id").cast("string")))
    for row in out.groupBy("g").agg(F.min("rank").alias("a"), F.max("rank").alias("b"), F.count_distinct("rank").alias("n"), F.count("*").alias("c")).collect():
        assert (row["a"], row["b"], row["n"]) == (0, row["c"] - 1, row["c"])


def test_one_row_class_falls_back_to_a_plain_split(spark):
    df = spark.range(1000).selectExpr("id", "if(id = 0, 'rare', 'x') as y")
    n = splits.stratified_split(df, "id", "y", 0.2).where("is_test").count()
    assert 150 < n < 250


def points(spark, n, rare):
    rng = np.random.default_rng(1)
    rows = [(i, 1 if i < rare else 0, [float(x) for x in rng.normal(size=3)]) for i in range(n)]
    return spark.createDataFrame(rows, "id bigint, y int, x array<double>").select("id", "y", array_to_vector("x").alias("features"))


@pytest.mark.parametrize("leaf_rows", [1000, 20])
def test_smote_fills_classes_exactly(spark, leaf_rows):
    out = oversample.smote(points(spark, 300, 60), "id", "y", "features", leaf_rows=leaf_rows)
    assert {r["y"]: r["count"] for r in out.groupBy("y").count().collect()} == {0: 240, 1: 240}


def test_smote_rows_lie_between_true_neighbours(spark):
    df = points(spark, 120, 30)
    base = np.array([r["x"] for r in df.where("y = 1").select(vector_to_array("features").alias("x")).collect()])
    made = oversample.smote(df, "id", "y", "features").where("synthetic").select(vector_to_array("features").alias("x")).collect()
    gap = np.linalg.norm(base[:, None] - base[None], axis=2)
    near = np.argsort(gap, axis=1)[:, 1:6]
    for row in made:
        p = np.array(row["x"])
        on_line = [
            abs(np.linalg.norm(p - a) + np.linalg.norm(p - base[j]) - np.linalg.norm(a - base[j])) < 1e-9
            for i, a in enumerate(base) for j in near[i]
        ]
        assert any(on_line)


def test_smote_needs_two_rows(spark):
    assert oversample.smote(points(spark, 50, 1), "id", "y", "features").where("synthetic").count() == 0


def test_target_encoding_leaves_own_fold_out(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 0.0), ("b", 0, 1.0), ("b", 1, 1.0)], "c string, fold int, y double")
    rows = {(r["c"], r["fold"]): r["encoded"] for r in prepare.target_encode(df, "c", "y", "fold", smoothing=0.0).collect()}
    assert rows["a", 0] == 0.0 and rows["a", 1] == 1.0 and rows["b", 0] == 1.0


def test_whole_run_writes_its_tables(spark, tmp_path):
    df = planted(spark, 240).select("num1", "num2", "cat", "target").unionByName(planted(spark, 5).select("num1", "num2", "cat", "target"))
    result = auto_model(df, "target", "planted", budget=TINY, max_replans=0)
    assert result.target == "target" and result.best_model != "DummyMostFrequent"
    assert result.tables["profile"].count() == 4
    artefacts.write_tables({"report": result.tables["report"]}, str(tmp_path), "r1")
    assert spark.read.json(f"{tmp_path}/report").count() > 10
    artefacts.append_history(result.record, str(tmp_path))
    (tmp_path / "log" / "broken.json").write_text("{not json\n")
    good, broken = artefacts.read_history(spark, str(tmp_path))
    assert good.count() == 1 and broken.count() == 1
    empty, _ = artefacts.read_history(spark, str(tmp_path / "nowhere"))
    assert empty.count() == 0


def test_many_classes_are_all_learnt(spark):
    df = spark.range(1500).selectExpr("cast(id % 150 as string) as y", "cast(id % 150 as double) as x", "id as n")
    labels = training.class_labels(df, "y")
    assert len(labels) == 150
    task = training.Task("y", True, FeaturePlan(continuous=("x",)), labels, True, budget=TINY)
    train, test = training.split(training.with_row_key(df), task, 0.2)
    board = training.train_models(train, test, task, [Spec("DummyMostFrequent"), Spec("RandomForest")]).board
    assert board.count() == 2


def test_warnings_of_every_kind_of_fit(spark):
    df = spark.range(240).selectExpr("cast(id % 3 as double) as y", "array(cast(id % 3 as double), rand(1)) as x", "1.0D as w")
    rows = df.coalesce(1).select("y", "w", array_to_vector("x").alias("features")).persist()
    two, facts = rows.where("y < 2"), {"n": 240, "mode": 0.0, "mean": 1.0, "std": 0.8}
    for name, data, k in [("LogisticRegression", rows, 3), ("SVC_RBF", two, 2), ("SVC_RBF", rows, 3), ("RandomForest", rows, 3),
                          ("LinearRegression", rows, 0), ("Ridge", rows, 0), ("DummyMean", rows, 0)]:
        model = models.fit(Spec(name), data, TINY, 1, k, facts)
        assert set(models.fit_warnings(model)) <= {"iteration limit reached before convergence"}


def test_jobs_side_by_side_keep_order_and_raise(spark, monkeypatch):
    running, most, lock = [0], [0], threading.Lock()

    def job(i):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        n = spark.range(1000 * (i + 1)).count()
        time.sleep(0.2)
        with lock:
            running[0] -= 1
        return n

    assert training.side_by_side(spark, [partial(job, i) for i in range(9)]) == [1000 * (i + 1) for i in range(9)]
    assert 1 < most[0] <= training.FITS_AT_ONCE
    assert training.side_by_side(spark, []) == [] and training.side_by_side(spark, [partial(job, 4)]) == [5000]
    with pytest.raises(ZeroDivisionError):
        training.side_by_side(spark, [partial(job, 1), lambda: 1 / 0, partial(job, 2)])


def test_fits_side_by_side_equal_single_ones(spark):
    df = spark.range(200).selectExpr("cast(id % 2 as double) as y", "array(cast(id % 2 as double), rand(1)) as x", "1.0D as w")
    rows = df.coalesce(1).select("y", "w", array_to_vector("x").alias("features"))
    task = training.Task("y", True, FeaturePlan(), ["0", "1"], budget=TINY)
    facts, specs = {"n": 200, "mode": 0.0, "mean": 0.5, "std": 0.5}, [Spec(n) for n in ("RandomForest", "LogisticRegression", "DummyMostFrequent", "GradientBoosting")]
    for s, model in zip(specs, training.fit_all(task, specs, rows, facts)):
        alone = models.fit(s, rows, TINY, task.seed, 2, facts)
        both = [[r["prediction"] for r in m.transform(rows).collect()] for m in (model, alone)]
        assert type(model) is type(alone) and both[0] == both[1]
