import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from assay.functions.tails import paired_t_p_value, pearson_p_value
from assay.operators import leakage, pairs, quality, quantiles, schema, target as tg
from assay.operators.counts import TableInfo, value_counts, with_dataset
from assay.operators.quantiles import weighted_quantiles
from assay.operators.signals import signals
from assay.sources.tables import missing_to_null, read_csv


def kinds(df):
    return {r["column_name"]: r["kind"] for r in schema.infer_schema(with_dataset(df)).collect()}


@pytest.mark.parametrize("values, ddl, kind", [
    ([1, 2, 3], "int", "ordinal"), ([1.1, 2.2, 3.3], "double", "continuous"), ([None, None], "string", "all_missing"),
    ([0, 1, 0, 1], "int", "boolean"), ([0.0, 1.0], "double", "boolean"), (["yes", " No", "YES"], "string", "boolean"),
    (["t", "f"], "string", "boolean"), (["t", "t"], "string", "categorical"), ([True, True], "boolean", "boolean"),
    (["male", "female", "male"], "string", "categorical"), ([f"s{i}" for i in range(30)], "string", "text"),
    (["A", "B", "A", "C"], "string", "categorical"), ([f"{i}.5" for i in range(9)] + ["x"], "string", "continuous"),
    (["1", "2"] * 2 + ["x"], "string", "categorical"), (["1", "2", "3", "1", "2", "x"], "string", "ordinal"),
    (list(range(21)), "int", "continuous"), (list(range(20)), "int", "ordinal"), ([1.0] * 19 + [1.5], "double", "ordinal"),
    ([float("nan"), None], "double", "all_missing"), (["12d"] * 3, "string", "categorical"),
])
def test_kind(spark, values, ddl, kind):
    assert kinds(spark.createDataFrame([(v,) for v in values], f"a {ddl}")) == {"a": kind}


def test_times_and_big_integers_stay_distinct(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 00:00:00.000001' + make_dt_interval(0, 0, 0, id) as t,"
                   " 9007199254740992 + id as big, id from range(30)")
    rows = {r["column_name"]: r for r in schema.infer_schema(with_dataset(df)).collect()}
    assert rows["t"]["kind"] == "datetime" and rows["t"]["n_unique"] == 30
    assert rows["big"]["n_unique"] == 30


def test_long_texts_are_counted_whole(spark):
    base = "x" * 500
    df = spark.createDataFrame([(base + str(i % 7),) for i in range(21)], "t string")
    assert schema.infer_schema(with_dataset(df)).first()["n_unique"] == 7


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.floats(-1e6, 1e6), st.integers(-3, 3).map(float)), min_size=1, max_size=60), st.booleans())
def test_quantiles_match_numpy(spark, values, cells):
    probs = [0.05, 0.25, 0.5, 0.75, 0.95]
    df = spark.createDataFrame([("a", float(v), 1, 10**9 if cells else 1) for v in values], "k string, v double, n bigint, size bigint")
    got = weighted_quantiles(df, ["k"], "v", "n", probs, "size").first()
    assert got["n_values"] == len(values)
    np.testing.assert_allclose(got["q"], np.quantile(values, probs), rtol=1e-9, atol=1e-9)


def test_quantiles_with_a_hot_value(spark):
    rows = [("a", 5.0, 1_000_000)] + [("a", float(i), 1) for i in range(100)]
    got = weighted_quantiles(spark.createDataFrame(rows, "k string, v double, n bigint"), ["k"], "v", "n", [0.5]).first()
    assert got["q"] == [5.0]


def test_correlation_of_perfect_reverse_and_constant(spark):
    df = spark.range(30).selectExpr("cast(id as double) a", "id * 2.0D b", "30.0D - id c", "1.0D k")
    rows = {(r["col_a"], r["col_b"]): r for r in pairs.with_p_value(pairs.correlation_pairs(with_dataset(df))).collect()}
    assert rows["a", "b"]["abs_corr"] == pytest.approx(1) and rows["a", "c"]["corr"] == pytest.approx(-1)
    assert rows["a", "b"]["p_value"] == pytest.approx(0, abs=1e-9) and rows["a", "b"]["n_pairs"] == 30
    assert rows["a", "k"]["corr"] is None and rows["a", "k"]["p_value"] is None


def test_p_values_against_known_tails(spark):
    # r = .5 over 10 pairs: t = 1.633, p = .1411; t = 2.776 on 4 degrees: p = .05
    df = spark.createDataFrame([(0.5, 10.0)], "r double, n double")
    assert df.select(pearson_p_value("r", "n")).first()[0] == pytest.approx(0.14111, abs=1e-4)
    for dof, t in [(1, 12.7062), (2, 4.3027), (3, 3.1824), (4, 2.7764)]:
        p = spark.range(1).select(paired_t_p_value(F.lit(t), F.lit(dof))).first()[0]
        assert p == pytest.approx(0.05, abs=1e-4)


def test_class_balance_counts_null_as_class(spark):
    df = with_dataset(spark.createDataFrame([(0,)] * 9 + [(1,)], "y int"))
    assert quality.class_balance(df, "y").first()["imbalance_ratio"] == 9.0
    df = with_dataset(spark.createDataFrame([(0,)] * 4 + [(None,)], "y int"))
    assert quality.class_balance(df, "y").first()["n_classes"] == 2


def leaks(df, target):
    keyed = with_dataset(df)
    joint = value_counts(keyed, target=target)
    stats = schema.column_stats(joint, TableInfo.of(keyed))
    return {r["column_name"]: (r["level"], r["reason"]) for r in leakage.leakage_report(joint, stats, target).collect()}


def test_yes_no_for_one_zero_is_hard_leakage(spark):
    df = spark.range(40).selectExpr("if(id % 2 = 0, 'yes', 'no') f", "id % 7 noise", "id % 2 y")
    assert leaks(df, "y") == {"f": ("hard", "deterministic_target_mapping")}


def test_text_copy_is_exact(spark):
    df = spark.range(60).selectExpr("concat(' ', upper(chr(97 + id % 3))) f", "id n", "chr(97 + id % 3) y")
    assert leaks(df, "y")["f"] == ("hard", "exact_target_copy")


def test_quartile_of_a_number_is_soft_leakage(spark):
    df = spark.range(2000).selectExpr("id / 2000.0D x", "rand(7) noise", "cast(floor(id / 500) as int) y")
    assert leaks(df, "y") == {"x": ("soft", "high_mutual_information")}


def test_pruned_hard_leakage_agrees(spark):
    df = with_dataset(spark.range(200).selectExpr("id", "id % 3 as m", "id % 3 as y", "cast(id % 50 as string) as s"))
    joint = value_counts(df, target="y")
    stats = schema.column_stats(joint, TableInfo.of(df))
    found = lambda every: {(r["column_name"], r["reason"]) for r in leakage.hard_leakage(joint, stats, "y", every).where("reason is not null").collect()}
    assert found(True) == found(False) == {("m", "exact_target_copy")}


def test_target_is_not_the_identifier(spark):
    df = spark.range(100).selectExpr("id % 2 a", "id % 2 b", "id uid")
    keyed = with_dataset(df)
    scores = {r["column_name"]: r["score"] for r in tg.target_scores(schema.profile_columns(keyed), TableInfo.of(keyed)).collect()}
    assert scores["a"] == 3.0 and scores["uid"] == 1.0


def test_duplicates_with_nulls(spark):
    df = with_dataset(spark.createDataFrame([(1, None), (1, None), (2, "a"), (1, "a")], "a int, b string"))
    row = quality.duplicate_stats(df).first()
    assert (row["duplicate_count"], row["duplicate_pct"]) == (1, 25.0)


def test_csv_types_and_tokens(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b,c,d,e\n1,2,x,True,?\n2,NA,?,False,\n3,4.5,y,true,NULL\n")
    df = read_csv(spark, str(path))
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["bigint", "double", "string", "boolean", "string"]
    assert df.where("b is null").count() == 1 and df.where("e is null").count() == 3


def test_missing_to_null(spark):
    df = spark.createDataFrame([("?", float("nan")), ("ok", 1.0)], "s string, d double")
    assert missing_to_null(df).where("s is null and d is null").count() == 1


def test_signals_of_many_datasets_equal_single_runs(spark):
    df = spark.range(600).selectExpr(
        "cast(id % 3 as string) dataset_id", "rand(1) a", "if(id % 10 = 0, 100, 1) * rand(2) b", "id % 2 flag", "if(id % 3 = 0, id % 2, id % 5) y")
    many = {r["dataset_id"]: r for r in signals(df, "y").collect()}
    for k in ("0", "1"):
        one = signals(df.where(F.col("dataset_id") == k), "y").first()
        for c in ("rows", "outlier_cols", "hard_cols", "soft_cols", "imbalance_ratio", "scale_ratio", "near_constant_cols"):
            assert many[k][c] == one[c], c


@pytest.mark.parametrize("width", [21, 81])
def test_leak_by_case_and_blanks_is_found_at_any_length(spark, width):
    rows = [(f"{'k' * width}{i % 3}", f" {'K' * width}{i % 3}" if i % 2 else f"{'k' * width}{i % 3} ") for i in range(60)]
    df = with_dataset(spark.createDataFrame(rows, "target string, copied string"))
    joint = value_counts(df, target="target")
    stats = schema.column_stats(joint, TableInfo.of(df))
    got = leakage.hard_leakage(joint, stats, "target").collect()
    assert [(r["column_name"], r["reason"]) for r in got] == [("copied", "exact_target_copy")]


def test_drop_list_sees_all_correlated_pairs(spark):
    base = spark.range(200).selectExpr("id as n", "rand(3) as r")
    df = base.selectExpr("r as x00", *[f"r * {i + 2} + rand({i}) * 0.001 as x{i + 1:02d}" for i in range(24)], "n % 2 as target")
    row = signals(with_dataset(df), "target").first()
    assert len(row["corr_cols"]) == 24


def test_order_image_is_the_order_of_doubles(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([
        rng.normal(size=200) * 10.0 ** rng.integers(-300, 300, 200), 2.0 ** np.arange(-1074, 1024), -(2.0 ** np.arange(-1074, 1024, 7)),
        np.nextafter(2.0 ** np.arange(-1021, 1023, 11), 0), np.nextafter(2.0 ** np.arange(-1021, 1023, 11), np.inf),
        [0.0, 1e-5, 5e-324, 1.7976931348623157e308, np.inf, -np.inf], 0.1 + np.arange(50) * 1e-17, 1.7e15 + np.arange(50) * 0.25])
    values = np.unique(values)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = {r["v"]: r["i"] for r in df.select("v", quantiles.order_image(F.col("v")).alias("i")).collect()}
    images = [got[float(v)] for v in values]
    assert all(a < b for a, b in zip(images, images[1:]))
    bits = np.abs(values).view(np.int64)
    assert images == np.where(values < 0, -bits, bits).tolist()


@pytest.mark.parametrize("expr", ["id * 1e-5", "1e5 + id * 1e-5", "id * 1e-9", "1.7e15 + id * 37", "-1.0 / (id + 1)", "if(id % 3 = 0, 5.0, id * 1e-6)"])
def test_no_cell_keeps_a_hundredth_of_the_rows(spark, expr, monkeypatch):
    """Values as close as 1e-5, and times in microseconds: the cells ordered at last are small."""
    n = 20_000
    df = spark.range(n).selectExpr("'k' as k", f"cast({expr} as double) as v")
    counts = df.groupBy("k", "v").count()
    image = quantiles.order_image(F.col("v"))
    most = counts.groupBy(F.shiftright(image, quantiles.LEVELS[-1])).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    assert most <= n / 100
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    values = np.array([r["v"] for r in df.collect()])
    got = weighted_quantiles(counts, ["k"], "v", "count", probs).first()
    np.testing.assert_allclose(got["q"], np.quantile(values, probs), rtol=1e-12, atol=0)


def test_small_and_large_groups_side_by_side(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "ONE_CELL_ROWS", 50)
    rows = [("small", float(i), 1, 20) for i in range(20)] + [("large", i / 7, 2, 1000) for i in range(-300, 200)]
    df = spark.createDataFrame(rows, "k string, v double, n long, size long")
    got = {r["k"]: (r["n_values"], r["q"]) for r in weighted_quantiles(df, ["k"], "v", "n", [0.25, 0.5], "size").collect()}
    for k in ("small", "large"):
        values = np.repeat([v for g, v, _, _ in rows if g == k], [n for g, _, n, _ in rows if g == k])
        assert got[k][0] == len(values)
        np.testing.assert_allclose(got[k][1], np.quantile(values, [0.25, 0.5]))


@pytest.mark.parametrize("cell_rows", [3, 100_000])
def test_quantiles_of_cells_of_any_size(spark, monkeypatch, cell_rows):
    """Cells that are ordered at once and cells that are narrowed down first give the same; the rows are read twice, not four times."""
    monkeypatch.setattr(quantiles, "CELL_ROWS", cell_rows)
    rng = np.random.default_rng(5)
    values = {"a": np.concatenate([rng.normal(size=300), 1 + rng.random(200) * 1e-6, [7.5] * 90]), "b": np.array([2.0, 2.0, 3.0]), "c": -rng.random(50)}
    rows = [(k, float(v), int(n)) for k, x in values.items() for v, n in zip(*np.unique(x, return_counts=True))]
    probs = [0.05, 0.25, 0.5, 0.75, 0.95]
    found = weighted_quantiles(spark.createDataFrame(rows, "k string, v double, n bigint"), ["k"], "v", "n", probs)
    for r in found.collect():
        np.testing.assert_allclose(r["q"], np.quantile(values[r["k"]], probs), rtol=1e-9, atol=1e-9)
    if cell_rows > 3:
        assert found._jdf.queryExecution().optimizedPlan().collectLeaves().size() <= 2  # the rows once more, and the cells hit
