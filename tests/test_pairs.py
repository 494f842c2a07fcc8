"""Pairwise-complete correlation by blocked sums, against plain numpy."""

import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from assay.operators import pairs
from assay.operators.counts import with_dataset

# Steps of a thousandth: squares of differences below 1e-154 leave the range of a double, as in any sum of squares.
CELL = st.one_of(st.none(), st.integers(-10**9, 10**9).map(lambda v: v / 1000), st.sampled_from([0.0, 0.1, 1e15, 1e15 + 1, -3.0]))


def plain(x, y):
    """(n, corr) of two lists with gaps; None where a side does not vary."""
    both = [(a, b) for a, b in zip(x, y) if a is not None and b is not None]
    if not both:
        return 0, None
    a, b = np.array(both, np.longdouble).T
    if not np.isfinite(a).all() or not np.isfinite(b).all():
        return len(both), math.nan
    if a.min() == a.max() or b.min() == b.max():
        return len(both), None
    a, b = a - a.mean(), b - b.mean()
    return len(both), float((a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum()))


def check(got, x, y):
    n, corr = plain(x, y)
    if n == 0:
        assert got is None
        return
    assert got is not None and got[1] == n
    assert (got[0] is None) == (corr is None)
    if corr is not None:
        assert math.isnan(got[0]) if math.isnan(corr) else got[0] == pytest.approx(corr, abs=1e-7)


@given(st.lists(st.tuples(CELL, CELL, CELL), min_size=1, max_size=24), st.integers(1, 9))
@settings(max_examples=300, deadline=None)
def test_sums_of_any_cut_equal_the_whole(rows, size):
    given_ = np.array([[np.nan if v is None else v for v in r] for r in rows])
    there = np.array([[v is not None for v in r] for r in rows])
    total = None
    for a in range(0, len(rows), size):
        x, t = given_[a : a + size], there[a : a + size]
        part = pairs.pair_sums(x, t, x, t)
        total = part if total is None else pairs.merged(total, part)
    for i in range(3):
        for j in range(3):
            n, corr = plain([r[i] for r in rows], [r[j] for r in rows])
            assert total[pairs.N, i, j] == n
            spread = total[pairs.SPREAD_X, i, j] * total[pairs.SPREAD_Y, i, j]
            assert (spread > 0) == (corr is not None)
            if corr is not None:
                assert total[pairs.JOINT, i, j] / math.sqrt(spread) == pytest.approx(corr, abs=1e-6)


def frame(spark, n_columns, n_rows, keys=("a",), seed=5):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n_rows, n_columns)) + rng.normal(size=(n_rows, 1))
    cells = np.where(rng.random(base.shape) < 0.2, None, base)
    rows = [(keys[k % len(keys)], *map(lambda v: None if v is None else float(v), r)) for k, r in enumerate(cells)]
    names = [f"c{i}" for i in range(n_columns)]
    return rows, spark.createDataFrame(rows, ", ".join(["site string", *[f"{c} double" for c in names]])).repartition(8)


def test_pairs_of_several_datasets_with_gaps(spark, monkeypatch):
    monkeypatch.setattr(pairs, "ROWS", 16)
    keys = ("a", None, "b")
    rows, df = frame(spark, 5, 300, keys)
    got = {(r.dataset_id, r.col_a, r.col_b): (r["corr"], r.n_pairs) for r in pairs.correlation_pairs(with_dataset(df, "site")).collect()}
    assert len(got) == 3 * 10
    for key in keys:
        own = [r for r in rows if r[0] == key]
        for i in range(5):
            for j in range(i + 1, 5):
                check(got.get((key, f"c{i}", f"c{j}")), [r[i + 1] for r in own], [r[j + 1] for r in own])


def test_odd_values_and_columns_that_never_meet(spark):
    rows = [
        (1.0, math.inf, 0.1, 7.0, None, "1"), (2.0, 1.0, 0.1, None, 3.0, " 2 "), (4.0, 2.0, 0.1, 8.0, None, "x"),
        (8.0, 5.0, 0.1, None, 4.0, None), (None, math.nan, None, 9.5, None, "9"), (3.0, None, 0.3, None, None, "4"),
    ]
    df = spark.createDataFrame(rows, "`a b` double, i double, k double, p double, q double, t string")
    names = ["a b", "i", "k", "p", "q", "t"]
    cells = [[None if isinstance(v, float) and math.isnan(v) else v for v in r[:5]] + [{"1": 1.0, " 2 ": 2.0, "9": 9.0, "4": 4.0}.get(r[5])] for r in rows]
    found = pairs.correlation_pairs(with_dataset(df), names).collect()
    got = {(r.col_a, r.col_b): (r["corr"], r.n_pairs) for r in found}
    for i in range(6):
        for j in range(i + 1, 6):
            check(got.get((names[i], names[j])), [r[i] for r in cells], [r[j] for r in cells])
    assert ("p", "q") not in got and got["k", "p"][0] is None and math.isnan(got["a b", "i"][0])


def test_wide_tables_take_one_scan_and_narrow_ones_none(spark, monkeypatch, tmp_path):
    rows, df = frame(spark, 70, 60)
    path = str(tmp_path / "wide")
    df.write.parquet(path)
    wide = with_dataset(spark.read.parquet(path), "site")
    out = pairs.correlation_pairs(wide)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    one = {(r.col_a, r.col_b): (r["corr"], r.n_pairs) for r in out.collect()}
    assert len(one) == 70 * 69 // 2
    for i, j in [(0, 1), (3, 33), (31, 32), (40, 69), (68, 69)]:
        check(one[f"c{i}", f"c{j}"], [r[i + 1] for r in rows], [r[j + 1] for r in rows])
    monkeypatch.setattr(pairs, "SCAN_COLUMNS", 32)
    cut = {(r.col_a, r.col_b): (r["corr"], r.n_pairs) for r in pairs.correlation_pairs(wide).collect()}
    assert cut.keys() == one.keys()
    assert all(cut[k][1] == one[k][1] and cut[k][0] == pytest.approx(one[k][0], abs=1e-12) for k in one)
    assert pairs.correlation_pairs(wide, ["c1"]).count() == 0
    assert pairs.correlation_pairs(wide.limit(0)).count() == 0


def test_a_single_table_is_not_sorted(spark):
    df = with_dataset(spark.range(100).selectExpr("id a", "id * 2 b"))
    plan = pairs.correlation_pairs(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort " not in plan


def test_few_rows_of_many_datasets_travel_as_values(spark):
    n, w = 240, 6
    rows, df = frame(spark, w, n, tuple(f"s{k:03}" for k in range(80)))
    rows += [("big", *map(float, r)) for r in np.random.default_rng(7).normal(size=(400, w))]
    df = df.unionByName(spark.createDataFrame(rows[n:], df.schema).coalesce(1))
    keyed = with_dataset(df, "site").sortWithinPartitions("dataset_id")
    sums = pairs._partial_sums(keyed.toDF("dataset_id", *[f"x{i}" for i in range(w)]), list(range(w)), list(range(w))).collect()
    # Three rows a dataset: what travels is never more than the rows themselves.
    assert all(len(r.sums) <= 3 * w * 8 for r in sums if r.dataset_id != "big")
    assert [len(r.sums) for r in sums if r.dataset_id == "big"] == [7 * w * w * 8]
    got = {(r.dataset_id, r.col_a, r.col_b): (r["corr"], r.n_pairs) for r in pairs.correlation_pairs(with_dataset(df, "site")).collect()}
    for key in ("s000", "s041", "s079", "big"):
        own = [r for r in rows if r[0] == key]
        for i in range(w):
            for j in range(i + 1, w):
                check(got.get((key, f"c{i}", f"c{j}")), [r[i + 1] for r in own], [r[j + 1] for r in own])
