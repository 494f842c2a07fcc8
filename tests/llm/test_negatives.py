"""Hard negatives against a brute-force version."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from assay.llm import negatives


def brute(rows, every, k_pos=5, k_neg=10, low=30, high=90, scale=256):
    good = [(i, y, [int(np.floor(scale * x)) for x in v]) for i, y, v in rows
            if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    asking = {}
    for i, y, v in sorted(good, key=lambda r: (r[1], len(r[2]))):
        if i % every == 0:
            asking.setdefault(i, (y, v))
    out = []
    for a, (label, x) in asking.items():
        scored = sorted((-sum(p * q for p, q in zip(x, v)), i, y) for i, y, v in good if i != a and len(v) == len(x))
        for s, p, _ in [r for r in scored if r[2] == label][:k_pos]:
            inside = [(t, i) for t, i, y in scored if y != label and low * -s <= 100 * -t <= high * -s][:k_neg]
            out += [(a, p, n + 1, i, -s, -t) for n, (t, i) in enumerate(inside)]
    return sorted(out)


def some_rows(n=400, seed=5):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(4, 6))
    rows = []
    for i in range(n):
        label = int(rng.integers(4)) if i % 3 else 1
        rows.append((i, label, [float(x) for x in centre[label] + rng.normal(size=6)]))
    rows += [(n + i, 2, rows[9][2]) for i in range(30)] + [(n + 50 + i, 3, [0.0] * 6) for i in range(30)]  # ties
    rows += [(None, 1, rows[0][2]), (n + 100, None, rows[0][2]), (n + 101, 1, None), (n + 102, 1, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
             (n + 103, 1, [float("nan")] * 6), (n + 104, 1, [float("inf")] * 6), (n + 110, 1, [1.0, 2.0]), (n + 120, 2, [1.0, 1.0]),
             (-20, 1, rows[1][2]), (rows[2][0], 0, rows[5][2]), (n + 130, 0, [])]
    return rows


@pytest.mark.parametrize("size", [None, 16])
def test_equal_to_brute_force(spark, monkeypatch, size):
    if size:
        for name, value in (("ANCHORS", 8), ("CANDIDATES", size), ("STRIP", 3)):
            monkeypatch.setattr(negatives, name, value)
    rows = some_rows()
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    df = df.select("*", F.lit("x").alias("cell"), F.lit(3).alias("side"), F.lit(1).alias("id"))
    got = sorted(tuple(r) for r in negatives.hard_negatives(df, every=10).collect())
    want = brute(rows, 10)
    assert len(want) > 500 and got == want


def test_zero_scores_meet_a_positive_of_zero(spark):
    rows = [(100, 1, [0.0, 0.0]), (7, 1, [1.0, 1.0]), (3, 2, [1.0, 0.0]), (4, 2, [5.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert sorted(tuple(r) for r in negatives.hard_negatives(df).collect()) == [(100, 7, 1, 3, 0, 0), (100, 7, 2, 4, 0, 0)] == brute(rows, 100)


def test_empty_table(spark):
    assert negatives.hard_negatives(spark.createDataFrame([], "vec_id long, label int, embedding array<float>")).count() == 0


def test_keys_sort_by_anchor_then_falling_score():
    rows = [(a, s, k, i) for a in (-5, 0, 9) for s in (-(1 << 62), -1, 0, 7, 1 << 62) for k in (0, 1) for i in (-3, 2, 1 << 40)]
    keys = sorted(negatives.pack_key(*r) for r in rows)
    assert [negatives.unpack_key(k) for k in keys] == sorted(rows, key=lambda r: (r[0], -r[1], r[2], r[3]))


def test_large_values_stay_exact():
    for x in (3, (1 << 26) + 1, (1 << 31) - 1):
        left = np.array([[x, 3]])
        assert negatives.whole_products(left, left)[0, 0] == x * x + 9
