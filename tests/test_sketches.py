"""The two-pass profile: bounds of sketches, merging, decisions equal to those of exact counts."""

import pytest
from pyspark.sql import functions as F

from assay.operators import schema, sketches
from assay.operators.counts import KEY, with_dataset


def wide(spark, n=6000):
    return spark.range(n).selectExpr(
        "if(id < 2000, 'small', 'large') as dataset_id", "id as key", "id % 20 as twenty", "id % 21 as twenty_one", "cast(id % 50 as double) as fifty",
        "cast(id as double) / 7 as ratio", "if(id % 20 = 0, 'x', 'same') as edge", "if(id % 19 = 0, concat('v', id), 'same') as below",
        "if(id % 40 = 0, null, 'only') as mostly", "cast(null as string) as nothing", "if(id % 2 = 0, ' Yes', 'no ') as word",
        "concat(' ', id % 30, '.0') as text_number", "concat('t', id % 300) as tenth", "timestamp_seconds(id * 60) as at", "id % 2 = 0 as flag",
        "if(id % 5 = 0, -0.0D, 0.0D) as zero", "repeat(concat('long', id), 30) as long_text", "cast(id % 9 as decimal(20, 3)) as dec", "array(id) as nested")


def test_decisions_equal_exact_counts(spark):
    df = wide(spark)
    got = {(r[KEY], r["column_name"]): r for r in sketches.profile_columns(df).collect()}
    want = {(r[KEY], r["column_name"]): r for r in schema.profile_columns(df).collect()}
    assert got.keys() == want.keys() and len(got) == 36
    for at, w in want.items():
        g = got[at]
        for c in ("pos", "family", "kind", "n_rows", "n_present", "missing_pct", "n_numeric", "n_whole", "int_share", "min_num", "max_num"):
            assert g[c] == w[c], (at, c)
        assert (g["top_share"] >= 0.95) == (w["top_share"] >= 0.95), at
        for limit in (20, 50, 0.05 * w["n_rows"], 0.1 * w["n_rows"], 0.5 * w["n_rows"]):
            assert (g["n_unique"] <= limit) == (w["n_unique"] <= limit), (at, limit)
        assert g["unique_low"] <= w["n_unique"] <= g["unique_high"] and g["top_low"] <= w["top_count"] <= g["top_high"], at
        if g["exact"]:
            assert (g["n_unique"], g["top_count"]) == (w["n_unique"], w["top_count"])
    exact = {at[1] for at, g in got.items() if g["exact"]}
    assert {"edge", "twenty"} <= exact and not {"key", "ratio", "long_text", "word", "nothing"} & exact


def test_second_pass_counts_only_open_columns(spark):
    df = with_dataset(spark.range(4000).selectExpr("id", "id % 3 as three", "rand(1) as r"))
    rough = sketches.estimated_stats(sketches.sketch_columns(df))
    assert sketches.undecided(rough).count() == 0
    named = sketches.profile_columns(df, exact_columns=("r",))
    assert {r["column_name"] for r in named.where("exact").collect()} == {"r"}


def test_merged_parts_equal_the_whole(spark):
    df = wide(spark)
    whole = {(r[KEY], r["column_name"]): r for r in sketches.estimated_stats(sketches.sketch_columns(df)).collect()}
    parts = [sketches.sketch_columns(df.where(F.col("key") % 3 == i)) for i in range(3)]
    for r in sketches.estimated_stats(sketches.merge_sketches(*parts)).collect():
        w = whole[r[KEY], r["column_name"]]
        for c in ("kind", "n_rows", "n_present", "n_numeric", "int_share", "min_num", "max_num"):
            assert r[c] == w[c]
        assert abs(r["n_unique"] - w["n_unique"]) <= 0.05 * w["n_unique"]
    stored = sketches.merge_sketches(*parts)
    assert sketches.profile_columns(df, sketches=stored).where("exact").count() > 0


@pytest.mark.parametrize("per_scan", [1, 7])
def test_wide_tables_are_read_in_parts(spark, monkeypatch, per_scan):
    monkeypatch.setattr(sketches, "COLUMNS_PER_SCAN", per_scan)
    df = wide(spark, 100).select(KEY, "key", "word", "edge")
    assert sketches.sketch_columns(df).count() == 3


def test_empty_table(spark):
    assert sketches.profile_columns(wide(spark).where("key < 0")).count() == 0


def test_distinct_counts_keep_their_stated_error(spark):
    df = with_dataset(spark.range(200_000).selectExpr(*[f"cast(xxhash64(id % {n}, {n}) as string) as c{n}" for n in (300, 5000, 40_000, 170_000)]))
    for r in sketches.estimated_stats(sketches.sketch_columns(df)).collect():
        n = int(r["column_name"][1:])
        assert abs(r["n_unique"] - n) <= sketches.UNIQUE_ERROR * n and r["unique_low"] <= n <= r["unique_high"]
