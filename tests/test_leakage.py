"""Where the counts of hard leakage are joined."""

from assay.operators import leakage, quality, schema
from assay.operators.counts import TableInfo, value_counts, with_dataset
from assay.session import materialise


def test_counts_are_not_sent_to_every_task(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(20_000).selectExpr("id", "id % 3 as target", "concat('v', id % 3) as copy", "id % 7 as other").write.parquet(path)
    df = with_dataset(spark.read.parquet(path))
    joint = value_counts(df, target="target")
    out = leakage.hard_leakage(joint, schema.column_stats(joint, TableInfo.of(df)), "target")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan and "BuildLeft" not in plan
    assert {r.column_name: r.reason for r in out.collect()} == {
        "id": None, "copy": "deterministic_target_mapping", "other": None}


def test_counts_are_not_sorted_for_their_joins(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(20_000).selectExpr("cast(id % 500 as string) as dataset_id", "id", "id % 3 as target", "id * 1.5D as x").write.parquet(path)
    df = spark.read.parquet(path)
    joint = materialise(value_counts(df, target="target"))
    stats = materialise(schema.column_stats(joint, TableInfo.of(df)))
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if there were too many columns
    try:
        out = quality.numeric_counts(joint, stats)
        assert len(out.collect()) == 2 * 20_000 + 3 * 500
        final = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert "ShuffledHashJoin" in final and "SortMergeJoin" not in final
