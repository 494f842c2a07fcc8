"""Queries on the study read its rows no more often than they need."""

import pytest

import __spark_entry__ as entry
from assay.queries import study


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("study"))
    spark.range(600).selectExpr(
        "id div 4 as l_orderkey", "id % 50 as l_partkey", "id % 3 as l_suppkey", "cast(id % 4 + 1 as int) as l_linenumber",
        "cast(id % 13 as double) as l_quantity", "id * 1.5D as l_extendedprice", "(id % 11) / 100D as l_discount",
        "(id % 9) / 100D as l_tax", "substring('ANR', cast(id % 3 + 1 as int), 1) as l_returnflag",
        "substring('FO', cast(id % 2 + 1 as int), 1) as l_linestatus",
        "timestamp_ntz'1995-01-01' + make_interval(0, 0, 0, cast(id % 90 as int)) as l_shipdate",
    ).write.parquet(f"{path}/lineitem.parquet")
    study.forget_signals()
    yield path
    study.forget_signals()


@pytest.mark.parametrize("name", ["encoding_route", "quality_findings", "feature_keep_list"])
def test_statistics_are_made_once(spark, folder, name):
    out = entry.queries()[name](spark, folder)
    assert "lineitem.parquet" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert not any("lineitem.parquet" in f for f in out.inputFiles())
    assert out.count() > 0


@pytest.mark.parametrize("name", [
    "diagnostics_cls", "diagnostics_reg", "replan_flag", "replan_flag_reg", "verdict", "tie_break", "suggestion_rank",
    "target_unsuitable", "failed_targets", "history_lookup", "run_report"])
def test_predictions_are_scored_once(spark, folder, name):
    """Boards, fold summaries and reports come from tables written once, not from the predictions of every row again."""
    out = entry.queries()[name](spark, folder)
    assert not any("lineitem.parquet" in f for f in out.inputFiles())
    assert out.columns


def test_the_report_of_a_model_is_that_of_its_predictions(spark, folder):
    from assay.operators import metrics
    from assay.queries import findings

    by = ["dataset_id", "model", "pos"]
    direct = metrics.class_report(metrics.confusion_counts(findings.predictions(spark, folder), by), by)
    kept = findings.study_report(spark, folder).select(direct.columns)
    assert kept.count() > 20 and sorted(map(tuple, kept.collect())) == sorted(map(tuple, direct.collect()))
