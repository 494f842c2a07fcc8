"""Tables on the shared folder: what their writing leaves behind."""

import os
import time

from pyspark.sql import functions as F

from assay import session


def _shuffle_bytes(spark) -> int:
    local = [spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    return sum(
        os.path.getsize(os.path.join(folder, f))
        for dirs in local for d in dirs for folder, _, files in os.walk(d.getPath()) for f in files if f.startswith("shuffle_")
    )


def test_a_written_table_leaves_no_shuffle_files(spark):
    before = _shuffle_bytes(spark)
    counts = spark.range(200_000).groupBy((F.col("id") % 100_000).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    written = session.materialise(counts)
    for _ in range(50):  # files are deleted in the background
        if _shuffle_bytes(spark) <= before:
            break
        time.sleep(0.1)
    assert _shuffle_bytes(spark) <= before
    assert spark.conf.get(session._SHUFFLES_GO, None) is None
    assert written.agg(F.sum("n")).first()[0] == 200_000


def test_the_setting_lasts_until_the_last_write(spark):
    with session.shuffles_dropped(spark):
        with session.shuffles_dropped(spark):
            pass
        assert spark.conf.get(session._SHUFFLES_GO, None) == "true"
    assert spark.conf.get(session._SHUFFLES_GO, None) is None


def test_passing_tables_go_but_the_last_and_older_ones(spark):
    older = session.materialise(spark.range(3))
    before = session.tables_written()
    passing = session.materialise(spark.range(4))
    last = session.materialise(passing.filter("id > 0"))
    session.drop_passing(spark, before)
    assert session.tables_written() == [*before, session.tables_written()[-1]]
    assert (older.count(), last.count()) == (3, 3)
    assert not os.path.exists(passing.inputFiles()[0].removeprefix("file:"))
