"""Shared intermediate tables: where they go, how they are written and dropped."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []
_writing = threading.Lock()
_writers = 0


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    Only a local session, whose one machine is its whole cluster, gets a temporary folder where none is
    named; it is deleted when the process ends. Any other session without the setting is an error.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="assay-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


BATCH_ROWS = 1_000
BATCH_BYTES = 8 << 20
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Send long texts to Python BATCH_ROWS rows or some BATCH_BYTES at a time, unless the session has smaller settings already.

    The settings stay for the session, as plans read them when they run.
    """
    if int(spark.conf.get(_ARROW_ROWS)) > BATCH_ROWS or int(spark.conf.get(_ARROW_ROWS)) <= 0:
        spark.conf.set(_ARROW_ROWS, str(BATCH_ROWS))
    now = spark.conf.get(_ARROW_BYTES).rstrip("bB")
    if not now.lstrip("-").isdigit() or int(now) > BATCH_BYTES or int(now) <= 0:
        spark.conf.set(_ARROW_BYTES, f"{BATCH_BYTES}b")


JIT_BYTES = 8_000
_METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit"


def compiled_methods(spark: SparkSession) -> None:
    """Keep generated methods within the size the JVM compiles: longer ones run interpreted.

    Aggregates over many columns generate such methods. The setting stays for the session, as plans read it when they run.
    """
    if int(spark.conf.get(_METHOD_BYTES)) > JIT_BYTES:
        spark.conf.set(_METHOD_BYTES, str(JIT_BYTES))


HASHED_BYTES = 64 << 20  # Spark takes no account of less than its advisory partition size
_HASHED = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"


def hashed_joins(spark: SparkSession) -> None:
    """Join counts with a row per column by hash, not by sorting, once those rows are too many to be sent to every task.

    Spark decides by the measured size of each shuffle partition. The setting stays for the session, as plans read it when they run.
    """
    if spark.conf.get(_HASHED) == "0b":
        spark.conf.set(_HASHED, f"{HASHED_BYTES}b")


_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write inside are deleted when it ends, not when the driver happens to collect garbage.

    Nothing reads them again: later steps read the written table. The setting ends with the last write inside.
    """
    global _writers
    with _writing:
        own = _writers > 0 or spark.conf.get(_SHUFFLES_GO, None) is None
        if own:
            _writers += 1
            spark.conf.set(_SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if own:
            with _writing:
                _writers -= 1
                if not _writers:
                    spark.conf.unset(_SHUFFLES_GO)


def write_table(df: DataFrame) -> tuple[str, DataFrame]:
    """materialise() that also tells the folder, for drop_tables()."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    _written.append(path)
    return path, df.sparkSession.read.schema(df.schema).parquet(path)


def materialise(df: DataFrame) -> DataFrame:
    """Write a reduced table to the shared folder and read it back.

    Later steps scan only the columns they need, Spark knows the size for its join choice, and a lost
    executor costs a re-read, not a recompute of the whole lineage.
    """
    return write_table(df)[1]


def tables_written() -> list[str]:
    """Folders of the tables materialise() has written and nothing has dropped yet, oldest first."""
    return list(_written)


def drop_passing(spark: SparkSession, before: list[str]) -> None:
    """Delete what materialise() has written since ``before`` was taken of tables_written(), but the last table, which stands for it."""
    drop_tables(spark, [t for t in tables_written()[:-1] if t not in before])


def drop_tables(spark: SparkSession, folders: list[str]) -> None:
    """Delete tables of materialise(); call it once whatever reads them is done."""
    sc = spark.sparkContext
    for folder in folders:
        if folder in _written:
            _written.remove(folder)
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
