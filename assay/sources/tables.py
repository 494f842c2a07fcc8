"""Table scans: Parquet as is, CSV with null tokens and inferred types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from assay.functions import values as fv


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table; spark.sql.files.maxPartitionBytes sets the size of its splits."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def missing_to_null(df: DataFrame) -> DataFrame:
    """Null tokens in text columns and NaN in floating columns become null."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.dataType.typeName() in ("float", "double"):
            c = fv.nan_to_null(c)
        elif fv.family_of(f.dataType) == fv.TEXT:
            c = fv.null_tokens(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; null tokens first, then types from the values that are left.

    Types come from one aggregate whose result is one row per table, whatever its size. Whole-number
    columns with gaps become double, as a float column would.
    """
    raw = missing_to_null(spark.read.csv(path, header=True))
    def flags(name: str) -> list:
        c = F.col(f"`{name}`")
        present = c.isNotNull()
        return [
            F.bool_and(F.when(present, F.trim(c).rlike(r"^[+-]?\d{1,18}$"))).alias(f"{name}|whole"),
            F.bool_and(F.when(present, fv.parse_number(c).isNotNull())).alias(f"{name}|number"),
            F.bool_and(F.when(present, F.trim(c).isin("True", "False", "TRUE", "FALSE", "true", "false"))).alias(f"{name}|bool"),
            F.bool_or(c.isNull()).alias(f"{name}|gaps"),
        ]
    seen = raw.agg(*[x for name in raw.columns for x in flags(name)]).first()
    def typed(name: str):
        c = F.trim(F.col(f"`{name}`"))
        if seen is None or seen[f"{name}|number"] is None and seen[f"{name}|bool"] is None:
            return F.col(f"`{name}`")
        if seen[f"{name}|whole"]:
            return c.cast("double" if seen[f"{name}|gaps"] else "bigint").alias(name)
        if seen[f"{name}|number"]:
            return c.cast("double").alias(name)
        if seen[f"{name}|bool"] and not seen[f"{name}|gaps"]:
            return F.lower(c).cast("boolean").alias(name)
        return F.col(f"`{name}`")
    return raw.select(*[typed(name) for name in raw.columns])
