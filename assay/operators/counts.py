"""Value counts of every column at once: the shared core of the profile.

One scan turns each row into (dataset, column, value) and counts equal values on the map side, so a
value held by a third of all rows reaches the shuffle as one row per task. Missing share, distinct
count, top share, schema kind, quantiles, outliers, ranges and leakage all follow from these counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from assay.functions import values as fv
from assay.session import compiled_methods, hashed_joins

KEY = "dataset_id"

# Texts above this length are counted under digests, so documents never travel whole.
LONG_TEXT = 64
DIGEST = "sha256:"
DIGEST_SIZE = len(DIGEST) + 64
EXACT_LONG = 9_007_199_254_740_992


@dataclass(frozen=True)
class TableInfo:
    """Column names and storage families, read from the schema alone."""

    columns: tuple[str, ...]
    families: tuple[str, ...]
    is_float: tuple[bool, ...]

    @staticmethod
    def of(df: DataFrame) -> "TableInfo":
        fields = [f for f in df.schema.fields if f.name != KEY]
        return TableInfo(
            tuple(f.name for f in fields),
            tuple(fv.family_of(f.dataType) for f in fields),
            tuple(f.dataType.typeName() in ("float", "double") for f in fields),
        )

    def name_of(self, pos: Column) -> Column:
        return F.element_at(F.array(*[F.lit(c) for c in self.columns]), pos + 1)

    def family_at(self, pos: Column) -> Column:
        return F.element_at(F.array(*[F.lit(c) for c in self.families]), pos + 1)

    def float_at(self, pos: Column) -> Column:
        return F.element_at(F.array(*[F.lit(c) for c in self.is_float]), pos + 1)


def with_dataset(df: DataFrame, key: str | None = None, name: str = "table") -> DataFrame:
    """Put the dataset key first: a given column, or one constant for a single table."""
    if key is None:
        return df.select(F.lit(name).alias(KEY), *df.columns)
    rest = [c for c in df.columns if c != key]
    return df.select(F.col(key).cast("string").alias(KEY), *rest)


def value_pair(df: DataFrame, name: str) -> tuple[Column, Column]:
    """A column as (number, text): numbers and times fill the first, all else the second."""
    data_type = df.schema[name].dataType
    family = fv.family_of(data_type)
    c = F.col(f"`{name}`")
    no_text = F.lit(None).cast("string")
    if family == fv.DOUBLE:
        number = fv.nan_to_null(c.cast("double"))
        if data_type.typeName() == "decimal":
            return number, F.when(number.cast(data_type) != c, c.cast("string"))
        return number, no_text
    if family == fv.LONG:
        return c.cast("double"), F.when(F.abs(c) > EXACT_LONG, c.cast("string"))
    if family == fv.BOOL:
        return c.cast("int").cast("double"), no_text
    if family == fv.TIME:
        return fv.epoch_micros(c, data_type), no_text
    text = c.cast("string")
    long_text = (F.length(text) > LONG_TEXT) & ~F.trim(text).rlike(fv.NUMBER_PATTERN)
    # Two digests: of the text as it is, which tells values apart, and of its normal form, which leakage compares.
    both = F.concat(F.lit(DIGEST), F.sha2(text, 256), short_form(fv.lower_trim(text)))
    return F.lit(None).cast("double"), F.when(long_text, both).otherwise(text)


def short_form(text: Column) -> Column:
    """A text, or the digest that stands for it above LONG_TEXT."""
    return F.when(F.length(text) > LONG_TEXT, F.concat(F.lit(DIGEST), F.sha2(text, 256))).otherwise(text)


def normal_text(counted: Column) -> Column:
    """Trimmed, lower-cased form of a counted text, at any length."""
    is_digest = counted.startswith(DIGEST) & (F.length(counted) >= DIGEST_SIZE)
    return F.when(is_digest, F.substring(counted, DIGEST_SIZE + 1, 2**31 - 1)).otherwise(fv.lower_trim(counted))


def value_counts(
    df: DataFrame, target: str | None = None, columns: list[str] | None = None, only: DataFrame | None = None,
) -> DataFrame:
    """(dataset_id, pos, num, txt[, y_num, y_txt], cnt), nulls counted as a value.

    ``pos`` is the column's place in the table; with ``target`` the counts are joint with it. ``only`` may hold
    the (dataset_id, pos) that are wanted, where not every dataset needs all ``columns``.
    """
    compiled_methods(df.sparkSession)
    hashed_joins(df.sparkSession)
    info = TableInfo.of(df)
    wanted = info.columns if columns is None else tuple(columns)
    cells = []
    for name in wanted:
        number, text = value_pair(df, name)
        cells += [F.lit(info.columns.index(name)), number, text]
    carried = [F.col(KEY)]
    if target is not None:
        y_number, y_text = value_pair(df, target)
        carried += [y_number.alias("y_num"), y_text.alias("y_txt")]
    long = df.select(*carried, F.stack(F.lit(len(wanted)), *cells).alias("pos", "num", "txt"))
    if only is not None:
        long = long.join(only, [KEY, "pos"], "left_semi")
    by = [KEY, "pos", "num", "txt"] + (["y_num", "y_txt"] if target is not None else [])
    return long.groupBy(*by).agg(F.count(F.lit(1)).alias("cnt"))


def without_target(counts: DataFrame) -> DataFrame:
    """Joint counts rolled up to plain value counts."""
    if "y_num" not in counts.columns:
        return counts
    return counts.groupBy(KEY, "pos", "num", "txt").agg(F.sum("cnt").alias("cnt"))
