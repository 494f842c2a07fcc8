"""Coercions and normal forms, all as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from assay import thresholds as th

# Spark's cast also takes a trailing d or f ("12d"); the pattern keeps those out.
NUMBER_PATTERN = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"

LONG, DOUBLE, TEXT, BOOL, TIME, OTHER = "long", "double", "text", "bool", "time", "other"


def family_of(data_type: T.DataType) -> str:
    """Storage family of a Spark type."""
    if isinstance(data_type, T.BooleanType):
        return BOOL
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return LONG
    if isinstance(data_type, (T.FloatType, T.DoubleType, T.DecimalType)):
        return DOUBLE
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        return TEXT
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return TIME
    return OTHER


def parse_number(text: Column) -> Column:
    """Text to double; null where the whole trimmed text is not a number."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(NUMBER_PATTERN), trimmed.try_cast("double"))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def to_number(c: Column, family: str) -> Column:
    """Any column as double, bad values as null."""
    if family == TEXT:
        return parse_number(c)
    if family in (LONG, BOOL):
        return c.cast("double")
    if family == DOUBLE:
        return nan_to_null(c.cast("double"))
    return F.lit(None).cast("double")


def epoch_micros(c: Column, data_type: T.DataType) -> Column:
    """Microseconds since 1970 as double, free of the session time zone for zoneless times."""
    day = F.unix_date(c.cast("date")).cast("double") * F.lit(86_400_000_000.0)
    if isinstance(data_type, T.DateType):
        return day
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(c).cast("double")
    seconds = F.hour(c) * 3600 + F.minute(c) * 60
    fraction = F.extract(F.lit("SECOND"), c).cast("double") * F.lit(1_000_000.0)
    return day + seconds.cast("double") * F.lit(1_000_000.0) + F.rint(fraction)


def null_tokens(c: Column) -> Column:
    """The fixed missing-value tokens as null."""
    return F.when(~c.isin(th.NULL_TOKENS), c)


def lower_trim(c: Column) -> Column:
    return F.lower(F.trim(c))


def safe_divide(a: Column, b: Column) -> Column:
    """Null instead of an error where the divisor is zero."""
    return a / F.when(b != 0, b)


def md5_of(*parts) -> Column:
    """md5 of the parts joined by a bar: a row order every engine reproduces."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]))


def hex_prefix_int(digest: Column, digits: int = 7) -> Column:
    """Leading hex digits of a digest as a long."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def any_word(text: Column, words: list[str]) -> Column:
    """True where the lower-cased text holds one of the words."""
    low = F.lower(text)
    out = F.lit(False)
    for word in words:
        out = out | F.contains(low, F.lit(word))
    return out


def joined(items: Column) -> Column:
    """Sorted, comma-joined list for flat result tables."""
    return F.concat_ws(",", F.sort_array(items))


def drop_null_items(*items: Column) -> Column:
    """Array of the items that are not null, in order."""
    return F.filter(F.array(*items), lambda x: x.isNotNull())
