"""Column statistics in two passes: mergeable sketches first, exact counts only where a threshold is left open.

The first pass is one aggregate over the table, one row per dataset: plain sums, a HyperLogLog sketch of the
distinct values and a frequent-items sketch of the most common one. It shuffles a few kilobytes per task,
dataset and column whatever the values are, and its result can be stored and merged with that of other rows,
so a table that grows by a day is profiled by reading the day. The second pass counts values exactly, but only
in those columns whose sketch leaves a threshold within its error.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from assay import thresholds as th
from assay.functions import values as fv
from assay.operators.counts import KEY, TableInfo, value_counts
from assay.operators.schema import column_stats, kind_of, word_bit
from assay.session import compiled_methods, materialise

LG_K = 12  # the sketch of distinct values has two to this many registers
SIGMAS = 3.0
# Relative deviation of a merged sketch with so many registers, times SIGMAS: 4.9 % at LG_K = 12.
UNIQUE_ERROR = SIGMAS * 1.04 / 2 ** (LG_K / 2)
TRACKED = 96  # items a frequent-items sketch follows
MAP_SIZE = 128  # its table: the power of two that holds TRACKED at three quarters
TOP_ERROR = 3.5 / MAP_SIZE  # of all rows, by which it may count an item too high
COLUMNS_PER_SCAN = 64

# Distinct counts that decisions compare with, absolute and as shares of the rows.
UNIQUE_LIMITS = (th.CATEGORY_MAX_UNIQUE, th.ONE_HOT_MAX_UNIQUE)
SHARE_LIMITS = (th.ONE_HOT_MAX_SHARE, th.TEXT_MAX_SHARE, 0.5)

SUMS = ("n_rows", "n_present", "n_numeric", "n_zero_one", "int_like", "n_whole")
NAMES = ("pos", "column_name", "family", "is_float")


def _parts(df: DataFrame, info: TableInfo, name: str, i: int) -> list[Column]:
    """Number, digest of the value and word bit of a cell, computed once a row: x, v and w."""
    family, kind = info.families[info.columns.index(name)], df.schema[name].dataType
    c = F.col(f"`{name}`")
    x = fv.epoch_micros(c, kind) if family == fv.TIME else fv.to_number(c, family)
    if family == fv.DOUBLE and kind.typeName() != "decimal":
        value = F.when(x.isNotNull(), F.xxhash64(x + F.lit(0.0)))  # -0.0 and 0.0 are one value
    else:
        value = F.when(c.isNotNull(), F.xxhash64(F.to_json(F.struct(c)) if family == fv.OTHER else c))
    words = word_bit(c) if family == fv.TEXT else F.lit(None).cast("int")
    return [x.alias(f"x{i}"), value.alias(f"v{i}"), words.alias(f"w{i}")]


def _cell(info: TableInfo, name: str, i: int) -> Column:
    """What the first pass keeps of one column."""
    pos = info.columns.index(name)
    family, x, value = info.families[pos], F.col(f"x{i}"), F.col(f"v{i}")
    numbers = F.lit(None).cast("binary")
    if family == fv.TEXT:
        numbers = F.hll_sketch_agg(F.when(x.isNotNull(), F.xxhash64(x + F.lit(0.0))), LG_K)
    return F.struct(
        F.lit(pos).alias("pos"), F.lit(name).alias("column_name"), F.lit(family).alias("family"), F.lit(info.is_float[pos]).alias("is_float"),
        F.count(F.lit(1)).alias("n_rows"), F.count(value).alias("n_present"), F.count(x).alias("n_numeric"),
        F.count_if(x.isin(0.0, 1.0)).alias("n_zero_one"), F.count_if(F.abs(x - F.rint(x)) <= th.INTEGER_TOLERANCE).alias("int_like"),
        F.count_if(x % 1 == 0).alias("n_whole"), F.min(x).alias("min_num"), F.max(x).alias("max_num"),
        F.coalesce(F.bit_or(f"w{i}"), F.lit(0)).alias("words"), F.hll_sketch_agg(value, LG_K).alias("values"), numbers.alias("numbers"),
        F.call_function("approx_top_k_accumulate", value, F.lit(TRACKED)).alias("top"),
    )


def sketch_columns(df: DataFrame) -> DataFrame:
    """One row of sums and sketches per (dataset, column); a table of COLUMNS_PER_SCAN columns or fewer is read once.

    Rows without a dataset key form a dataset of their own. An empty table gives no rows.
    """
    compiled_methods(df.sparkSession)
    info = TableInfo.of(df)
    parts = []
    for at in range(0, len(info.columns), COLUMNS_PER_SCAN):
        names = info.columns[at : at + COLUMNS_PER_SCAN]
        cells = df.select(KEY, *[x for i, n in enumerate(names) for x in _parts(df, info, n, i)])
        wide = cells.groupBy(KEY).agg(*[_cell(info, n, i).alias(f"c{i}") for i, n in enumerate(names)])
        parts.append(wide.select(KEY, F.inline(F.array(*[F.col(f"c{i}") for i in range(len(names))]))))
    return reduce(DataFrame.union, parts)


def merge_sketches(*tables: DataFrame) -> DataFrame:
    """The sketches of all rows, from sketches of disjoint parts of them with the same columns."""
    rows = reduce(DataFrame.unionByName, tables)
    return rows.groupBy(KEY, *NAMES).agg(
        *[F.sum(c).alias(c) for c in SUMS], F.min("min_num").alias("min_num"), F.max("max_num").alias("max_num"),
        F.bit_or("words").alias("words"), F.hll_union_agg("values").alias("values"), F.hll_union_agg("numbers").alias("numbers"),
        F.call_function("approx_top_k_combine", F.col("top"), F.lit(TRACKED)).alias("top"),
    )


def estimated_stats(sketches: DataFrame, max_unique: int = th.CATEGORY_MAX_UNIQUE) -> DataFrame:
    """Column statistics from sketches, with bounds of what is not exact.

    Sums, ends and shares of numbers are exact. n_unique lies between unique_low and unique_high, UNIQUE_ERROR
    (4.9 %) below or above, in all but about 3 of 1,000 columns; counts up to some hundreds come out exact.
    top_count lies between top_low and top_high, at most TOP_ERROR (2.7 %) of the rows apart, always.
    """
    unique, numbers = F.hll_sketch_estimate("values"), F.hll_sketch_estimate("numbers")
    first = F.get(F.call_function("approx_top_k_estimate", F.col("top"), F.lit(1)), 0)
    missing = F.col("n_rows") - F.col("n_present")
    # The sketch names an item only where it is sure of it; one it does not name may still reach its error.
    error = F.floor(F.col("n_present") * TOP_ERROR)
    named = first.getField("count")
    listed = F.when(named.isNotNull(), F.least(named, F.col("n_present")))
    nothing = F.lit(0).cast("long")
    rows = sketches.withColumns({
        "n_unique": F.least(unique, F.col("n_present")),
        "numeric_unique": F.least(F.when(F.col("family") == fv.TEXT, F.coalesce(numbers, F.lit(0).cast("long"))).otherwise(unique), F.col("n_numeric")),
        "top_high": F.greatest(F.coalesce(listed, F.least(F.greatest(error, F.lit(1)), F.col("n_present"))), missing),
        "top_low": F.greatest(F.coalesce(listed - error, nothing), missing, nothing),
    })
    rows = rows.withColumns({
        "unique_low": F.floor(F.col("n_unique") / (1 + UNIQUE_ERROR)), "unique_high": F.least(F.ceil(F.col("n_unique") / (1 - UNIQUE_ERROR)), F.col("n_present")),
        "numeric_low": F.floor(F.col("numeric_unique") / (1 + UNIQUE_ERROR)), "numeric_high": F.ceil(F.col("numeric_unique") / (1 - UNIQUE_ERROR)),
    })
    return rows.select(
        KEY, "pos", "column_name", "family", "is_float", "n_rows", "n_present",
        ((F.col("n_rows") - F.col("n_present")) / F.col("n_rows") * 100).alias("missing_pct"),
        "n_unique", "numeric_unique", F.col("top_high").alias("top_count"), (F.col("top_high") / F.col("n_rows")).alias("top_share"),
        "n_numeric", "n_whole", fv.safe_divide(F.col("int_like"), F.col("n_numeric")).alias("int_share"), "min_num", "max_num",
        kind_of(F.col("family"), max_unique).alias("kind"), F.lit(False).alias("exact"),
        "unique_low", "unique_high", "numeric_low", "numeric_high", "top_low", "top_high",
    )


def undecided(stats: DataFrame, max_unique: int = th.CATEGORY_MAX_UNIQUE) -> DataFrame:
    """(dataset_id, pos) of estimated columns of which some threshold lies within the bounds."""
    n = F.col("n_rows")
    between = lambda low, high, limit: (F.col(low) <= limit) & (F.col(high) > limit)
    open_ = (F.col("top_low") < th.NEAR_CONSTANT * n) & (F.col("top_high") >= th.NEAR_CONSTANT * n)
    for limit in {max_unique, *UNIQUE_LIMITS}:
        open_ = open_ | between("unique_low", "unique_high", F.lit(limit)) | between("numeric_low", "numeric_high", F.lit(limit))
    for share in SHARE_LIMITS:
        open_ = open_ | between("unique_low", "unique_high", n * share) | between("unique_low", "unique_high", n * share - 1)
    return stats.where(open_).select(KEY, "pos")


def profile_columns(
    df: DataFrame, max_unique: int = th.CATEGORY_MAX_UNIQUE, sketches: DataFrame | None = None, exact_columns: tuple[str, ...] = (),
) -> DataFrame:
    """Column statistics whose decisions are exact, with ``exact`` telling where the counts are too.

    ``sketches`` may bring a stored first pass over the same rows. Columns that a threshold leaves open, and
    those named in ``exact_columns``, are counted; the others keep estimates of n_unique and top_count, within
    the bounds beside them. The second pass reads only columns that are open in some dataset.
    """
    info = TableInfo.of(df)
    rough = materialise(estimated_stats(sketch_columns(df) if sketches is None else sketches, max_unique))
    wanted = undecided(rough, max_unique)
    if exact_columns:
        wanted = wanted.union(rough.where(F.col("column_name").isin(*exact_columns)).select(KEY, "pos")).distinct()
    wanted = materialise(wanted)
    places = [r["pos"] for r in wanted.select("pos").distinct().collect()]  # as many as the table is wide
    if not places:
        return rough
    counts = value_counts(df, columns=[info.columns[p] for p in sorted(places)], only=wanted)
    counted = column_stats(counts, info, max_unique)
    same = lambda c: F.col(c).cast("long")
    counted = counted.select(
        "*", F.lit(True).alias("exact"), same("n_unique").alias("unique_low"), same("n_unique").alias("unique_high"),
        same("numeric_unique").alias("numeric_low"), same("numeric_unique").alias("numeric_high"),
        same("top_count").alias("top_low"), same("top_count").alias("top_high"),
    )
    return rough.join(wanted, [KEY, "pos"], "left_anti").unionByName(counted)
