"""Exact interpolated quantiles without ever gathering a column in one task.

Spark's ``percentile`` keeps all distinct values of a group in one map. Here ranks are found by radix selection
on the order-preserving 64-bit image of a double: counts by its leading 20 bits tell which cells hold a wanted
rank. Cells of up to CELL_ROWS rows are ordered at once. Only if larger ones are hit, counts by the next 16 bits,
inside those cells only, narrow them down, 16 more do so again, and the values of the cells hit at last, at most
4,096 different ones each, are ordered. That holds for values of any size and spacing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from assay.session import materialise

# Bits of the image below the cells of each level.
LEVELS = (44, 28, 12)

# A group of at most this many rows is ordered as one cell: counting its cells would not pay.
ONE_CELL_ROWS = 100_000

# A cell of at most this many rows is ordered as it is: narrowing it down would read all rows twice more.
CELL_ROWS = 100_000

_SMALLEST_NORMAL = 2.2250738585072014e-308
_SMALLEST = 5e-324


def order_image(v: Column) -> Column:
    """A long that orders like the double, one for each: its bits, negated for negative values; both zeros are 0."""
    a = F.abs(v)
    guess = F.floor(F.log2(a)).cast("double")
    power = lambda e: F.pow(F.lit(2.0), e)
    exponent = F.when(a < power(guess), guess - 1).when(a >= power(guess + 1), guess + 1).otherwise(guess)  # the logarithm may be off by rounding
    bits = F.shiftleft((exponent + 1023).cast("long"), 52) + ((a / power(exponent) - 1) * F.lit(2.0**52)).cast("long")
    image = (
        F.when(a < _SMALLEST_NORMAL, (a / F.lit(_SMALLEST)).cast("long"))
        .when(a == float("inf"), F.lit(2047 << 52))
        .otherwise(bits)
    )
    return F.when(v < 0, -image).otherwise(image)


def leading_cell(v: Column) -> Column:
    """The first level's cell: never decreasing in v."""
    return F.shiftright(order_image(v), LEVELS[0])


def _grid(probs: list[float]) -> int:
    """Smallest m such that every share is a multiple of 1/m."""
    for m in range(1, 1001):
        if all(abs(p * m - round(p * m)) < 1e-9 for p in probs):
            return m
    raise ValueError("quantile shares must be multiples of 1/m for some m up to 1000")


def _grid_range(m: int, start: Column, weight: Column) -> tuple[Column, Column]:
    """Grid steps i whose spot i (total - 1) / m may belong to rows [start, start + weight).

    A wanted rank is less than one off its spot; the slack keeps rounding from losing a step.
    """
    last = F.greatest(F.col("total") - 1, F.lit(1)).cast("double")
    return F.ceil((start - 1) * m / last - 1e-6), F.floor((start + weight) * m / last + 1e-6)


def weighted_quantiles(
    counts: DataFrame, by: list[str], value: str, weight: str, probs: list[float], group_rows: str | None = None
) -> DataFrame:
    """(by..., n_values, q): q holds one quantile per wanted share, linear between neighbouring ranks.

    ``counts`` holds rows of (by, value) with their weight; nulls are skipped. ``group_rows`` may name
    a column with an upper bound of the group's rows, so that small groups skip the cells.
    """
    v = F.col(value)
    image = order_image(v)
    if group_rows is not None:
        image = F.when(F.col(group_rows) > ONE_CELL_ROWS, image)
    rows = counts.where(v.isNotNull()).select(*by, v.alias("v"), F.col(weight).alias("w"), image.alias("image"))
    # Groups without an image have one cell, on the first level only.
    named = [F.coalesce(F.shiftright("image", below), F.lit(0).cast("long")).alias(f"c{i}") for i, below in enumerate(LEVELS)]
    cells = rows.select(*by, "v", "w", *named, F.col("image").isNotNull().alias("fine"))
    m = _grid(probs)
    first, last = _grid_range(m, F.col("before"), F.col("cell_w"))
    upto = lambda keys, order: Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per = cells.groupBy(*by, "c0").agg(F.sum("w").alias("cell_w"), (F.bool_or("fine") & (F.count(F.lit(1)) > CELL_ROWS)).alias("deep"))
    # A few rows per group.
    top = materialise(
        per.withColumn("total", F.sum("cell_w").over(Window.partitionBy(*by)))
        .withColumn("before", F.sum("cell_w").over(upto(by, "c0")) - F.col("cell_w"))
        .where(first <= last)
        .select(*by, "c0", "total", "before", "deep")
    )
    held_in = ["v", "w", "total", "before"]
    cut = cells.join(top.where("not deep").drop("deep"), [*by, "c0"]).select(*by, F.lit(0).alias("_level"), F.col("c0").alias("cell"), *held_in)
    if not top.where("deep").isEmpty():
        hit, inner = top.where("deep").drop("deep"), cells.where("fine")
        for i in range(1, len(LEVELS)):
            per = inner.join(hit, [*by, f"c{i - 1}"]).groupBy(*by, f"c{i - 1}", f"c{i}", "total", "before").agg(F.sum("w").alias("cell_w"))
            hit = (
                per.withColumn("before", F.col("before") + F.sum("cell_w").over(upto([*by, f"c{i - 1}"], f"c{i}")) - F.col("cell_w"))
                .where(first <= last)
                .select(*by, f"c{i}", "total", "before")
            )
        narrow = inner.join(hit, [*by, f"c{len(LEVELS) - 1}"])
        cut = cut.unionByName(narrow.select(*by, F.lit(1).alias("_level"), F.col(f"c{len(LEVELS) - 1}").alias("cell"), *held_in))
    inside = Window.partitionBy(*by, "_level", "cell").orderBy("v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    share_at = {round(p * m): float(p) for p in probs}
    shares = F.array(*[F.lit(share_at.get(i)).cast("double") for i in range(m + 1)])
    start = F.col("start")
    first, last = _grid_range(m, start, F.col("w"))
    low, high = F.floor(F.col("spot")), F.ceil(F.col("spot"))
    held = lambda rank: (rank >= start) & (rank < start + F.col("w"))
    picked = (
        cut.withColumn("start", F.col("before") + F.sum("w").over(inside) - F.col("w"))
        .where(first <= last)
        .select(*by, "total", "v", "w", "start", F.explode(F.sequence(first, last)).alias("step"))
        .withColumn("spot", F.get(shares, F.col("step").cast("int")) * (F.col("total") - 1))
        .where(F.col("spot").isNotNull())
        .select(*by, "total", "v", F.explode(F.array(
            F.when(held(low), low), F.when(held(high) & (high != low), high))).alias("rank"))
        .where(F.col("rank").isNotNull())
        .distinct()
    )
    # Two entries per wanted share at most.
    found = picked.groupBy(*by, "total").agg(
        F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at")
    )
    spots = F.transform(F.array(*[F.lit(float(p)) for p in probs]), lambda p: p * (F.col("total") - 1))

    def between(spot: Column) -> Column:
        low, high = F.element_at("at", F.floor(spot)), F.element_at("at", F.ceil(spot))
        return F.when(low == high, low).otherwise(low + (high - low) * (spot - F.floor(spot)))
    return found.withColumn("spots", spots).select(
        *by, F.col("total").alias("n_values"), F.transform("spots", between).alias("q")
    )


def column_quantiles(df: DataFrame, by: list[str], columns: list[str], probs: list[float]) -> DataFrame:
    """Quantiles of numeric columns of a table: (by..., column_name, n_values, q)."""
    cells = [x for c in columns for x in (F.lit(c), F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)))]
    long = df.select(*by, F.stack(F.lit(len(columns)), *cells).alias("column_name", "v"))
    counts = long.groupBy(*by, "column_name", "v").agg(F.count(F.lit(1)).alias("cnt"))
    return weighted_quantiles(counts, [*by, "column_name"], "v", "cnt", probs)
