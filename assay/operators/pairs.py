"""Pairwise-complete Pearson correlation of many columns from blocked products of values and presence."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from assay import thresholds as th
from assay.functions import values as fv
from assay.functions.tails import pearson_p_value
from assay.operators.counts import KEY, TableInfo

BLOCK = 32  # columns a side of one shuffled block: 7 x 32 x 32 doubles, 57 KB
SCAN_COLUMNS = 512  # columns a side of what one scan sums: a multiple of BLOCK; a task holds 15 MB of sums for them
ROWS = 4096  # rows multiplied at a time
LANES = 64  # partial sums of large datasets meet in so many groups first, then these meet
VALUE_PARTS = 512  # tasks whose few values of a dataset meet as one
DOUBT = 1e-6  # spread left over of the squares, below which a pair is summed from its own rows

# Planes of a stack of sums over the rows that hold both columns of a pair, first column down, second across.
N, ODD, MEAN_X, MEAN_Y, SPREAD_X, SPREAD_Y, JOINT = range(7)


def correlation_pairs(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Every column pair of every dataset: (dataset_id, col_a, col_b, corr, n_pairs, abs_corr).

    A row counts for a pair where both sides are present. Tasks multiply value and presence matrices, a few
    thousand rows at a time, and hand on one row of sums per dataset and block of columns, whatever the number
    of rows; where a task holds so few rows of a dataset that their values are smaller than the sums, it hands on
    the values, so what is shuffled never outgrows the input. Sums meet in LANES groups, then as one. Up to
    SCAN_COLUMNS columns take one scan. corr is null
    where a side does not vary over the pair's rows and NaN where it holds an infinity or its squares overflow; pairs without a common
    row are left out, so an empty table or fewer than two columns give no rows.
    """
    info = TableInfo.of(df)
    families = dict(zip(info.columns, info.families))
    names = list(columns or [c for c in info.columns if families[c] in (fv.LONG, fv.DOUBLE)])
    schema = f"{KEY} string, i int, j int, corr double, odd boolean, n_pairs long"
    out = df.sparkSession.createDataFrame([], schema)
    if len(names) > 1:
        numbers = df.select(
            F.col(KEY).cast("string").alias(KEY), *[fv.to_number(F.col(f"`{c}`"), families[c]).alias(f"x{i}") for i, c in enumerate(names)]
        ).sortWithinPartitions(KEY)  # one dataset's sums are held at a time; nothing is sorted for a single table
        sums = None
        for a in range(0, len(names), SCAN_COLUMNS):
            for b in range(a, len(names), SCAN_COLUMNS):
                part = _partial_sums(numbers, _upto(a, len(names)), _upto(b, len(names)))
                sums = part if sums is None else sums.unionByName(part)
        met = sums.groupBy(KEY, "lane", "a", "b").applyInArrow(_meet, sums.schema)
        out = met.groupBy(KEY, "a", "b").applyInArrow(_correlated, schema)
    name_at = lambda i: F.element_at(F.array(*[F.lit(c) for c in names or [""]]), F.col(i) + 1)
    corr = F.when(F.col("odd"), F.lit(float("nan"))).otherwise(F.col("corr"))
    out = out.select(KEY, name_at("i").alias("col_a"), name_at("j").alias("col_b"), corr.alias("corr"), "n_pairs")
    return out.withColumn("abs_corr", F.abs("corr"))


def _upto(start: int, end: int) -> list[int]:
    return list(range(start, min(start + SCAN_COLUMNS, end)))


def _partial_sums(numbers: DataFrame, left: list[int], right: list[int]) -> DataFrame:
    """(dataset_id, lane, a, b, sums, rows): per task, dataset and block of the columns ``left`` x ``right`` one row of sums, or of the few values."""
    wanted = left if left == right else left + right
    w = len(left)
    # More rows than this take more room than the sums of a whole block, and so does each of its blocks.
    few = _few(min(w, BLOCK), min(len(right), BLOCK))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        key: str | None = None
        held: np.ndarray | None = None
        loose: list[np.ndarray] = []  # values of the dataset at hand that are not in ``held``, gaps as NaN
        out: list[tuple] = []

        def added() -> np.ndarray | None:
            """``held`` with the loose values."""
            total = held
            if loose:
                v = np.concatenate(loose)
                for s in range(0, len(v), ROWS):
                    now = _sums_of(v[s : s + ROWS, :w], v[s : s + ROWS] if left == right else v[s : s + ROWS, w:])
                    total = now if total is None else merged(total, now)
            return total

        def close() -> None:
            values = None if held is not None else np.concatenate(loose)
            total = None if values is not None and len(values) <= few else added()
            for i in range(0, w, BLOCK):
                for j in range(i if left == right else 0, len(right), BLOCK):
                    at = (left[0] + i) // BLOCK, (right[0] + j) // BLOCK
                    if total is None:
                        x = values[:, i : i + BLOCK]
                        y = x if at[0] == at[1] else values[:, (0 if left == right else w) + j :][:, :BLOCK]
                        some = x if y is x else np.concatenate([x, y], axis=1)
                        out.append((key, -1 - task // VALUE_PARTS, *at, np.ascontiguousarray(some).tobytes(), len(values)))
                    else:
                        out.append((key, task % LANES, *at, np.ascontiguousarray(total[:, i : i + BLOCK, j : j + BLOCK]).tobytes(), 0))

        def handed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SUMS)], schema=_SUMS)
            out.clear()
            return batch

        for batch in batches:
            if not batch.num_rows:
                continue
            codes = batch.column(0).dictionary_encode(null_encoding="encode")
            spots = codes.indices.to_numpy()
            names = codes.dictionary.to_pylist()
            # to_number() leaves no NaN among the values, so NaN can stand for a gap.
            values = np.stack([c.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False) for c in batch.columns[1:]], axis=1)
            cuts = np.flatnonzero(np.diff(spots)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(spots)]):
                now = names[spots[lo]]
                if now != key and (held is not None or loose):
                    close()
                    held, loose = None, []
                key = now
                loose.append(values[lo:hi])
                if sum(map(len, loose)) >= ROWS:
                    held, loose = added(), []
            # The rest of a batch must not keep it whole while the dataset goes on.
            loose = [v.copy() for v in loose]
            if out:
                yield handed()
        if held is not None or loose:
            close()
        if out:
            yield handed()

    return numbers.select(KEY, *[f"x{i}" for i in wanted]).mapInArrow(work, f"{KEY} string, lane int, a int, b int, sums binary, rows int")


def _few(w: int, v: int) -> int:
    """So many rows of values take no more room than the sums of a block of w x v columns."""
    return 7 * w * v // (w + v)


_SUMS = pa.schema([
    (KEY, pa.string()), ("lane", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("sums", pa.binary()), ("rows", pa.int32())])


def _sums_of(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sums of every pair of columns of two tables of values with gaps as NaN."""
    return pair_sums(x, ~np.isnan(x), y, ~np.isnan(y))


def pair_sums(x: np.ndarray, there_x: np.ndarray, y: np.ndarray, there_y: np.ndarray) -> np.ndarray:
    """Sums of every pair of a column of ``x`` and one of ``y`` over the rows where both are there.

    Columns are centred at their means first. Where that leaves little of a pair's squares, as with a column
    that hardly varies where the other is present, the pair is summed from its own rows, so that one that does
    not vary has a spread of zero and its very value as mean.
    """
    use_x, use_y = there_x & np.isfinite(x), there_y & np.isfinite(y)
    in_x, in_y = use_x.astype(float), use_y.astype(float)
    raw_x, raw_y = np.where(use_x, x, 0.0), np.where(use_y, y, 0.0)
    with np.errstate(over="ignore", invalid="ignore"):
        mid_x, mid_y = raw_x.sum(0) / np.maximum(in_x.sum(0), 1), raw_y.sum(0) / np.maximum(in_y.sum(0), 1)
        dx, dy = np.where(use_x, x - mid_x, 0.0), np.where(use_y, y - mid_y, 0.0)
        out = np.empty((7, x.shape[1], y.shape[1]))
        m = in_x.T @ in_y
        out[N] = there_x.astype(float).T @ there_y.astype(float)
        out[ODD] = out[N] - m
        size = np.maximum(m, 1)
        sum_x, sum_y, sq_x, sq_y = dx.T @ in_y, in_x.T @ dy, (dx * dx).T @ in_y, in_x.T @ (dy * dy)
        one = m == 1
        out[MEAN_X] = np.where(one, raw_x.T @ in_y, mid_x[:, None] + sum_x / size)
        out[MEAN_Y] = np.where(one, in_x.T @ raw_y, mid_y[None, :] + sum_y / size)
        out[SPREAD_X] = sq_x - sum_x * (sum_x / size)
        out[SPREAD_Y] = sq_y - sum_y * (sum_y / size)
        out[JOINT] = dx.T @ dy - sum_x * (sum_y / size)
        out[SPREAD_X : JOINT + 1, m <= 1] = 0.0
        low_x, low_y = (m > 1) & ~(out[SPREAD_X] > DOUBT * sq_x), (m > 1) & ~(out[SPREAD_Y] > DOUBT * sq_y)
        flat_x = _flat(x, use_x, use_y, low_x, out[MEAN_X])
        flat_y = _flat(y, use_y, use_x, low_y.T, out[MEAN_Y].T).T
        out[SPREAD_X, flat_x] = 0.0
        out[SPREAD_Y, flat_y] = 0.0
        for i, j in zip(*np.nonzero((low_x & ~flat_x) | (low_y & ~flat_y))):
            both = use_x[:, i] & use_y[:, j]
            for plane, own, flat in ((MEAN_X, x[both, i], flat_x), (MEAN_Y, y[both, j], flat_y)):
                if not flat[i, j]:
                    out[plane, i, j] = own.mean()
                    out[plane + 2, i, j] = np.sum((own - own.mean()) ** 2)
            out[JOINT, i, j] = np.sum((x[both, i] - out[MEAN_X, i, j]) * (y[both, j] - out[MEAN_Y, i, j]))
        out[JOINT, flat_x | flat_y] = 0.0
    return out


def _flat(x: np.ndarray, use: np.ndarray, other: np.ndarray, doubt: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Which doubtful pairs' own side holds one value only; that value becomes their mean."""
    flat = np.zeros(doubt.shape, bool)
    for i in np.flatnonzero(doubt.any(1)):
        js = np.flatnonzero(doubt[i])
        both = use[:, [i]] & other[:, js]
        low = np.where(both, x[:, [i]], np.inf).min(0)
        same = low == np.where(both, x[:, [i]], -np.inf).max(0)
        flat[i, js[same]] = True
        mean[i, js[same]] = low[same]
    return flat


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums of two sets of rows from the sums of each; equal means stay exactly equal."""
    size_a, size_b = a[N] - a[ODD], b[N] - b[ODD]
    size = np.maximum(size_a + size_b, 1)
    out = a + b
    with np.errstate(over="ignore", invalid="ignore"):
        share = size_a * size_b / size
        shift_x, shift_y = b[MEAN_X] - a[MEAN_X], b[MEAN_Y] - a[MEAN_Y]
        for plane, shift in ((MEAN_X, shift_x), (MEAN_Y, shift_y)):
            out[plane] = np.where(size_a == 0, b[plane], np.where(size_b == 0, a[plane], a[plane] + shift * (size_b / size)))
        both = share > 0
        out[SPREAD_X, both] += (shift_x * shift_x * share)[both]
        out[SPREAD_Y, both] += (shift_y * shift_y * share)[both]
        out[JOINT, both] += (shift_x * shift_y * share)[both]
    return out


def _together(group: pa.Table) -> np.ndarray:
    """Sums of one block from its parts: sums, or values of so many rows."""
    same = group["a"][0].as_py() == group["b"][0].as_py()
    total, few = None, []
    for raw, rows in zip(group["sums"].to_pylist(), group["rows"].to_pylist()):
        part = np.frombuffer(raw)
        if rows:
            few.append(part.reshape(rows, -1))
        else:
            total = part.reshape(7, -1) if total is None else merged(total, part.reshape(7, -1))
    values = np.concatenate(few) if few else np.empty((0, 0))
    for s in range(0, len(values), ROWS):
        v = values[s : s + ROWS]
        # Of two different blocks the first is never a narrow one.
        part = (_sums_of(v, v) if same else _sums_of(v[:, :BLOCK], v[:, BLOCK:])).reshape(7, -1)
        total = part if total is None else merged(total, part)
    return total


def _meet(group: pa.Table) -> pa.Table:
    if group.num_rows == 1:
        return group
    met = {KEY: group[KEY][0].as_py(), "lane": group["lane"][0].as_py(), "a": group["a"][0].as_py(), "b": group["b"][0].as_py()}
    return pa.Table.from_pylist([{**met, "sums": _together(group).tobytes(), "rows": 0}], _SUMS)


_PAIRS = pa.schema([
    (KEY, pa.string()), ("i", pa.int32()), ("j", pa.int32()), ("corr", pa.float64()), ("odd", pa.bool_()), ("n_pairs", pa.int64())])


def _correlated(group: pa.Table) -> pa.Table:
    """The pairs of one block, first column before second, that share a row."""
    a, b, key = (group[c][0].as_py() for c in ("a", "b", KEY))
    total = _together(group)
    # Only the last block of all is narrower, and it is never the first of two different blocks.
    across = total.shape[1] // BLOCK if a != b else int(round(total.shape[1] ** 0.5))
    i, j = np.divmod(np.arange(total.shape[1]), across)
    i, j = i + a * BLOCK, j + b * BLOCK
    keep = (i < j) & (total[N] > 0)
    total, i, j = total[:, keep], i[keep], j[keep]
    with np.errstate(over="ignore", invalid="ignore"):
        spread = total[SPREAD_X] * total[SPREAD_Y]
    odd = (total[ODD] > 0) | ~np.isfinite(spread)
    plain = ~odd & (spread != 0)
    corr = total[JOINT] / np.sqrt(np.where(plain, spread, 1.0))
    columns = [[key] * len(i), i, j, pa.array(corr, mask=~plain), odd, total[N].astype(np.int64)]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PAIRS)], schema=_PAIRS)


def with_p_value(pairs: DataFrame) -> DataFrame:
    """Two-sided p-value of each correlation; null unless three pairs and both sides vary."""
    usable = (F.col("n_pairs") >= 3) & F.col("corr").isNotNull()
    return pairs.withColumn(
        "p_value", F.when(usable, pearson_p_value(F.col("corr"), F.col("n_pairs").cast("double")))
    )


def strongest_pairs(
    pairs: DataFrame, kinds: DataFrame, min_abs_corr: float = 0.0, top: int | None = th.CORR_TOP
) -> DataFrame:
    """Numeric-kind pairs at or above the bound, strongest first; ``top`` of them per dataset, or all."""
    numeric = kinds.where(F.col("kind").isin("ordinal", "continuous")).select(KEY, "column_name", "pos")
    side = lambda s: numeric.select(
        KEY, F.col("column_name").alias(f"col_{s}"), F.col("pos").alias(f"pos_{s}")
    )
    kept = (
        pairs.where(F.col("corr").isNotNull() & ~F.isnan("corr") & (F.col("abs_corr") >= min_abs_corr))
        .join(side("a"), [KEY, "col_a"])
        .join(side("b"), [KEY, "col_b"])
    )
    shown = Window.partitionBy(KEY).orderBy(F.round("abs_corr", 4).desc(), "pos_a", "pos_b")
    ranked = kept.withColumn("rank", F.row_number().over(shown))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select(KEY, "rank", "col_a", "col_b", "corr", "abs_corr", "n_pairs")


def correlation_matrix(pairs: DataFrame, columns: list[str]) -> DataFrame:
    """Square matrix, one row per column: both triangles plus the diagonal, then one pivot."""
    flipped = pairs.select(KEY, F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "corr")
    both = pairs.select(KEY, "col_a", "col_b", "corr").unionByName(flipped)
    own = F.array(*[F.struct(F.lit(c).alias("col_a"), F.lit(c).alias("col_b")) for c in columns])
    ones = pairs.select(KEY).distinct().select(KEY, F.inline(own)).withColumn("corr", F.lit(1.0))
    return (
        both.unionByName(ones)
        .groupBy(KEY, "col_a")
        .pivot("col_b", columns)
        .agg(F.first("corr", ignorenulls=True))
    )
