"""Hard negatives of labelled vectors by a secondary sort of packed pair scores."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from assay.session import materialise

ANCHORS = 8192  # anchors of a cell
CANDIDATES = 16384  # rows of a cell that are scored against them
STRIP = 512  # anchors scored at a time
LEAST = np.iinfo(np.int64).min
_KEY = struct.Struct(">QQBQ")
_BIAS = 1 << 63
_TOP = (1 << 64) - 1


def pack_key(anchor: int, score: int, is_negative: int, row: int) -> bytes:
    """Bytes that sort by anchor, then descending score, positives first, then id."""
    return _KEY.pack(anchor + _BIAS, _TOP - (score + _BIAS), is_negative, row + _BIAS)


def unpack_key(key: bytes) -> tuple[int, int, int, int]:
    anchor, inverse, is_negative, row = _KEY.unpack(key)
    return anchor - _BIAS, _TOP - inverse - _BIAS, is_negative, row - _BIAS


def whole_rows(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(id, label, width, v): vectors as packed whole numbers floor(scale * x), unusable rows left out."""
    x = F.col(vector_col)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull()).filter(~bad)
    rows = rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
        F.transform(x, lambda e: F.floor(e.cast("double") * scale)).alias("v"),
    )

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            arrays = [np.asarray(v, np.int64) for v in batch["v"]]
            batch["width"] = np.array([len(v) for v in arrays], np.int32)
            small = [len(v) and max(v.max(), -v.min()) < 1 << 15 for v in arrays]
            batch["v"] = [(v.astype(np.int16) if s else v).tobytes() for v, s in zip(arrays, small)]
            yield batch[["id", "label", "width", "v"]]

    return rows.mapInPandas(pack, "id long, label string, width int, v binary")


def matrix(packed, width: int) -> np.ndarray:
    rows = [np.frombuffer(p, np.int16 if len(p) == 2 * width else np.int64) for p in packed]
    return np.stack(rows).astype(np.int64)


def whole_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of whole-number rows: in doubles where these are exact, else in 64-bit integers."""
    if float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * left.shape[1] < 1 << 53:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    return left @ right.T


class Best:
    """The first k rows of every slot by descending score, then id, over any number of batches."""

    def __init__(self, slots: int, k: int) -> None:
        self.k, self.floor = k, np.full(slots, LEAST)
        self.rows = [np.zeros(0, np.int64)] * 4  # slot, score, id, place of the row
        self.new: list[tuple[np.ndarray, ...]] = []

    def add(self, slots: np.ndarray, scores: np.ndarray, ok: np.ndarray, ids: np.ndarray, first: int) -> None:
        """Offer ``scores`` (a row per slot, a column per id) where ``ok``; ``first`` is the first column's place."""
        ok = ok & (scores >= self.floor[slots][:, None])
        k, m = self.k, scores.shape[1]
        if m > k and np.count_nonzero(ok) > 4 * k * len(slots):
            kth = np.partition(np.where(ok, scores, LEAST), m - k, 1)[:, m - k]
            ok &= scores >= kth[:, None]
        r, c = np.nonzero(ok)
        if len(r):
            self.new.append((slots[r], scores[r, c], ids[c], c + first))

    def settle(self) -> None:
        """Keep the first k of each slot and raise its floor."""
        if not self.new:
            return
        rows = [np.concatenate(x) for x in zip(self.rows, *self.new)]
        self.new = []
        order = np.lexsort((rows[3], rows[2], -rows[1], rows[0]))
        slot = rows[0][order]
        start = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
        place = np.arange(len(slot)) - np.repeat(start, np.diff(np.append(start, len(slot))))
        self.rows = [x[order[place < self.k]] for x in rows]
        full = order[place == self.k - 1]
        self.floor[rows[0][full]] = rows[1][full]


def _cells(anchors: DataFrame, rows: DataFrame, group: list[str]) -> DataFrame:
    """Anchors (side 0) and rows (side 1) of each group dealt into cells of bounded size, sorted by cell and side.

    A group with n rows and a anchors has n / CANDIDATES by a / ANCHORS cells, so a hot group is split.
    """
    shape = rows.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / CANDIDATES).cast("int").alias("n_s"))
    asked = anchors.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / ANCHORS).cast("int").alias("n_q"))
    shape = materialise(shape.join(asked, group))
    spot = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = anchors.join(shape, group).select(*group, spot("n_q").alias("q"), every("n_s").alias("s"), F.lit(0).alias("side"), "id", F.col("label").alias("own"), "v", "near")
    right = rows.join(shape, group).select(
        *group, every("n_q").alias("q"), spot("n_s").alias("s"), F.lit(1).alias("side"), "id", F.col("label").alias("own"), "v",
        F.lit(None).cast("array<long>").alias("near"),
    )
    key = [*group, "q", "s"]
    dealt = left.unionByName(right).repartition(*key).sortWithinPartitions(*key, "side")
    return dealt.select(F.concat_ws("/", "q", "s", *[F.col(g) for g in group]).alias("cell"), "width", "side", "id", "own", "v", "near")


class _Strip:
    """Up to STRIP anchors of a cell with what they keep."""

    def __init__(self, rows: pd.DataFrame, width: int, k: int, low: int | None, high: int | None) -> None:
        self.ids, self.own, self.vectors = rows["id"].to_numpy(), rows["own"].to_numpy(), matrix(rows["v"], width)
        self.windows: list[tuple[np.ndarray, np.ndarray]] = []
        if low is not None:
            near = [np.asarray(n, np.int64) for n in rows["near"]]
            for w in range(max(map(len, near), default=0)):
                score = np.array([n[w] if w < len(n) else 0 for n in near])
                given = np.array([w < len(n) for n in near])
                self.windows.append((np.where(given, -((-low * score) // 100), 1), np.where(given, (high * score) // 100, 0)))
        self.best = Best(len(rows) * max(1, len(self.windows)), k)

    def read(self, ids: np.ndarray, own: np.ndarray, vectors: np.ndarray, first: int) -> None:
        scores = whole_products(self.vectors, vectors)
        other, slots = self.ids[:, None] != ids[None, :], np.arange(len(self.ids))
        same = self.own[:, None] == own[None, :]
        if not self.windows:
            self.best.add(slots, scores, other & same, ids, first)
        for w, (least, most) in enumerate(self.windows):
            inside = other & ~same & (scores >= least[:, None]) & (scores <= most[:, None])
            self.best.add(slots + w * len(slots), scores, inside, ids, first)
        self.best.settle()

    def kept(self) -> pd.DataFrame:
        slot, score, ids, place = self.best.rows
        anchor = slot % max(1, len(self.ids))
        _, one = np.unique(np.stack([anchor, place]), axis=1, return_index=True)
        return pd.DataFrame({"anchor": self.ids[anchor[one]], "score": score[one], "id": ids[one]})


def _scan(cells: DataFrame, k: int, low: int | None = None, high: int | None = None) -> DataFrame:
    """(anchor, score, id): of each cell, the best k rows of an anchor's label, or of each of its score windows."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, held, strips, read = None, [], [], 0
        for batch in batches:
            if not len(batch):
                continue
            codes = batch["cell"].to_numpy()
            for part in np.split(batch, np.flatnonzero(codes[1:] != codes[:-1]) + 1):
                if part["cell"].iloc[0] != cell:
                    for strip in strips:
                        yield strip.kept()
                    cell, held, strips, read = part["cell"].iloc[0], [], [], 0
                width = int(part["width"].iloc[0])
                anchors, rows = part[part["side"] == 0], part[part["side"] == 1]
                if len(anchors):
                    held.append(anchors)
                if not len(rows):
                    continue
                if held:
                    every = pd.concat(held, ignore_index=True)
                    strips = [_Strip(every.iloc[a : a + STRIP], width, k, low, high) for a in range(0, len(every), STRIP)]
                    held = []
                vectors = matrix(rows["v"], width)
                for strip in strips:
                    strip.read(rows["id"].to_numpy(), rows["own"].to_numpy(), vectors, read)
                read += len(rows)
        for strip in strips:
            yield strip.kept()

    return cells.mapInPandas(work, "anchor long, score long, id long")


def hard_negatives(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256, every: int = 100,
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor.

    Anchors are the rows whose id is divisible by ``every``. Scores are inner products of floor(scale * x);
    higher ones come first, ties by smaller id. An anchor's positives are its first ``positives`` other rows of
    its label. Each is followed by the first ``negatives`` rows of other labels whose score lies between
    ``low`` and ``high`` percent of the positive's; all, if there are fewer. A positive with a negative score has an
    empty window.

    Two scans keep the pairs that can be needed: of each cell of bounded size the best rows of the anchor's
    label, then, once the positives are known, the best rows inside each positive's window. Those pair scores
    are packed into keys (anchor, descending score, id), dealt by anchor and sorted within partitions; an
    iterator opens a window at each positive it reads and gives out negatives while they are inside, so it
    holds a few windows and never an anchor's pairs. An anchor gets at most positives * negatives pairs a cell.

    Rows with a null id, label or vector, or null or non-finite parts, take no part; vectors of different
    lengths do not meet. Rows that repeat an id are each a candidate of others, never of an anchor with their
    own id; a repeated anchor asks once, with its least label and vector. Other columns are ignored; an empty
    table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = materialise(whole_rows(vectors, id_col, vector_col, label_col, scale))
    least = F.min(F.struct("label", "width", "v")).alias("r")
    asking = rows.filter(F.col("id") % every == 0).groupBy("id").agg(least).select("id", "r.*")
    nothing = F.lit(None).cast("array<long>").alias("near")
    found = _scan(_cells(asking.select("*", nothing), rows, ["width", "label"]), positives)
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "id"))
    chosen = materialise(found.withColumn("n", place).filter(F.col("n") <= positives).drop("n"))
    near = chosen.groupBy(F.col("anchor").alias("id")).agg(F.collect_list("score").alias("near"))
    others = _scan(_cells(asking.join(near, "id"), rows, ["width"]), negatives, low, high)
    pairs = materialise(chosen.select("*", F.lit(0).alias("other")).union(others.select("*", F.lit(1))))

    keys = pairs.rdd.map(lambda r: (pack_key(r[0], r[1], r[3], r[2]), None))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = keys.repartitionAndSortWithinPartitions(n, lambda key: zlib.crc32(key[:8]))

    def mine(part) -> Iterator[tuple]:
        anchor, windows = None, []
        for key, _ in part:
            now, score, is_negative, row = unpack_key(key)
            if now != anchor:
                anchor, windows = now, []
            if not is_negative:
                windows.append([row, score, 0])
                continue
            for window in windows:
                positive, best, given = window
                if given < negatives and low * best <= 100 * score <= high * best:
                    window[2] += 1
                    yield anchor, positive, given + 1, row, best, score

    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return spark.createDataFrame(dealt.mapPartitions(mine), schema)
