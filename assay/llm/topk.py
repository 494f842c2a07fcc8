"""Exact top-k inner products by reading sorted lists only (no random access), in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from assay.session import materialise

BLOCK_ROWS = 4096  # candidates whose lists are read together
QUERY_ROWS = 1024  # queries of a task
SLICE_BLOCKS = 4  # candidate blocks of a task, read one after the other
DEPTHS = (0.35, 0.5, 0.65, 0.8)  # shares of the lists read before bounds are looked at


class Lists:
    """A block of candidates as one list per dimension, sorted by value, readable from either end."""

    def __init__(self, ids: np.ndarray, values: np.ndarray) -> None:
        self.ids, self.whole, self.values = ids, values.astype(np.int64), values.astype(np.float32)
        # A query may meet its own id so often, and float sums may be off by so little.
        self.own = int(np.unique(ids, return_counts=True)[1].max())
        self.slack = 4e-6 * np.abs(self.values).max(0)
        order = np.argsort(values, 0, kind="stable")
        self.place = np.empty_like(order, dtype=np.int32)
        np.put_along_axis(self.place, order, np.arange(len(ids), dtype=np.int32)[:, None], 0)
        self.sorted = np.take_along_axis(self.values, order, 0)

    def best(self, queries: np.ndarray, k: int, floor: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query row, ids, scores): every candidate that can be among a query's k best or reach its floor.

        A query reads each list from the end that suits the sign of its weight. What has been read of a
        candidate gives its score less an unread rest; the rest lies between the list's far end and the
        reading place. Reading stops for a query when at most a few candidates have an upper bound of the
        k-th best lower bound or more, and those get their final scores. Sums of read parts over all
        queries and candidates of a block are matrix products in single precision, which the bounds allow for;
        final scores are whole-number sums.
        """
        n, keep = len(self.ids), k + self.own
        up, down = np.maximum(queries, 0).astype(np.float32), np.minimum(queries, 0).astype(np.float32)
        open_rows = np.arange(len(queries))
        floor = floor.copy()
        slack = np.abs(queries).astype(np.float32) @ self.slack
        far = up @ self.sorted[0] + down @ self.sorted[-1]
        for share in DEPTHS:
            if not len(open_rows):
                return
            depth = max(1, int(n * share))
            top, low = self.place >= n - depth, self.place < depth
            at_top, at_low = self.sorted[n - depth], self.sorted[depth - 1]
            u, d = up[open_rows], down[open_rows]
            read_top, read_low = np.where(top, self.values, 0), np.where(low, self.values, 0)
            known = u @ read_top.T + d @ read_low.T
            near = (u @ at_top + d @ at_low + slack[open_rows])[:, None]
            upper = known + near - (u * at_top) @ top.T.astype(np.float32) - (d * at_low) @ low.T.astype(np.float32)
            if n >= keep:
                worst_top, worst_low = self.sorted[0], self.sorted[-1]
                lower = known + (far - slack)[open_rows][:, None] - (u * worst_top) @ top.T.astype(np.float32) - (d * worst_low) @ low.T.astype(np.float32)
                floor[open_rows] = np.maximum(floor[open_rows], np.partition(lower, n - keep, 1)[:, n - keep])
            able = upper >= floor[open_rows][:, None]
            counts = able.sum(1)
            done = counts <= max(4 * k, n // 16)
            for row in np.flatnonzero(done):
                yield int(open_rows[row]), *self._final(queries[open_rows[row]], np.flatnonzero(able[row]))
            open_rows = open_rows[~done]
        for row in open_rows:  # the lists are read to their ends
            yield int(row), *self._final(queries[row], np.arange(n))

    def _final(self, query: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.ids[rows], self.whole[rows] @ query.astype(np.int64)


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v): vectors as whole numbers floor(scale * x); those null or with null or non-finite parts are left out."""
    x = F.col(vector_col)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    rows = vectors.filter(F.col(id_col).isNotNull() & x.isNotNull()).filter(~bad)
    return rows.select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda e: F.floor(e.cast("double") * scale)).alias("v"))


def _blocks(rows: DataFrame, count: int, size: int, name: str) -> DataFrame:
    """Rows dealt into about count / size packed blocks: (block, n, ids, values, width)."""
    n = max(1, -(-count // size))
    keyed = rows.withColumn(name, F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        values = np.stack(group["v"].to_numpy()).astype(np.int64)
        small = np.int16 if np.abs(values).max(initial=0) < 1 << 15 else np.int64
        packed = [group["id"].to_numpy().tobytes(), values.astype(small).tobytes(), values.shape[1], np.dtype(small).str]
        return pd.DataFrame([[group[name].iloc[0], *packed]], columns=[name, "ids", "v", "width", "kind"])

    return keyed.groupBy(name, F.size("v").alias("size")).applyInPandas(pack, f"{name} int, ids binary, v binary, width int, kind string")


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, scale: int = 64, every: int = 20) -> DataFrame:
    """(query_id, rank, id, score): for each id divisible by ``every``, its k greatest inner products.

    Scores are integer inner products of floor(scale * x); ties go to the smaller id; all candidates if there
    are fewer than k; a query is never its own candidate. Null ids, null vectors and vectors with null or
    non-finite parts take no part; vectors of different lengths do not meet. Rows that repeat an id are each
    a candidate of other queries; a repeated query asks once, with its least vector. Other columns are
    ignored; an empty table gives an empty result.

    Queries and candidates are packed into blocks of fixed size; each task reads a few candidate blocks in turn
    for one block of queries, carries each query's k best scores as the floor of the next block, and returns
    at most k rows per query. So nothing grows with the table but the number of tasks.
    """
    rows = materialise(whole_vectors(vectors, id_col, vector_col, scale))
    count = rows.count()
    candidates = _blocks(rows, count, BLOCK_ROWS, "c_block")
    asking = rows.filter(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    queries = _blocks(asking, -(-count // every), QUERY_ROWS, "q_block")
    n_c, n_q = max(1, -(-count // BLOCK_ROWS)), max(1, -(-(-(-count // every)) // QUERY_ROWS))
    n_s = -(-n_c // SLICE_BLOCKS)
    key = ["width", "s", "q_block"]
    left = candidates.withColumn("s", F.pmod("c_block", F.lit(n_s)).cast("int")).withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))
    right = queries.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(n_s - 1))))
    cells = left.withColumnsRenamed({"ids": "c_ids", "v": "c_v", "kind": "c_kind"}).join(right.withColumnsRenamed({"ids": "q_ids", "v": "q_v", "kind": "q_kind"}), key)

    def matrix(raw: bytes, kind: str, width: int) -> np.ndarray:
        return np.frombuffer(raw, kind).reshape(-1, width).astype(np.int64)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: tuple | None = None
        floor = np.zeros(0)
        best: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            asked: list[np.ndarray] = []
            answers: list[np.ndarray] = []
            values: list[np.ndarray] = []
            for row in batch.itertuples(index=False):
                here = (row.width, row.s, row.q_block)
                query_ids, queries = np.frombuffer(row.q_ids, np.int64), matrix(row.q_v, row.q_kind, row.width)
                if here != held:  # another cell of this task: the floors start anew
                    held, floor = here, np.full(len(query_ids), -np.inf)
                    best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(query_ids)
                lists = Lists(np.frombuffer(row.c_ids, np.int64), matrix(row.c_v, row.c_kind, row.width))
                for i, ids, scores in lists.best(queries, k, floor):
                    ids, scores = ids[ids != query_ids[i]], scores[ids != query_ids[i]]
                    use = np.flatnonzero(scores >= floor[i])
                    ids, scores = ids[use], scores[use]
                    all_ids, all_scores = np.concatenate([best[i][0], ids]), np.concatenate([best[i][1], scores])
                    order = np.lexsort((all_ids, -all_scores))[:k]
                    best[i] = all_ids[order], all_scores[order]
                    if len(order) == k:
                        floor[i] = best[i][1][-1]
                    new = order[order >= len(all_ids) - len(ids)]
                    asked.append(np.full(len(new), query_ids[i]))
                    answers.append(all_ids[new])
                    values.append(all_scores[new])
            none = [np.zeros(0, np.int64)]
            yield pd.DataFrame({"query_id": np.concatenate(asked + none), "id": np.concatenate(answers + none), "score": np.concatenate(values + none)})

    dealt = cells.select(*key, "c_block", "c_ids", "c_v", "c_kind", "q_ids", "q_v", "q_kind").repartition(*key).sortWithinPartitions(*key, "c_block")
    found = dealt.mapInPandas(work, "query_id long, id long, score long")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
