"""Benchmark decontamination by greedy string tiling of shared token runs."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from assay.llm.words import as_bytes, byte_runs, grams, runs, word_hashes
from assay.session import materialise

MIN_MATCH = 5  # tokens of the shortest tile
BROADCAST_TOKENS = 2_000_000  # benchmark tokens that may be sent to every task: 16 MB
_U = np.uint64

# Tokens are runs of ASCII letters and digits and of any non-ASCII characters; case is folded for A-Z. Characters of
# scripts that are written without spaces (Thai, Lao, Burmese, Khmer, kana, Han) are a token each.
_UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")
_BETWEEN = np.ones(256, bool)
_BETWEEN[128:] = False
for _first, _last in ((48, 58), (65, 91), (97, 123)):
    _BETWEEN[_first:_last] = False


def spaced(texts) -> list[str | None]:
    """The texts with spaces around each character of an unspaced script."""
    return [t if not isinstance(t, str) or t.isascii() else _UNSPACED.sub(r" \1 ", t) for t in texts]


def tokens(raws: list[bytes]) -> list[np.ndarray]:
    """Token hashes of each text."""
    out: list[np.ndarray] = []
    for a, b in runs(raws):
        hashes, first, _, _ = word_hashes(raws[a:b], _BETWEEN)
        out += [hashes[x:y] for x, y in zip(first[:-1].tolist(), first[1:].tolist())]
    return out


def tile(item: np.ndarray, text: np.ndarray, least: int = MIN_MATCH) -> tuple[int, int]:
    """(covered item tokens, tiles) of a greedy string tiling of two token sequences.

    The longest match of unmarked tokens is marked first, then the next longest, down to ``least`` tokens;
    of equal ones, the first in the item.
    Windows of a length are compared by running Karp-Rabin values; the longest length that still matches
    is found by bisection, as every part of a match is a match.
    """
    free_i, free_t = np.ones(len(item), bool), np.ones(len(text), bool)
    value_i, value_t = _running(item), _running(text)
    top, tiles = min(len(item), len(text)), 0

    def meet(n: int) -> tuple[np.ndarray, np.ndarray]:
        at_i, at_t = _open(free_i, n), _open(free_t, n)
        _, x, y = np.intersect1d(value_i(at_i, n), value_t(at_t, n), return_indices=True)
        order = np.argsort(at_i[x])
        return at_i[x][order], at_t[y][order]

    while top >= least:
        low, high = least - 1, top
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if len(meet(mid)[0]) else (low, mid - 1)
        top = low
        if top < least:
            break
        before = tiles
        for i, t in zip(*meet(top)):
            if free_i[i : i + top].all() and free_t[t : t + top].all() and (item[i : i + top] == text[t : t + top]).all():
                free_i[i : i + top] = False
                free_t[t : t + top] = False
                tiles += 1
        if tiles == before:  # equal values, different tokens
            top -= 1
    return int((~free_i).sum()), tiles


def _running(seq: np.ndarray):
    """Running polynomial values: a function from window starts and a length to the windows' values."""
    base = np.full(len(seq) + 1, 0x9E3779B97F4A7C15, np.uint64)
    base[0] = 1
    power = base.cumprod(dtype=np.uint64)
    inverse = np.full(len(seq) + 1, pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    inverse = inverse.cumprod(dtype=np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(seq * power[: len(seq)], dtype=np.uint64)])
    return lambda at, n: (total[at + n] - total[at]) * inverse[at]


def _open(free: np.ndarray, n: int) -> np.ndarray:
    """Starts of windows of n unmarked tokens."""
    if len(free) < n:
        return np.zeros(0, np.int64)
    before = np.concatenate([[0], np.cumsum(free)])
    return np.flatnonzero(before[n:] - before[:-n] == n)


@dataclass
class Benchmark:
    """Items with their seeds: sorted hashes of every run of ``least`` tokens, with item and place."""

    ids: list
    items: list[np.ndarray]
    least: int

    def __post_init__(self) -> None:
        seeds = [grams(t, self.least) for t in self.items]
        flat = np.concatenate([*seeds, np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(seeds)), [len(s) for s in seeds])
        place = np.concatenate([*[np.arange(len(s)) for s in seeds], np.zeros(0, np.int64)]).astype(int)
        order = np.argsort(flat, kind="stable")
        self.seeds, self.owner, self.place = flat[order], owner[order], place[order]
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.seeds & _U(0xFFFF)).astype(int)] = True

    def compare(self, text: np.ndarray, share: float, text_grams: np.ndarray | None = None) -> Iterator[tuple[int, int, int]]:
        """(item index, covered tokens, tiles) of each item that the tokens of a text cover to ``share`` or more."""
        seen = grams(text, self.least) if text_grams is None else text_grams
        at = np.flatnonzero(self.maybe[(seen & _U(0xFFFF)).astype(int)])
        lo = np.searchsorted(self.seeds, seen[at], "left")
        hi = np.searchsorted(self.seeds, seen[at], "right")
        at, lo, hi = at[hi > lo], lo[hi > lo], hi[hi > lo]
        if not len(at):
            return
        # Tokens outside shared runs can be in no tile: keep the runs, with one odd token between them.
        inside = np.zeros(len(text), bool)
        for j in range(self.least):
            inside[at + j] = True
        border = inside & ~np.concatenate([[False], inside[:-1]])
        kept = np.insert(text[inside], np.flatnonzero(border[inside]), _U(0x0123456789ABCDEF))
        hit = np.unique(np.concatenate([np.arange(a, b) for a, b in set(zip(lo.tolist(), hi.tolist()))]))
        for k in np.unique(self.owner[hit]):
            item = self.items[k]
            reach = np.zeros(len(item), bool)
            for j in range(self.least):
                reach[self.place[hit[self.owner[hit] == k]] + j] = True
            if reach.sum() < share * len(item):
                continue
            covered, n = tile(item, kept, self.least)
            if covered >= share * len(item):
                yield int(k), covered, n


def by_length(ids: list, items: list[np.ndarray], least: int) -> list[Benchmark]:
    """Items of ``least`` tokens or more, and those of each smaller length, which match as a whole; none of no tokens."""
    out = []
    for n in range(1, least + 1):
        own = [k for k, t in enumerate(items) if len(t) == n or n == least <= len(t)]
        if own:
            out.append(Benchmark([ids[k] for k in own], [items[k] for k in own], n))
    return out


def row_key(ident: Column, text: Column) -> Column:
    """Digest of a row's id, null or not, and text; null for a null text."""
    ident = ident.cast("string")
    return F.md5(F.concat(F.coalesce(F.length(ident).cast("string"), F.lit("null")), F.lit(":"), F.coalesce(ident, F.lit("")), text))


OUT = "id string, item_id string, item_tokens long, covered_tokens long, n_tiles long, coverage double"


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", share: float = 0.5, least: int = MIN_MATCH, broadcast_tokens: int = BROADCAST_TOKENS,
) -> DataFrame:
    """(id, item id, item_tokens, covered_tokens, n_tiles, coverage) of each leaked benchmark item in each document.

    An item is leaked into a document when tiles of ``least`` or more tokens that both share, found in any
    order, cover ``share`` of the item's tokens. An item of fewer tokens than ``least`` is leaked where all of
    it stands in one run. Null and empty texts match nothing. Ids may be null; a document or item that repeats
    gives its rows once per repeat, and rows that share an id but not the text each count alone. Other columns
    are ignored; an empty table on either side gives an empty result.

    A benchmark of at most ``broadcast_tokens`` tokens, counted first, goes to every task and the documents
    are read in one pass without a shuffle. A larger one is joined to the documents by shared seeds. Both ways
    give the same rows.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("item_id"), F.col(item_text_col).alias("text"))
    pairs_in = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    # A token takes two characters at least, with its gap.
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    out = _by_broadcast(pairs_in, items, share, least) if size / 2 <= broadcast_tokens else _by_join(pairs_in, items, share, least)
    id_kind, item_kind = docs.schema[id_col].dataType, benchmark.schema[item_col].dataType
    return out.select(
        F.col("id").cast(id_kind).alias(id_col), F.col("item_id").cast(item_kind).alias(item_col),
        "item_tokens", "covered_tokens", "n_tiles", "coverage",
    )


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["id", "item_id", "item_tokens", "covered_tokens", "n_tiles", "coverage"])


def _by_broadcast(docs: DataFrame, items: DataFrame, share: float, least: int) -> DataFrame:
    local = items.collect()
    held = docs.sparkSession.sparkContext.broadcast(
        by_length([r.item_id for r in local], tokens(as_bytes(spaced([r.text for r in local]))), least)
    )

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b, raws in byte_runs(spaced(batch["text"])):
                rows = []
                hashes, first, _, _ = word_hashes(raws, _BETWEEN)
                sets = [(bench, grams(hashes, bench.least)) for bench in held.value]
                for key, lo, hi in zip(batch["id"].iloc[a:b], first[:-1].tolist(), first[1:].tolist()):
                    for bench, all_grams in sets:
                        if hi - lo >= bench.least:
                            for k, covered, n in bench.compare(hashes[lo:hi], share, all_grams[lo : hi - bench.least + 1]):
                                size = len(bench.items[k])
                                rows.append((key, bench.ids[k], size, covered, n, covered / size))
                yield _frame(rows)

    return docs.mapInPandas(work, OUT)


def _by_join(docs: DataFrame, items: DataFrame, share: float, least: int) -> DataFrame:
    def lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = {min(least, len(seq)) for seq in tokens(as_bytes(spaced(batch["text"])))} - {0}
            yield pd.DataFrame({"n": sorted(found)}, dtype="int64")

    def seeds(batches: Iterator[pd.DataFrame], whole: bool) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, seq in zip(batch["key"], tokens(as_bytes(spaced(batch["text"])))):
                for n in used if whole else [min(least, len(seq))]:
                    found = np.unique(grams(seq, n)) if n else grams(seq[:0], 1)
                    if len(found):
                        yield pd.DataFrame({"key": [key] * len(found), "n": [n] * len(found), "seed": found.view(np.int64)})

    def cover(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, item, text, item_text in zip(batch["id"], batch["item_id"], batch["text"], batch["item_text"]):
                for bench in by_length([item], tokens(as_bytes(spaced([item_text]))), least):
                    for _, covered, n in bench.compare(tokens(as_bytes(spaced([text])))[0], share):
                        size = len(bench.items[0])
                        rows.append((key, item, size, covered, n, covered / size))
            yield _frame(rows)

    docs = docs.select(row_key(F.col("id"), F.col("text")).alias("key"), "id", "text").filter("key is not null")
    items = items.select(row_key(F.col("item_id"), F.col("text")).alias("item_key"), "item_id", F.col("text").alias("item_text")).filter("item_key is not null")
    # Seeds of documents are as long as some item needs: of ``least`` tokens, or of a short item's length.
    used = [r.n for r in items.select(F.col("item_text").alias("text")).mapInPandas(lengths, "n long").distinct().collect()]
    kind = "key string, n long, seed long"
    of_docs = docs.select("key", "text").mapInPandas(lambda batches: seeds(batches, True), kind)
    of_items = items.select(F.col("item_key").alias("key"), F.col("item_text").alias("text")).mapInPandas(lambda batches: seeds(batches, False), kind)
    pairs = materialise(of_docs.join(of_items.withColumnRenamed("key", "item_key"), ["n", "seed"]).select("key", "item_key").distinct())
    # Rows of equal id and text share a key; each of them meets the pair.
    both = pairs.join(docs, "key").join(items, "item_key")
    return both.select("id", "item_id", "text", "item_text").mapInPandas(cover, OUT)
