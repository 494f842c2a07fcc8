"""Phrase collocations: pair tiles of frequency-ranked ids, counted recursively."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from assay.llm.words import byte_runs, mix, word_hashes
from assay.session import materialise

RANKED = 4096  # most frequent units of a level that get ids by rank; any others go by their digest
SIDE = 1024  # ids per side of a tile
DENSE = 1 << 14  # pairs of one batch of texts from which a tile is counted densely
HELD = 1 << 20  # sparse pairs held before equal ones are added up
WORDS = 400_000  # distinct words a task holds
FILTER_BITS = 28  # a filter of frequent units has at most two to this many bits
BLOCK_BITS = 20  # bits of a filter that reach the driver as one row: two to this many
_U = np.uint64

_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?"]] = True
_BREAK[0x0A:0x0E] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Digest of a unit made of two neighbouring (or, above two words, overlapping) units."""
    return mix(left * _U(0x2545F4914F6CDD1D) + mix(right ^ _U(0xD6E8FEB86659FD93)))


class Tokens:
    """Words of a run of texts: ``keys`` of (language, word), ``linked`` where the next word is in the same piece."""

    def __init__(self, raws: list[bytes], langs: np.ndarray) -> None:
        hashes, first, self.begin, self.end = word_hashes(raws, _GAP)
        digest = {x: xxhash.xxh64_intdigest(x) for x in set(langs)}
        of_text = np.array([digest[x] for x in langs], np.uint64)
        self.text = np.repeat(np.arange(len(raws)), np.diff(first))
        self.keys = mix(hashes + of_text[self.text])
        self.joined = (b"\n".join(raws) + b"\n").lower()
        breaks = np.cumsum(_BREAK[np.frombuffer(self.joined, np.uint8)], dtype=np.int64)
        self.linked = np.zeros(len(self.keys), bool)
        if len(self.keys):
            self.linked[:-1] = breaks[self.begin[1:] - 1] == breaks[self.end[:-1] - 1]

    def word(self, i: int) -> str:
        return self.joined[self.begin[i] : self.end[i]].decode("utf-8", "replace")


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))


def _tokens(batch: pd.DataFrame) -> Iterator[tuple[Tokens, np.ndarray]]:
    for lo, hi, raws in byte_runs(batch["text"]):
        langs = batch["lang"].iloc[lo:hi].to_numpy()
        yield Tokens(raws, langs), langs


def word_counts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(key, lang, phrase, a): occurrences of every word of every language, summed in each task first."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, counts, names = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros((0, 2), object)

        def rows() -> pd.DataFrame:
            return pd.DataFrame({"key": keys.view(np.int64), "lang": names[:, 0], "phrase": names[:, 1], "a": counts})

        for batch in batches:
            for tokens, langs in _tokens(batch):
                found, at, n = np.unique(tokens.keys, return_index=True, return_counts=True)
                place = np.minimum(np.searchsorted(keys, found), max(len(keys) - 1, 0))
                old = keys[place] == found if len(keys) else np.zeros(len(found), bool)
                counts[place[old]] += n[old]
                if not old.all():
                    new = np.empty((int((~old).sum()), 2), object)
                    for row, i in enumerate(at[~old].tolist()):
                        new[row] = langs[tokens.text[i]], tokens.word(i)
                    keys, counts, names = np.concatenate([keys, found[~old]]), np.concatenate([counts, n[~old]]), np.concatenate([names, new])
                    order = np.argsort(keys)
                    keys, counts, names = keys[order], counts[order], names[order]
            if len(keys) > WORDS:
                yield rows()
                keys, counts, names = keys[:0], counts[:0], names[:0]
        yield rows()

    found = _texts(docs, text_col, lang_col).mapInPandas(work, "key long, lang string, phrase string, a long")
    return found.groupBy("key", "lang", "phrase").agg(F.sum("a").alias("a"))


class Frequent:
    """The units of one level that are frequent enough, as far as a task needs to know them.

    ``bits`` is a filter of bounded size that never misses one; ``ranked`` are the most frequent ones, sorted
    by key, with their ids by rank in ``ids``.
    """

    def __init__(self, level: DataFrame) -> None:
        n = level.count()
        self.power = min(FILTER_BITS, max(16, int(16 * max(n, 1)).bit_length()))
        mask = (1 << self.power) - 1
        places = F.explode(F.array(F.col("key").bitwiseAND(mask), F.shiftrightunsigned("key", 32).bitwiseAND(mask)))
        words = level.select(places.alias("place")).groupBy(F.shiftright("place", 6).alias("slot")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
        slots = 1 << (min(self.power, BLOCK_BITS) - 6)

        def packed(group: pa.Table) -> pa.Table:
            block, bits = group["block"][0].as_py(), np.zeros(slots, np.uint64)
            bits[group["slot"].to_numpy() % slots] = group["bits"].to_numpy().view(np.uint64)
            return pa.table({"block": pa.array([block], pa.int64()), "bits": pa.array([bits.tobytes()], pa.binary())})

        blocks = words.withColumn("block", F.floor(F.col("slot") / slots)).groupBy("block").applyInArrow(packed, "block long, bits binary")
        self.bits = np.zeros(1 << (self.power - 6), np.uint64)
        for r in materialise(blocks).toLocalIterator():  # the driver holds the filter and some blocks of it, not a row for each slot
            self.bits[r["block"] * slots : (r["block"] + 1) * slots] = np.frombuffer(r["bits"], np.uint64)
        top = level.orderBy(F.desc("a"), "key").limit(RANKED).select("key").toPandas()["key"].to_numpy(np.int64).view(np.uint64)
        self.by_rank, self.ids = top, np.argsort(top)
        self.ranked = top[self.ids]

    def has(self, keys: np.ndarray) -> np.ndarray:
        mask = _U((1 << self.power) - 1)
        out = np.ones(len(keys), bool)
        for place in (keys & mask, (keys >> _U(32)) & mask):
            out &= (self.bits[(place >> _U(6)).astype(np.int64)] >> (place & _U(63))) & _U(1) == 1
        return out

    def rank(self, keys: np.ndarray) -> np.ndarray:
        """Id by frequency rank, or -1."""
        if not len(self.ranked):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.ranked, keys), len(self.ranked) - 1)
        return np.where(self.ranked[at] == keys, self.ids[at], -1)


class Tiles:
    """Counts of unit pairs. Pairs of ranked ids fall into square tiles: full tiles are dense arrays counted
    directly by address, all other pairs are sorted coordinate lists."""

    def __init__(self, units: Frequent) -> None:
        self.units = units
        self.per_side = -(-RANKED // SIDE)
        self.dense: dict[int, np.ndarray] = {}
        self.sparse: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        i, j = self.units.rank(left), self.units.rank(right)
        tile = np.where((i >= 0) & (j >= 0), (i // SIDE) * self.per_side + j // SIDE, -1)
        sizes = np.bincount(tile[tile >= 0], minlength=self.per_side**2)
        for t in np.flatnonzero(sizes >= DENSE).tolist():
            self.dense.setdefault(t, np.zeros(SIDE * SIDE, np.int64))
        rest = np.ones(len(left), bool)
        for t, counts in self.dense.items():
            if sizes[t]:
                mine = tile == t
                counts += np.bincount((i[mine] % SIDE) * SIDE + j[mine] % SIDE, minlength=SIDE * SIDE)
                rest &= ~mine
        self._add_sparse(left[rest], right[rest], np.ones(int(rest.sum()), np.int64))

    def _add_sparse(self, left: np.ndarray, right: np.ndarray, n: np.ndarray) -> None:
        self.sparse.append((left, right, n))
        self.held += len(left)
        if self.held > HELD:
            self._sum_sparse()

    def _sum_sparse(self) -> None:
        left, right, n = (np.concatenate(x) for x in zip(*self.sparse))
        order = np.lexsort((right, left))
        left, right, n = left[order], right[order], n[order]
        start = np.flatnonzero(np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])))[: len(left)]
        summed = np.add.reduceat(n, start) if len(start) else n
        self.sparse, self.held = [(left[start], right[start], summed)], len(start)

    def overfull(self) -> bool:
        return self.held > HELD // 2

    def rows(self, dense: bool) -> Iterator[pd.DataFrame]:
        """What has been counted, handed out and forgotten."""
        if self.sparse:
            self._sum_sparse()
            yield self._frame(*self.sparse[0])
            self.sparse, self.held = [], 0
        for t, counts in self.dense.items() if dense else ():
            cell = np.flatnonzero(counts)
            i, j = t // self.per_side * SIDE + cell // SIDE, t % self.per_side * SIDE + cell % SIDE
            yield self._frame(self.units.by_rank[i], self.units.by_rank[j], counts[cell])

    @staticmethod
    def _frame(left: np.ndarray, right: np.ndarray, n: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"left": left.view(np.int64), "right": right.view(np.int64), "a": n})


def _pair_counts(texts: DataFrame, levels: list, least: int) -> DataFrame:
    """(left, right, key, a) of the frequent pairs of units of the last of ``levels`` (broadcast, one per length)."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        units = [b.value for b in levels]
        tiles = Tiles(units[-1])
        for batch in batches:
            pairs: list[tuple[np.ndarray, np.ndarray]] = []
            for tokens, _ in _tokens(batch):
                keys, good = tokens.keys, tokens.linked  # good: unit i and its right neighbour are in one piece
                fit = units[0].has(keys)
                for longer in units[1:]:
                    both = good[:-1] & fit[:-1] & fit[1:]
                    keys = pair_keys(keys[:-1], keys[1:])
                    fit = np.zeros(len(keys), bool)
                    fit[both] = longer.has(keys[both])
                    good = np.ones(len(keys), bool)  # two overlapping units that fit are in one piece
                if len(keys) > 1:
                    both = np.flatnonzero(good[:-1] & fit[:-1] & fit[1:])
                    pairs.append((keys[both], keys[both + 1]))
            if pairs:
                tiles.add(*(np.concatenate(x) for x in zip(*pairs)))
            if tiles.overfull():
                tiles._sum_sparse()
                if tiles.overfull():
                    yield from tiles.rows(dense=False)
        yield from tiles.rows(dense=True)

    def named(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            left, right = (batch[c].to_numpy(np.int64).view(np.uint64) for c in ("left", "right"))
            yield batch.assign(key=pair_keys(left, right).view(np.int64))[["left", "right", "key", "a"]]

    counted = texts.mapInPandas(work, "left long, right long, a long").groupBy("left", "right").agg(F.sum("a").alias("a"))
    return counted.filter(F.col("a") >= least).mapInPandas(named, "left long, right long, key long, a long")


def _longer(level: DataFrame, pairs: DataFrame) -> DataFrame:
    """Level of one word more: names, and counts of all leading and trailing parts, from the two overlapping parts."""
    first = level.select(F.col("key").alias("left"), "lang", "phrase", "heads")
    second = level.select(F.col("key").alias("right"), "last", "tails")
    both = pairs.join(first, "left").join(second, "right")
    return both.select(
        "key", "left", "right", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "a",
        F.concat("heads", F.array("a")).alias("heads"), F.concat("tails", F.array("a")).alias("tails"),
    )


def _scored(level: DataFrame, words: int) -> DataFrame:
    """Adds l, r and score of the cut that scores least, the earliest of equal ones."""
    whole = lambda c: c.cast("decimal(15,0)")
    cuts = [
        F.struct(
            F.call_function("div", whole(F.col("a")) * whole(F.col("a")) * F.lit(1_000_000).cast("decimal(7,0)"),
                            whole(F.col("heads")[k - 1]) * whole(F.col("tails")[words - k - 1])).alias("score"),
            F.lit(k).alias("k"), F.col("heads")[k - 1].alias("l"), F.col("tails")[words - k - 1].alias("r"),
        )
        for k in range(1, words)
    ]
    best = F.array_min(F.array(*cuts))
    return level.withColumn("best", best).select("key", "lang", "phrase", "a", "best.l", "best.r", "best.score")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 3, least: int = 10, within: int = 50, top: int = 2000,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best ``top`` phrases of 2 to ``max_words`` words of each language.

    Texts are lower-cased (A-Z), split at ``[.,;:!?\\\\x0A-\\\\x0D]`` into pieces and these into words
    ``[^\\\\x20\\\\x09]+``; phrases lie within a piece, overlaps count. Per language, n is the number of words and
    a the occurrences of a phrase, at least ``least``. Cut after k words into parts that occur l and r times, it scores
    floor(1000000 a a / (l r)); the cut that scores least counts, the earliest of equal ones. A phrase inside
    a longer one that occurs at least ``within`` percent as often is left out. Order: score, a, both falling, then phrase.

    Words are counted first; the RANKED most frequent get ids by rank. Pairs of ids fall into tiles of SIDE by
    SIDE: a tile that fills is a dense array counted by address, other pairs are sorted coordinate lists, and
    each task hands on its sums. The frequent pairs are ranked anew as units of the next level, where two that
    overlap make one of three words, and so on. A task is told of frequent units by a filter of at most
    2 ** FILTER_BITS bits, which only saves work: what it wrongly lets through falls to ``least``. Texts are read
    once a level, and what is shuffled is pairs of frequent units. Words and phrases are told apart by
    64-bit digests.

    Null texts are empty, null languages ``und``. Repeated rows count each time. Other columns are ignored; an
    empty table, or one without frequent phrases, gives an empty result.
    """
    if max_words < 2:
        raise ValueError("phrases have two words at least")
    spark = docs.sparkSession
    texts = _texts(docs, text_col, lang_col)
    words = materialise(word_counts(docs, text_col, lang_col))
    totals = words.groupBy("lang").agg(F.sum("a").alias("n"))
    frequent = words.filter(F.col("a") >= least).withColumn("last", F.col("phrase"))
    level = materialise(frequent.withColumns({"heads": F.array("a"), "tails": F.array("a")}))
    known: list = []
    found: list[DataFrame] = []
    for length in range(2, max_words + 1):
        known.append(spark.sparkContext.broadcast(Frequent(level)))
        pairs = materialise(_pair_counts(texts, known, least))
        longer = materialise(_longer(level, pairs))
        if length > 2:
            # The most frequent longer phrase around a phrase is one word longer.
            around = longer.select(F.col("left").alias("key"), F.col("a").alias("most")).union(longer.select("right", "a"))
            around = around.groupBy("key").agg(F.max("most").alias("most"))
            kept = found[-1].join(around, "key", "left").filter(F.col("most").isNull() | (100 * F.col("most") < within * F.col("a")))
            found[-1] = kept.drop("most")
        found.append(_scored(longer, length))
        level = longer
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = out.withColumn("rank", place.cast("long")).filter(F.col("rank") <= top).join(totals, "lang")
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
