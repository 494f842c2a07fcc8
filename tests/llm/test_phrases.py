"""Collocations against a brute-force version."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from assay.llm import phrases


def brute(rows, max_words=3, least=10, within=50, top=2000):
    seen = defaultdict(Counter)
    for text, lang in rows:
        low = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            words = tuple(w for w in re.split(r"[\x20\x09]+", piece) if w)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    seen["und" if lang is None else lang][words[i : i + k]] += 1
    out = []
    for lang, f in seen.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        chosen = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in chosen.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], a)
        scored = []
        for p, a in chosen.items():
            if 100 * inside[p] >= within * a and inside[p]:
                continue
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def some_rows(seed=2):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["Été", "zum", "日本語", "x y", "-"]
    weight = 1 / np.arange(1, len(vocabulary) + 1)
    rows = []
    for i in range(120):
        words = list(rng.choice(vocabulary, int(rng.integers(0, 120)), p=weight / weight.sum()))
        for _ in range(len(words) // 9):
            words.insert(int(rng.integers(len(words))), str(rng.choice(["New York city", "new york", "a b c", ". b c", "\tq\n", "x, y;z"])))
        rows.append((" ".join(words), [None, "en", "en", "de", ""][i % 5]))
    return rows + [(None, "en"), ("", "en"), ("lone", "fr"), ("a a a a a a a a a a a a a a", "rep"), ("Deep Blue " * 40_000, "long"), ("z" * 200_000, "long")]


@pytest.mark.parametrize("size", [2, 3, 4])
def test_equal_to_brute_force(spark, size):
    rows = some_rows()
    df = spark.createDataFrame(rows, "text string, lang string").select("*", F.lit(1).alias("key"), F.lit(2).alias("a"), F.lit("x").alias("phrase"))
    got = sorted(tuple(r) for r in phrases.collocations(df, max_words=size).collect())
    want = brute(rows, size)
    assert len(want) > 40 and got == want


def test_top_and_other_limits(spark):
    rows = some_rows(4)
    df = spark.createDataFrame(rows, "text string, lang string")
    got = phrases.collocations(df, least=4, within=90, top=7)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 3, 4, 90, 7)


@pytest.mark.parametrize("rows", [[], [("a b c", "en")], [(None, None)]])
def test_nothing_frequent(spark, rows):
    assert phrases.collocations(spark.createDataFrame(rows, "text string, lang string")).count() == 0


@pytest.mark.parametrize("dense,held", [(1, 50), (60, 300), (10**9, 10**9)])
def test_tiles_count_every_pair_once(monkeypatch, dense, held):
    for name, value in (("RANKED", 24), ("SIDE", 8), ("DENSE", dense), ("HELD", held)):
        monkeypatch.setattr(phrases, name, value)
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 1 << 64, 60, dtype=np.uint64)
    units = phrases.Frequent.__new__(phrases.Frequent)
    units.by_rank = keys[:24]
    units.ids = np.argsort(units.by_rank)
    units.ranked = units.by_rank[units.ids]
    tiles, want, got = phrases.Tiles(units), Counter(), Counter()
    frames = []
    for _ in range(6):
        i, j = rng.zipf(1.3, 500) % 60, rng.zipf(1.3, 500) % 60
        tiles.add(keys[i], keys[j])
        want.update(zip(keys[i].view(np.int64).tolist(), keys[j].view(np.int64).tolist()))
        if tiles.overfull():
            frames += list(tiles.rows(dense=False))
    assert bool(tiles.dense) == (dense < 10**9)
    for frame in frames + list(tiles.rows(dense=True)):
        for row in frame.itertuples(index=False):
            got[row.left, row.right] += row.a
    assert got == want


def test_scores_stay_exact_above_64_bits(spark):
    a, left, right = 7 * 10**12 + 1, 9 * 10**12, 8 * 10**12 + 3
    df = spark.createDataFrame([(1, "en", "x y", a, [left, a], [right, a])], "key long, lang string, phrase string, a long, heads array<long>, tails array<long>")
    assert phrases._scored(df, 2).first()["score"] == 1_000_000 * a * a // (left * right)


def test_filter_never_misses(spark):
    keys = np.random.default_rng(3).integers(-(1 << 63), 1 << 63, 5000)
    level = spark.createDataFrame([(int(k), i) for i, k in enumerate(keys)], "key long, a long")
    frequent = phrases.Frequent(level)
    assert frequent.has(keys.view(np.uint64)).all()
    others = np.random.default_rng(4).integers(0, 1 << 64, 20_000, dtype=np.uint64)
    assert frequent.has(others).mean() < 0.05
    assert (frequent.rank(keys[-5:].view(np.uint64)) == [4, 3, 2, 1, 0]).all()


def test_the_filter_reaches_the_driver_in_blocks(spark, monkeypatch):
    """No row a slot: at full size these took gigabytes of the driver's Python."""
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(-(2**63), 2**63 - 1, 20_000))
    level = spark.createDataFrame([(int(k), int(k % 50 + 10)) for k in keys], "key long, a long")
    fetched = []
    as_frame = type(level).toPandas
    monkeypatch.setattr(type(level), "toPandas", lambda df: fetched.append(len(out := as_frame(df))) or out)
    for bits in (8, 30):  # many blocks, and one that is larger than the filter
        monkeypatch.setattr(phrases, "BLOCK_BITS", bits, raising=False)
        units = phrases.Frequent(level)
        size = 1 << units.power
        wanted = np.zeros(size, bool)
        for place in (keys.view(np.uint64), keys.view(np.uint64) >> np.uint64(32)):
            wanted[place & np.uint64(size - 1)] = True
        assert (np.unpackbits(units.bits.view(np.uint8), bitorder="little").astype(bool) == wanted).all()
        assert units.has(keys.view(np.uint64)).all()
    assert max(fetched) <= phrases.RANKED
    empty = phrases.Frequent(level.limit(0))
    assert not empty.bits.any() and len(empty.ranked) == 0
