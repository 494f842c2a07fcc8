"""SimHash fingerprints and groups against a brute-force version."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from assay.llm import simhash


def brute_print(text, k=3):
    words = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    grams = [b" ".join(words[i : i + k]) for i in range(max(len(words) - k + 1, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows, radius=2):
    """(fingerprint, component) per row of (id, text)."""
    prints = [brute_print(t) for _, t in rows]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    ids = [i for i, _ in rows]
    for a in range(len(rows)):
        for b in range(a):
            if ids[a] is not None and ids[b] is not None and (prints[a] ^ prints[b]).bit_count() <= radius:
                u, v = root(ids[a]), root(ids[b])
                parent[max(u, v)] = min(u, v)
    return [(i, f"{p:016x}", None if i is None else root(i)) for (i, _), p in zip(rows, prints)]


def some_texts(seed=3):
    rng = np.random.default_rng(seed)
    words = [f"w{i}é" if i % 7 == 0 else f"Word{i}" for i in range(80)]
    base = [list(rng.choice(words, int(n))) for n in rng.integers(1, 500, 25)]
    out = [" ".join(b) for b in base]
    for b in base:
        for _ in range(5):
            near = list(b)
            near[int(rng.integers(len(near)))] = str(rng.choice(words))
            out.append("\t".join(near) + "\n")
    return out + [None, "", " \n", "one", "ONE", "one two", "one two three", "x" * 100_000, "a b " * 60_000, "a b c\u0085d"]


def found(df):
    return sorted(map(repr, (tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect())))


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 2])
def test_groups_equal_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rows = [(i * 7 % 1009, t) for i, t in enumerate(some_texts())]
    rows += [(None, "one two three"), (rows[3][0], rows[3][1]), (rows[4][0], rows[9][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(1).alias("fp"), F.lit("k").alias("key"), F.lit(0).alias("rep"))
    assert found(simhash.simhash_groups(df)) == sorted(map(repr, brute_groups(rows)))


def test_empty_table(spark):
    assert simhash.simhash_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_tables_of_near_fingerprints_share_a_key():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 64, 300, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (300, 2)).astype(np.uint64)
    near = prints ^ flips[:, 0] ^ flips[:, 1]
    for blocks in (4, 8):
        assert (simhash.table_keys(prints, 2, blocks) == simhash.table_keys(near, 2, blocks)).any(1).all()
    assert not (simhash.table_keys(prints, 2) == simhash.table_keys(np.roll(prints, 1), 2)).any()
    some = np.unique(simhash.distance_table(np.arange(1 << 16, dtype=np.uint64))[:, :17], axis=0)
    assert len(some) == 1 << 16  # the distances tell any two fillings of a block apart


@pytest.mark.parametrize("n", [0, 1, 2, 300])
def test_pairs_through_tables_are_all_near_pairs(n):
    rng = np.random.default_rng(n)
    centre = rng.integers(0, 1 << 64, 1, dtype=np.uint64)
    prints = np.unique(centre ^ (np.uint64(1) << rng.integers(0, 64, (n, 3)).astype(np.uint64)).sum(1, dtype=np.uint64)) if n else np.zeros(0, np.uint64)
    got = {tuple(sorted(p)) for i, j in simhash.near_pairs(prints, 2) for p in zip(i.tolist(), j.tolist())}
    want = {(a, b) for b in range(len(prints)) for a in range(b) if int(prints[a] ^ prints[b]).bit_count() <= 2}
    assert got == want
    links = simhash.spanning_links(prints, 2)
    assert len(links) < max(len(prints), 1) and {tuple(sorted(p)) for p in links} <= want


def test_a_crowd_of_neighbours_makes_few_links(spark, monkeypatch):
    """300 fingerprints one or two bits from a centre: no list of all pairs."""
    monkeypatch.setattr(simhash, "BUCKET", 16)
    prints = [(1 << a) | (1 << b) for a in range(24) for b in range(a)]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(prints)], "rep long, fp long")
    links = simhash._links_of_large_keys(df, 2)
    nodes = {x for r in links.collect() for x in r}
    assert nodes == set(range(len(prints))) and links.count() <= 25 * len(prints)
