"""Near-duplicate groups against a brute-force version."""

import random
import re

from assay.llm import minhash
from assay.llm.components import connected_components

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, k):
    w = SPACE.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


def brute(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows]
    best = {i: i for i, _ in sets}

    def root(i):
        while best[i] != i:
            i = best[i]
        return i

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if i is not None and j is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                u, v = root(i), root(j)
                if u != v:
                    best[max(u, v)] = min(u, v)
    return sorted((i, len(x), i if i is None else root(i), i is None or root(i) == i) for i, x in sets if i is not None)


def varied(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"q{rng.randrange(10**9)}"
    return " ".join(out)


def check(spark, rows, k, percent):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "text as id", "doc_id as component_id", "1 as kept")
    got = minhash.near_duplicates(docs, shingle=k, percent=percent).collect()
    assert sorted(tuple(r) for r in got if r.doc_id is not None) == brute(rows, k, percent)
    return got


def test_groups_links_and_edges_match_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(3, 120)))) for i in range(60)]
    rows += [(100 + i, varied(rng, rows[i][1].split(), rng.randrange(0, 3))) for i in range(60)]
    rows += [(200, None), (201, ""), (202, " \t "), (203, "one"), (204, "ONE"), (205, "one two"), (206, "one two"), (207, "A b C d"), (208, "a B c D")]
    rows += [(209, rows[5][1].upper()), (5, rows[5][1])]  # an equal set in capitals, a repeated row
    got = check(spark, rows, 3, 85)
    assert len(got) == len(rows)
    check(spark, rows, 5, 80)


def test_dense_group_of_partly_linked_copies(spark, monkeypatch):
    monkeypatch.setattr(minhash, "CELL", 16)  # many cells
    rng = random.Random(9)
    base = [f"b{i}" for i in range(150)]
    rows = [(i, varied(rng, base, rng.randrange(2, 6))) for i in range(120)]
    check(spark, rows, 3, 85)
    chain = [(1000 + i, " ".join(f"c{j}" for j in range(6 * i, 6 * i + 110))) for i in range(40)]
    got = check(spark, rows + chain, 3, 85)
    assert {r.component_id for r in got if r.doc_id >= 1000} == {1000}


def test_large_group_of_copies_around_the_threshold(spark, monkeypatch):
    """Copies of one text at 80 to 90 % of each other, and of a second that shares part of it: whole result, few open rows."""
    rng = random.Random(12)
    base = [f"b{i}" for i in range(200)]
    other = base[:90] + [f"o{i}" for i in range(110)]
    rows = [(i, varied(rng, base, rng.randrange(3, 7))) for i in range(250)] + [(1000 + i, varied(rng, other, rng.randrange(3, 7))) for i in range(100)]
    check(spark, rows, 3, 85)
    monkeypatch.setattr(minhash, "HUB_ROUNDS", 0)  # the cells alone give the same rows
    check(spark, rows, 3, 85)


def test_hub_rounds_meet_each_member_apart_twice_at_most(spark):
    rows = [(k, r, 1 if r < 60 else r) for k in (7, 8) for r in range(1, 101)] + [(9, r, 5) for r in range(200, 230)]
    labelled = spark.createDataFrame(rows, "key long, rep long, comp long")
    pairs = [tuple(r) for r in minhash._hub_pairs(labelled, 0).collect()]
    apart = set(range(60, 101))
    assert len(pairs) == len(set(pairs)) <= 2 * 2 * len(apart)
    assert all(u > v and u in apart and (v < 60 or v in apart) for u, v in pairs) and {u for u, v in pairs if v < 60} == apart


def test_null_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (3, "a b c d")], "doc_id long, text string")
    got = sorted(map(tuple, minhash.near_duplicates(docs, shingle=3).collect()), key=str)
    assert got == [(3, 2, 3, True), (None, 2, None, True), (None, 2, None, True)]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0
    one = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert [tuple(r) for r in minhash.near_duplicates(one).collect()] == [(1, 0, 1, True)]


def test_components_of_paths_stars_and_loops(spark):
    pairs = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200), (None, 4)]
    edges = spark.createDataFrame(pairs, "u long, v long")
    got = dict(map(tuple, connected_components(edges).collect()))
    assert got == {i: 0 for i in range(31)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}
