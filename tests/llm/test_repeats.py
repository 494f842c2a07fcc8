"""Repeated bytes, repeated passages and benchmark tiles against brute-force versions."""

import random
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from assay.llm import chaining, suffixes, tiling
from assay.llm.words import word_hashes
from assay.session import BATCH_BYTES, small_batches


def brute_removed(rows):
    first, out = {}, {}
    for i, text in sorted(rows):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 49):
            if first.setdefault(raw[p : p + 50], i) < i:
                gone[p : p + 50] = b"\1" * 50
        out[i] = (len(raw), sum(gone), sum(1 for p in range(len(raw)) if gone[p] and (p == 0 or not gone[p - 1])),
                  bytes(b for b, g in zip(raw, gone) if not g))
    return out


def texts_with_repeats(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgé ", k=rng.randrange(3, 9)))
    base = [" ".join(word() for _ in range(40)) for _ in range(30)]
    shared = [" ".join(word() for _ in range(15)) for _ in range(4)]
    rows = [(3 * i, t) for i, t in enumerate(base)]
    rows += [(200 + i, base[i][: 120 + i] + rng.choice(shared) + base[(i + 7) % 30][-90:]) for i in range(20)]
    rows += [(300 + i, base[0]) for i in range(5)]  # equal texts
    rows += [(500 + i, "xyz" * (40 + 5 * i)) for i in range(6)] + [(520, "q" + "xyz" * 50 + "q" + "xyz" * 60)]  # within and across
    rows += [(400, "ab" * 200), (401, "b" + "ab" * 60), (402, "a" * 300), (403, "a" * 49), (404, "a" * 50), (405, ""), (406, None)]
    return rows


def test_removed_bytes_match_brute_force(spark, monkeypatch):
    rows = texts_with_repeats(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "doc_id as id", "1 as spans", "2 as key")
    for hot in (2_000, 3):  # the second sorts nearly everything window by window
        monkeypatch.setattr(suffixes, "HOT_DOCS", hot)
        got = {r.doc_id: r for r in suffixes.remove_repeats(docs).collect()}
        for i, (size, removed, spans, kept) in brute_removed(rows).items():
            r = got[i]
            assert (r.n_bytes, r.n_removed, r.n_spans) == (size, removed, spans), i
            assert removed == 0 and r.kept is None or bytes(r.kept) == kept


def test_removal_of_repeated_rows_null_ids_and_empty_tables(spark):
    text = "x1 y2 z3 " * 20
    docs = spark.createDataFrame([(1, text), (1, text), (2, text), (None, text)], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in suffixes.kept_digest(suffixes.remove_repeats(docs)).collect()}
    assert got == {1: 0, 2: len(text)}
    assert suffixes.remove_repeats(docs.limit(0)).count() == 0


def test_sorting_block_by_cover_ranks():
    rng = np.random.default_rng(3)
    rows = rng.integers(97, 99, (300, suffixes.WIDTH)).astype(np.uint8)
    rows[100:200, :60] = rows[:100, :60]
    rows[200:300, 25:] = rows[:100, 25:]
    keys, ids = np.tile(np.arange(100), 3), np.arange(300)
    far = np.full(300, suffixes.REACH)
    mask = suffixes.sort_block(keys, ids, np.zeros(300, int), far, rows)
    for t in range(suffixes.REACH + 1):
        seen = {}
        for i in range(300):
            window = (keys[i], rows[i, suffixes.REACH - t : suffixes.WIDTH - t].tobytes())
            assert bool(mask[i] >> t & 1) == (window in seen)
            seen.setdefault(window, i)


def test_cover_holds_every_difference():
    assert {(a - b) % suffixes.PERIOD for a in suffixes.COVER for b in suffixes.COVER} == set(range(suffixes.PERIOD))


def fuzzy(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        k = rng.randrange(len(out))
        out[k : k + rng.randrange(2)] = [f"z{rng.randrange(10**6)}"]
    return out


def test_fuzzy_passages_are_found_and_clean_text_is_not(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(4000)]
    some = lambda n: rng.choices(vocabulary, k=n)
    passage = some(70)
    rows = [(10, some(100) + passage + some(30)), (20, some(50) + fuzzy(rng, passage, 5) + some(80)), (30, some(300)), (40, some(20))]
    rows += [(50, rows[0][1]), (60, ["same"] * 200), (70, ["same"] * 150 + some(10)), (80, some(5))]
    # A passage whose halves were first met in two documents is still met with its whole copy.
    halves = some(60)
    rows += [(90, some(40) + halves[:30] + some(40)), (100, some(40) + halves[30:] + some(40)), (110, some(40) + halves + some(9)), (120, halves + some(50))]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows] + [(130, None), (None, " ".join(passage)), (140, "")], "doc_id long, text string")
    docs = docs.selectExpr("*", "1 as id", "2 as spans", "3 as seed")
    got = sorted((r.id, r.first_id, r.start_word, r.end_word) for r in chaining.repeated_passages(docs).collect())
    by_id = {g[0]: g for g in got}
    assert {g[0] for g in got} == {20, 50, 70, 120}
    assert by_id[50] == (50, 10, 0, 200) and by_id[120][1] == 110 and by_id[120][2:] == (0, 60)
    assert abs(by_id[20][2] - 50) <= 2 and abs(by_id[20][3] - 120) <= 4
    cut = {r.doc_id: r.text for r in chaining.without_passages(docs, chaining.repeated_passages(docs)).collect() if r.doc_id is not None}
    assert cut[50] == "" and cut[30] == " ".join(rows[2][1]) and cut[120] == " ".join(rows[-1][1][60:]) and cut[130] is None
    assert chaining.repeated_passages(docs.limit(0)).count() == 0


def test_a_passage_whose_seeds_all_lie_in_earlier_short_pieces_is_found(spark):
    rng = random.Random(9)
    some = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    for _ in range(3):
        passage = some(60)
        rows = [(1, some(30) + passage[:35] + some(30)), (2, some(30) + passage[28:] + some(30)), (20, some(50) + passage + some(40)), (50, some(20) + passage + some(70))]
        docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
        got = [tuple(r)[:6] for r in chaining.repeated_passages(docs).collect()]
        # Brute force: pairs with a run of 40 equal words.
        runs = {i: {tuple(w[k : k + 40]) for k in range(len(w) - 39)} for i, w in rows}
        assert {g[:2] for g in got} == {(b, a) for b in runs for a in runs if a < b and runs[a] & runs[b]} == {(50, 20)}
        assert [g[2:] for g in got] == [(20, 80, 50, 110)]


def test_passages_of_80_percent_equal_words_are_found(spark):
    rng = random.Random(12)
    some = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    rows, want = [], set()
    for i in range(120):
        passage = some(60)
        # One word in 6, 7, 8 or 10 evenly, or one in 6 at random places between equal ends.
        gone = set(range(3, 57, (6, 7, 8, 10)[i % 4])) if i % 5 else set(rng.sample(range(3, 57), 9))
        rows += [(2 * i, some(40) + passage + some(30)), (2 * i + 1, some(25) + [f"z{i}-{k}" if k in gone else w for k, w in enumerate(passage)] + some(50))]
        want.add((2 * i + 1, 2 * i))
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    assert {(r.id, r.first_id) for r in chaining.repeated_passages(docs).collect()} == want


def test_gaps_and_ends_of_any_length_are_aligned_exactly(monkeypatch):
    rng = np.random.default_rng(6)
    for n, m, kinds in ((300, 250, 5), (260, 260, 400), (30, 20, 4), (1, 9, 2)):
        x, y = rng.integers(0, kinds, n).astype(np.uint64), rng.integers(0, kinds, m).astype(np.uint64)
        row = [0] * (m + 1)
        for w in x.tolist():
            new = [0]
            for j, v in enumerate(y.tolist()):
                new.append(row[j] + 1 if v == w else max(row[j + 1], new[j]))
            row = new
        for bits in (1 << 26, 0):
            monkeypatch.setattr(chaining, "MASK_BITS", bits)
            assert chaining._common(x, y) == row[-1]
    x = np.arange(3000).astype(np.uint64)
    y = x.copy()
    y[::7] = 9999
    y[1500:] = 8888
    assert chaining._extend(x[1:], y[1:]) == (1497, int((x[1:1498] == y[1:1498]).sum()))  # 1498 differs


def test_chain_scores_match_quadratic_search():
    rng = np.random.default_rng(2)
    for _ in range(30):
        n = 25
        found = np.array(sorted({(int(a), int(b), int(c)) for a, b, c in zip(rng.integers(0, 200, n), rng.integers(0, 200, n), rng.integers(1, 12, n))}))
        best = []
        for j, (x, y, size) in enumerate(found):
            before = [best[i] - chaining.GAP_COST * (x - a - c + y - b - c) for i, (a, b, c) in enumerate(found[:j]) if a + c <= x and b + c <= y]
            best.append(size + max([0.0, *before]))
        top = next(chaining.chains(found, 0.0))
        gaps = sum(found[k][0] - found[i][0] - found[i][2] + found[k][1] - found[i][1] - found[i][2] for i, k in zip(top, top[1:]))
        assert abs(sum(found[i][2] for i in top) - chaining.GAP_COST * gaps - max(best)) < 1e-9


def test_winnowing_meets_every_long_run():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 60, 400).astype(np.uint64)
    y = np.concatenate([rng.integers(0, 1 << 60, 33).astype(np.uint64), x[100:114], rng.integers(0, 1 << 60, 20).astype(np.uint64)])
    gram = lambda v: chaining.grams(v, chaining.SEED_WORDS)
    seeds = [set(gram(v)[chaining.winnow(gram(v), chaining.WINDOW)].tolist()) for v in (x, y)]
    assert seeds[0] & seeds[1]
    assert len(word_hashes([b""])[0]) == 0 and chaining.winnow(np.zeros(50, np.uint64), 9).tolist() == [0, 49]


def brute_tiles(a, b, least):
    free_a, free_b, covered = [True] * len(a), [True] * len(b), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < least:
            return covered
        for k in range(n):
            free_a[i + k] = free_b[j + k] = False
        covered += n


def test_tiles_match_plain_greedy_tiling():
    rng = random.Random(8)
    for _ in range(25):
        item = [rng.randrange(10**6) for _ in range(30)]
        cuts = [item[a : a + rng.randrange(2, 9)] for a in rng.sample(range(25), 4)]
        text = [x for c in cuts for x in [*c, rng.randrange(10**6), rng.randrange(10**6)]]
        as_words = lambda v: np.array(v, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        assert tiling.tile(as_words(item), as_words(text), 3)[0] == brute_tiles(item, text, 3)


def test_leaks_by_either_way(spark):
    rng = random.Random(6)
    some = lambda n: [f"v{rng.randrange(3000)}" for _ in range(n)]
    items = [(i, some(40)) for i in range(6)] + [(6, some(3))]
    whole = some(60) + items[0][1] + some(20)
    moved = some(10) + items[1][1][22:] + some(5) + items[1][1][:22] + some(60)
    part = some(30) + items[2][1][:12] + some(30)
    docs = [(1, " ".join(whole)), (2, " ".join(moved).upper()), (3, " ".join(part)), (4, " ".join(some(200))), (5, None), (6, ""), (None, "x"), (7, ", ".join(items[3][1]))]
    table = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as item_id", "2 as seed")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items] + [(9, None)], "item_id long, text string")
    for bound in (tiling.BROADCAST_TOKENS, 0):
        got = sorted((r.doc_id, r.item_id, r.covered_tokens) for r in tiling.contaminated(table, bench, broadcast_tokens=bound).collect())
        assert got == [(1, 0, 40), (2, 1, 40), (7, 3, 40)]
        assert tiling.contaminated(table.limit(0), bench, broadcast_tokens=bound).count() == 0
        assert tiling.contaminated(table, bench.limit(0), broadcast_tokens=bound).count() == 0


def test_both_ways_of_leaks_keep_every_row(spark):
    rng = random.Random(3)
    some = lambda n: " ".join(f"v{rng.randrange(3000)}" for _ in range(n))
    han = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(n))
    a, b, short, script = some(30), some(30), "red blue green", han(20)
    docs = [(1, "zz " + some(20)), (1, f"aa {a} x"), (None, f"{b} y"), (None, some(9)), (2, f"q Red, blue green {some(9)}"), (3, "red blue x green"), (4, han(5) + script + han(9)), (5, short), (5, short), (6, None)]
    items = [(10, a), (10, "zz " + some(30)), (None, b), (11, short), (12, script), (13, ""), (14, None)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for bound in (tiling.BROADCAST_TOKENS, 0):
        got = [(r.doc_id, r.item_id, r.covered_tokens) for r in tiling.contaminated(table, bench, broadcast_tokens=bound).collect()]
        assert sorted(got, key=str) == sorted([(1, 10, 30), (None, None, 30), (2, 11, 3), (4, 12, 20), (5, 11, 3), (5, 11, 3)], key=str)


def test_windows_of_a_run_of_texts_are_found_at_once(monkeypatch):
    """The same rows as text by text, but lookups do not grow with the number of texts."""
    import pandas as pd

    class Frame:
        def sortWithinPartitions(self, *_):
            return self

        def mapInPandas(self, work, _):
            return work

    monkeypatch.setattr(suffixes, "materialise", lambda df: df)
    work = suffixes.windows_around(Frame())
    texts = [t for _, t in texts_with_repeats(2) if t and len(t.encode()) >= suffixes.LENGTH] * 4
    places = [[] for _ in texts]
    for doc, at, hashes, _, _ in suffixes.anchors_of([t.encode() for t in texts]):
        for i, p, h in zip(doc.tolist(), at.tolist(), (hashes % np.uint64(3)).tolist()):
            places[i] += [[p], [~p], []][h]
    calls, isin = [], np.isin
    monkeypatch.setattr(np, "isin", lambda *a, **k: calls.append(1) or isin(*a, **k))

    def spread(rows):
        out = []
        for i in rows:
            for part in work(iter([pd.DataFrame({"id": i, "text": [texts[j] for j in i], "places": [places[j] for j in i]})])):
                out += part[part["mask"] == 0][["id", "near", "far", "around"]].itertuples(index=False, name=None)
        return out

    whole = spread([range(len(texts))])
    assert len(calls) <= 4  # two a run
    single = spread([[i] for i in range(len(texts))])
    seen_before = {r for r in single} - {r for r in whole}
    assert set(whole) <= set(single) and all(r[1] == r[2] for r in seen_before)  # only hot windows are remembered


def test_packed_seeds_come_back_and_meet_their_first_holder(spark, monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(rng.choices("abcdef", k=rng.randrange(0, 60))) for _ in range(60)] + ["a " * 30, "", None]
    rows = [(rng.choice([7, -3, 2**40]) * i, t) for i, t in enumerate(texts)]
    held = []
    for i, t in rows:
        values = chaining.grams(word_hashes([(t or "").encode()])[0], chaining.SEED_WORDS)
        held += [(int(values[p].view(np.int64)), i, int(p)) for p in chaining.winnow(values, 1)]
    first, last = {}, {}
    for s, i, p in held:
        first[s], last[s] = min(first.get(s, (i, p)), (i, p)), max(last.get(s, i), i)
    want = sorted((s, i, p, *first[s]) for s, i, p in held if last[s] > first[s][0])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for opened in (chaining.RUN_ROWS, 9):  # the second opens buckets in many parts
        monkeypatch.setattr(chaining, "RUN_ROWS", opened)
        packed = chaining.packed_seeds(docs, "doc_id", "text", 8)
        got = chaining._matched(packed, 8)
        assert sorted(map(tuple, got.collect())) == want
        again = chaining._matched(chaining.packed_rows(got.select("seed", "id", "pos"), 9), 9)
        assert sorted(map(tuple, again.collect())) == want
    assert packed.columns == ["bucket", "rest", "ids", "sizes", "gaps"]


def test_pairs_in_turns_and_their_score_bound(spark, monkeypatch):
    rng = random.Random(6)
    base = [f"w{rng.randrange(4000)}" for _ in range(120)]
    rows = [(0, " ".join(base))] + [(i, " ".join([f"x{i}"] * 9 + base[i : i + 70] + [f"y{i}"])) for i in range(1, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pairs = spark.createDataFrame([(i, j, []) for i in range(1, 9) for j in range(i)], "id long, first_id long, seeds array<long>")
    found = []
    for turns in (chaining.MOST_TURNS, 1):
        monkeypatch.setattr(chaining, "MOST_TURNS", turns)
        found.append(sorted(map(tuple, chaining._aligned(pairs, docs, "doc_id", "text", 40, 80).collect())))
    assert found[0] == found[1] and len(found[0]) == 36
    for seed in range(200):
        rng = np.random.default_rng(seed)
        x, y = (rng.integers(0, 6, 80).astype(np.uint64) for _ in range(2))
        at = chaining._Runs(y).shared(x)
        met = chaining.matches(x, y, *chaining._Runs(y).anchors(*at))
        best = next(chaining.chains(met, 0.0), None)
        if best is not None:
            parts = met[best]
            gaps = int((parts[1:, :2] - parts[:-1, :2] - parts[:-1, 2:]).sum())
            assert int(parts[:, 2].sum()) - chaining.GAP_COST * gaps <= chaining._score_bound(at[0])


def test_links_of_many_documents_are_those_of_each(spark):
    """A batch of documents is linked at once, and lists of seeds reach Python as plain arrays, not as structs."""
    rng = np.random.default_rng(5)
    rows = [(int(rng.integers(-(2**62), 2**62)), d, int(p)) for d in (3, 4, 90, 7 << 33) for p in rng.choice(300, 120, replace=False)] + [(1, 5, 0), (2, 5, 17)]
    least, most = chaining.LINK_WORDS
    expected = set()
    for d in {r[1] for r in rows}:
        own = sorted((p, s) for s, at, p in rows if at == d)
        for p, s in own:
            rank = lambda t: int(chaining.mix(np.array([t % 2**64], np.uint64) + np.uint64(0x51ED270B))[0]) >> 32
            ahead = [(rank(t), q, t) for q, t in own if least <= q - p <= most]
            if ahead:
                _, q, t = min(ahead)
                link = chaining.mix(np.array([s % 2**64], np.uint64) * np.uint64(0x2545F4914F6CDD1D) + np.array([t % 2**64], np.uint64))
                expected.add((int(link.view(np.int64)[0]), d, p, q))
    got = chaining._links(spark.createDataFrame(rows, "seed long, id long, pos int"))
    assert len(expected) > 300 and {tuple(r) for r in got.collect()} == expected
    handed = got._jdf.queryExecution().analyzed().toString()
    assert re.search(r"MapInPandas work\(id#\d+L, pos#\d+, seed#\d+\)", handed)


def test_texts_reach_python_in_batches_of_bounded_size(spark):
    """One thousand rows of long texts or packed seeds must not come at once."""
    small_batches(spark)
    texts = spark.range(0, 600, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("text"))
    sizes = texts.mapInPandas(lambda batches: (pd.DataFrame({"n": [b["text"].str.len().sum()]}) for b in batches), "n long").collect()
    assert sum(r["n"] for r in sizes) == 60_000_000 and max(r["n"] for r in sizes) < 2 * BATCH_BYTES


def test_few_pairs_of_long_texts_go_in_turns_too(spark, monkeypatch):
    """What a turn moves is text, however few pairs hold it."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(9000)}" for _ in range(900)]
    rows = [(i, " ".join(base[i : i + 800])) for i in range(6)] + [(i, "short") for i in range(6, 106)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pairs = spark.createDataFrame([(i, j, []) for i in range(6) for j in range(i)], "id long, first_id long, seeds array<long>")
    turns = []
    write = chaining.write_table
    monkeypatch.setattr(chaining, "write_table", lambda df: turns.append(1) or write(df))
    found = chaining._aligned(pairs, docs, "doc_id", "text", 40, 80).collect()
    assert {(r["id"], r["first_id"]) for r in found} == {(i, j) for i in range(6) for j in range(i)}
    assert len(turns) > 1
