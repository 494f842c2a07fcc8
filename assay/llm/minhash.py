"""Near-duplicate groups: universal hash minima, banding, exact confirmation, star components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from assay.llm.components import connected_components
from assay.llm.frames import complete_groups, only_ids
from assay.llm.words import as_bytes, byte_runs, mix, runs, shingle_sets
from assay.session import materialise

ROWS = 5  # minima per band
CELL = 128  # documents per side of a comparison cell
HUB_ROUNDS = 4  # rounds of fresh hubs after the first; what they leave open is compared in cells
SLICE = 1 << 15  # shingles of a cell that are compared at a time
_U = np.uint64


def bands_for(percent: int, miss: float, rows: int = ROWS) -> int:
    """Bands so that a pair exactly at the threshold shares none with probability ``miss`` at most."""
    return math.ceil(math.log(miss) / math.log1p(-((percent / 100) ** rows)))


def minima_of(sets: list[np.ndarray], n_hashes: int) -> np.ndarray:
    """One row of 32-bit minima of (a x + b) mod 2^64, top half, per set; empty sets get all ones."""
    rng = np.random.default_rng(7)
    a = rng.integers(0, 1 << 63, n_hashes, dtype=np.uint64) * _U(2) + _U(1)
    b = rng.integers(0, 1 << 63, n_hashes, dtype=np.uint64) * _U(2)
    out = np.full((len(sets), n_hashes), 0xFFFFFFFF, np.uint32)
    for lo, hi in runs([memoryview(s).cast("B") for s in sets], 1 << 19):
        full = [i for i in range(lo, hi) if len(sets[i])]
        if not full:
            continue
        values = np.concatenate([sets[i] for i in full])
        starts = np.concatenate([[0], np.cumsum([len(sets[i]) for i in full])[:-1]])
        work = np.empty_like(values)
        for h in range(n_hashes):
            np.multiply(values, a[h], out=work)
            np.add(work, b[h], out=work)
            out[full, h] = (np.minimum.reduceat(work, starts) >> _U(32)).astype(np.uint32)
    return out


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int, n_hashes: int) -> DataFrame:
    """(id, n_shingles, set_a, set_b, minima): size, 128-bit identity and minima of each shingle set."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo, hi, raws in byte_runs(batch["text"], 1 << 22):
                sets = shingle_sets(raws, shingle)
                rows = minima_of(sets, n_hashes)
                yield pd.DataFrame({
                    "id": batch["id"].iloc[lo:hi].to_numpy(),
                    "n_shingles": [len(s) for s in sets],
                    "set_a": np.array([np.sum(mix(s ^ _U(0xA5A5))) for s in sets], np.uint64).view(np.int64),
                    "set_b": np.array([np.sum(mix(s + _U(0x5BD1))) for s in sets], np.uint64).view(np.int64),
                    "minima": [r.tobytes() for r in rows],
                })

    # Nullable ids travel as text, which pandas keeps exact.
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInPandas(work, "id string, n_shingles long, set_a long, set_b long, minima binary")
    return out.withColumn("id", F.col("id").cast("long"))


def confirm(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """The (u, v) of ``pairs`` with 100 * intersection >= percent * union on their full shingle sets."""
    pairs = materialise(pairs)
    ids = materialise(pairs.select(F.col("u").alias("id")).union(pairs.select("v")).distinct())
    texts = only_ids(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", ids)
    texts = materialise(texts.groupBy("id").agg(F.max("text").alias("text")))
    both = pairs.join(texts.select(F.col("id").alias("u"), F.col("text").alias("text_u")), "u")
    both = both.join(texts.select(F.col("id").alias("v"), F.col("text").alias("text_v")), "v")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = np.zeros(len(batch), bool)
            u, v = batch["u"].to_numpy(), batch["v"].to_numpy()
            held: dict[int, np.ndarray] = {}
            for i, (tu, tv) in enumerate(zip(batch["text_u"], batch["text_v"])):
                if len(held) > 64:
                    held = {}
                for key, text in ((u[i], tu), (v[i], tv)):
                    if key not in held:
                        held[key] = shingle_sets(as_bytes([text]), shingle)[0]
                x, y = held[u[i]], held[v[i]]
                if not len(x) or not len(y):
                    continue
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                common = int(np.sum(y[np.minimum(at, len(y) - 1)] == x))
                good[i] = 100 * common >= percent * (len(x) + len(y) - common)
            yield batch.loc[good, ["u", "v"]]

    return materialise(both.select("u", "v", "text_u", "text_v").mapInPandas(work, "u long, v long"))


def _agreeing(pairs: DataFrame, reps: DataFrame, least: int) -> DataFrame:
    """The (u, v) of ``pairs`` whose minima agree in ``least`` places or more."""
    side = lambda s: reps.select(F.col("rep").alias(s), F.col("minima").alias(f"minima_{s}"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = [
                np.count_nonzero(np.frombuffer(a, np.uint32) == np.frombuffer(b, np.uint32)) >= least
                for a, b in zip(batch["minima_u"], batch["minima_v"])
            ]
            yield batch.loc[np.array(good, bool), ["u", "v"]]

    return materialise(pairs.join(side("u"), "u").join(side("v"), "v").mapInPandas(work, "u long, v long"))


def _hub_pairs(labelled: DataFrame, turn: int) -> DataFrame:
    """(u, v): members outside the largest component of their bucket with a fresh hub inside it and one outside.

    At most two pairs per such member, so a round costs no more than what is still apart.
    """
    sizes = labelled.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    big = sizes.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.max_by("comp", F.struct("n", "comp")).alias("big"))
    apart = materialise(labelled.join(big.filter("parts > 1").drop("parts"), "key"))
    draw, inside = F.xxhash64("rep", "key", F.lit(turn)), F.col("comp") == F.col("big")
    node = F.struct(F.col("rep").alias("hub"), F.col("comp").alias("hub_comp"))
    hubs = apart.groupBy("key").agg(
        F.min_by(F.when(inside, node), F.when(inside, draw)).alias("in_"), F.min_by(F.when(~inside, node), F.when(~inside, draw)).alias("out_"),
    )
    met = apart.filter("comp != big").join(materialise(hubs), "key").select("rep", "comp", F.inline(F.array("in_", "out_")))
    return met.filter("comp != hub_comp").select(F.greatest("rep", "hub").alias("u"), F.least("rep", "hub").alias("v")).distinct()


def _contracted(labelled: DataFrame, links: DataFrame) -> DataFrame:
    """``labelled`` with the components that ``links`` join as one."""
    of = labelled.select("rep", "comp").distinct()
    ends = links.join(of.select(F.col("rep").alias("u"), F.col("comp").alias("cu")), "u").join(of.select(F.col("rep").alias("v"), F.col("comp").alias("cv")), "v")
    parts = connected_components(ends.select(F.col("cu").alias("u"), F.col("cv").alias("v")))
    out = labelled.join(materialise(parts), F.col("comp") == F.col("node"), "left")
    return materialise(out.select("key", "rep", F.coalesce("component", "comp").alias("comp")))


CELL_KEY = ["key", "r", "c"]


def _dealt(cells: DataFrame) -> DataFrame:
    return cells.repartition(*CELL_KEY).sortWithinPartitions(*CELL_KEY)


def _sides(rows: pd.DataFrame, cut: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, rows of the left side, rows of the right side) of each cell with both."""
    side = rows["side"].to_numpy()
    for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
        left, right = lo + np.flatnonzero(side[lo:hi] == 0), lo + np.flatnonzero(side[lo:hi] == 1)
        if len(left) and len(right):
            yield lo, left, right


def _likely(cells: DataFrame, least: int) -> DataFrame:
    """(key, r, c, u, v): pairs of different components whose minima agree in ``least`` places or more.

    A cell with more such pairs than rows gives one row without a pair: it is compared as a whole.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, cut in complete_groups(batches, CELL_KEY):
            rep, comp, minima = rows["rep"].to_numpy(), rows["comp"].to_numpy(), rows["minima"].to_numpy()
            spot = rows[CELL_KEY].to_numpy()
            out: list[tuple] = []
            for lo, left, right in _sides(rows, cut):
                have = np.stack([np.frombuffer(minima[i], np.uint32) for i in left])
                pairs: set[tuple[int, int]] = set()
                for j in right:
                    other = comp[left] != comp[j]
                    if other.any():
                        agree = (have[other] == np.frombuffer(minima[j], np.uint32)).sum(1)
                        pairs |= {(max(int(x), int(rep[j])), min(int(x), int(rep[j]))) for x in rep[left[other][agree >= least]]}
                if len(pairs) > len(left) + len(right):
                    out.append((*spot[lo].tolist(), None, None))
                else:
                    out += [(None, None, None, u, v) for u, v in pairs]
            yield pd.DataFrame(out, columns=[*CELL_KEY, "u", "v"], dtype=object).astype("Int64")

    return materialise(_dealt(cells).mapInPandas(work, "key long, r long, c long, u long, v long"))


def _inside(cells: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(u, v): links between components within whole cells of texts, as few as join what is linked.

    Intersections of full shingle sets come from products of incidence matrices, a slice of shingles at a time.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, cut in complete_groups(batches, CELL_KEY):
            rep, comp, texts = rows["rep"].to_numpy(), rows["comp"].to_numpy(), rows["text"].to_numpy()
            found: list[tuple[int, int]] = []
            for _, left, right in _sides(rows, cut):
                both = np.concatenate([left, right])
                sets = shingle_sets(as_bytes(texts[both]), shingle)
                sizes = np.array([len(s) for s in sets])
                owner = np.repeat(np.arange(len(both)), sizes)
                seen, column = np.unique(np.concatenate(sets), return_inverse=True)
                common = np.zeros((len(left), len(right)))
                order = np.argsort(column, kind="stable")
                owner, column = owner[order], column[order]
                for a in range(0, len(seen), SLICE):
                    x, y = np.searchsorted(column, [a, a + SLICE])
                    has = np.zeros((len(both), min(SLICE, len(seen) - a)), np.float32)
                    has[owner[x:y], column[x:y] - a] = 1
                    common += has[: len(left)] @ has[len(left) :].T
                union = sizes[: len(left), None] + sizes[None, len(left) :] - common
                group: dict[int, int] = {}

                def root(i: int) -> int:
                    while group.get(i, i) != i:
                        i = group[i]
                    return i

                for i, j in zip(*np.nonzero(100 * common >= percent * union)):
                    u, v = root(int(comp[left[i]])), root(int(comp[right[j]]))
                    if u != v:
                        group[max(u, v)] = min(u, v)
                        found.append((int(rep[left[i]]), int(rep[right[j]])))
            yield pd.DataFrame(found, columns=["u", "v"])

    return materialise(_dealt(cells).mapInPandas(work, "u long, v long"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, miss: float = 1e-6,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) per row of ``docs``: groups under shingle-set similarity.

    Two documents are linked where 100 * intersection >= percent * union of their distinct word shingles;
    groups are the connected components, named by their smallest id, whose document is the kept one.

    Equal sets are one class, represented by its smallest id. Representatives meet in bands of ROWS hash
    minima; enough bands are taken that a pair at the threshold is missed with probability ``miss``. Each
    bucket's members are first confirmed against one of them, drawn by hash, so that a large group is linked
    through several hubs. Members outside the largest component of their bucket then meet a fresh hub inside it
    and one outside, round by round, until a round links nothing or HUB_ROUNDS are over. What lies in different
    components of a bucket after that is compared across components in cells of bounded size by its minima, then confirmed on full sets too. A cell with more
    likely pairs than rows is compared whole and gives only the links that join components. So a bucket with
    a third of all rows costs about one comparison per row unless it truly holds several groups, no list of
    all pairs arises, and no link is lost.

    Null or wordless texts have size 0 and link with nothing. A row with a null id links with nothing, has a
    null component and is kept. Rows that share an id are one node; each comes back. Other columns are
    ignored; an empty table gives an empty result.
    """
    n_bands = bands_for(percent, miss)
    n_hashes = n_bands * ROWS
    signs = materialise(signatures(docs, id_col, text_col, shingle, n_hashes))
    classes = signs.filter("n_shingles > 0 and id is not null").groupBy("set_a", "set_b")
    reps = materialise(classes.agg(F.min("id").alias("rep"), F.first("minima").alias("minima")))

    width = ROWS * 4
    band = F.transform(
        F.sequence(F.lit(0), F.lit(n_bands - 1)),
        lambda i: F.xxhash64(i, F.expr("minima").substr(i * width + 1, F.lit(width))),
    )
    keyed = reps.select("rep", F.explode(band).alias("key")).distinct()
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min_by("rep", F.xxhash64("rep", "key")).alias("hub")).filter("n > 1")
    members = materialise(keyed.join(materialise(shared), "key").select("key", "rep", "hub"))

    first = members.filter("rep != hub").select(F.greatest("rep", "hub").alias("u"), F.least("rep", "hub").alias("v"))
    first = materialise(first.distinct())
    links = confirm(first, docs, id_col, text_col, shingle, percent)
    parts = materialise(connected_components(links))

    labelled = members.join(parts, members.rep == parts.node, "left")
    labelled = materialise(labelled.select("key", "rep", F.coalesce("component", "rep").alias("comp")))
    share = percent / 100
    least = math.floor(n_hashes * share - 5 * math.sqrt(n_hashes * share * (1 - share)))
    tried = first
    for turn in range(HUB_ROUNDS):
        pairs = _agreeing(_hub_pairs(labelled, turn).join(tried, ["u", "v"], "left_anti"), reps, least)
        new = confirm(pairs, docs, id_col, text_col, shingle, percent)
        if new.isEmpty():
            break
        links, tried, labelled = links.union(new), tried.union(pairs), _contracted(labelled, new)
    sizes = labelled.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    split = sizes.groupBy("key").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"), F.max("n").alias("n_big"), F.max_by("comp", F.struct("n", "comp")).alias("big"),
    ).filter("parts > 1")
    split = split.select(
        "key", "big", F.ceil(F.col("n") / CELL).cast("int").alias("n_r"), F.ceil((F.col("n") - F.col("n_big")) / CELL).cast("int").alias("n_c"),
    )
    # The minima are joined once per representative; its open buckets, one a band at most, travel as a list.
    spots = labelled.join(materialise(split), "key").groupBy("rep").agg(F.collect_list(F.struct("key", "comp", "big", "n_r", "n_c")).alias("spots"))
    open_rows = spots.join(reps.select("rep", "minima"), "rep").select("rep", "minima", F.inline("spots"))
    spot = F.xxhash64("rep", "key")
    rows = open_rows.select(
        "key", F.pmod(spot, "n_r").cast("int").alias("r"), F.explode(F.sequence(F.lit(0), F.col("n_c") - 1)).alias("c"),
        "rep", "comp", F.lit(0).alias("side"), "minima",
    )
    columns = open_rows.filter("comp != big").select(
        "key", F.explode(F.sequence(F.lit(0), F.col("n_r") - 1)).alias("r"), F.pmod(spot, "n_c").cast("int").alias("c"),
        "rep", "comp", F.lit(1).alias("side"), "minima",
    )
    cells = materialise(rows.union(columns))
    likely = _likely(cells, least)
    pairs = likely.filter("u is not null").select("u", "v").distinct().join(tried, ["u", "v"], "left_anti")
    links = links.union(confirm(pairs, docs, id_col, text_col, shingle, percent))
    whole = likely.filter("u is null").select(*CELL_KEY).distinct()
    if not whole.isEmpty():
        dense = materialise(cells.drop("minima").join(whole, CELL_KEY))
        texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        texts = materialise(only_ids(texts, "id", materialise(dense.select(F.col("rep").alias("id")).distinct())))
        texts = texts.groupBy(F.col("id").alias("rep")).agg(F.max("text").alias("text"))
        links = links.union(_inside(dense.join(texts, "rep"), shingle, percent))
    parts = materialise(connected_components(links))

    named = reps.select("set_a", "set_b", "rep").join(parts, F.col("rep") == F.col("node"), "left")
    named = materialise(named.select("set_a", "set_b", F.coalesce("component", "rep").alias("component_id"), F.lit(True).alias("linked")))
    out = signs.drop("minima").join(named, ["set_a", "set_b"], "left")
    own = (F.col("n_shingles") == 0) | F.col("id").isNull() | F.col("component_id").isNull()
    out = out.withColumn("component_id", F.when(own, F.col("id")).otherwise(F.col("component_id")))
    return out.select(
        F.col("id").alias(id_col), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )
