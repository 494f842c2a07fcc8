"""SimHash groups: fingerprints of word shingles, pivot distance tables, star components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from assay.llm.components import connected_components
from assay.llm.frames import complete_groups
from assay.llm.words import byte_runs, mix
from assay.session import materialise

BITS = 64
BLOCKS = 4  # the bits are referred to in so many blocks
BUCKET = 256  # fingerprints of one key that are compared through their tables; more are linked through shared neighbours
PAIRS = 1 << 16  # pairs looked at together
_U = np.uint64
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_ONES = _U(0x0101010101010101)


# --- fingerprints ---

def run_fingerprints(raws: list[bytes], k: int, seed: int) -> np.ndarray:
    """The 64-bit fingerprint of each text; texts without words get zero."""
    lower = np.frombuffer(b"\n".join(raws).lower() + b"\n", np.uint8)
    gap = _BLANK[lower]
    keep = ~gap | np.append(False, ~gap[:-1])  # one blank after each word
    own = np.repeat(np.arange(len(raws)), [len(r) + 1 for r in raws])[keep]
    flat = np.where(gap, np.uint8(0x20), lower)[keep]
    end = np.flatnonzero(flat == 0x20)
    begin = np.append(0, end[:-1] + 1)[: len(end)]
    owner = own[begin] if len(end) else np.zeros(0, np.int64)
    first = np.searchsorted(owner, np.arange(len(raws) + 1))
    n_words = np.diff(first)
    # First and last word of every shingle, in text order.
    n_grams = np.where(n_words >= k, n_words - k + 1, np.minimum(n_words, 1))
    at = np.repeat(first[:-1] - np.append(0, np.cumsum(n_grams)[:-1]), n_grams) + np.arange(n_grams.sum())
    last = np.minimum(at + k, np.repeat(first[1:], n_grams)) - 1
    whole, digest = flat.tobytes(), xxhash.xxh64_intdigest
    spans = zip(begin[at].tolist(), end[last].tolist())
    hashes = np.fromiter((digest(whole[a:b], seed) for a, b in spans), np.uint64, len(at))
    out = np.zeros(len(raws), np.uint64)
    full = np.flatnonzero(n_grams)
    if len(full):
        out[full] = _majority(hashes, n_grams[full])
    return out


def _majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Bits set in over half of the hashes of each group of neighbouring hashes.

    Eight bits are counted at once in the bytes of a word, over 255 hashes at most, then summed per group.
    """
    parts = -(-sizes // 255)
    begin = np.append(0, np.cumsum(sizes)[:-1])
    nth = np.arange(parts.sum()) - np.repeat(np.append(0, np.cumsum(parts)[:-1]), parts)
    starts = np.repeat(begin, parts) + nth * 255
    groups = np.append(0, np.cumsum(parts)[:-1])
    bits = np.zeros((len(sizes), BITS), np.uint8)
    for j in range(8):
        lanes = np.add.reduceat((hashes >> _U(j)) & _ONES, starts).astype("<u8").view(np.uint8).reshape(-1, 8)
        counts = np.add.reduceat(lanes.astype(np.int64), groups, axis=0)
        bits[:, j::8] = 2 * counts > sizes[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(id, fp) per row of ``docs``; fp is the fingerprint as a signed 64-bit number."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo, hi, raws in byte_runs(batch["text"]):
                yield pd.DataFrame({"id": batch["id"].iloc[lo:hi].to_numpy(), "fp": run_fingerprints(raws, shingle, seed).view(np.int64)})

    # Nullable ids travel as text, which pandas keeps exact.
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(work, "id string, fp long").withColumn("id", F.col("id").cast("long"))


# --- pivot distance tables ---

def references(blocks: int = BLOCKS) -> np.ndarray:
    """Zero, then for each block of bits as many reference fingerprints as it has bits, zero outside the block.

    Inside the block they are the rows of a Hadamard matrix, all ones standing for the row of zeros, so that
    their distances, less the distance to zero, tell any two fillings of the block apart.
    """
    width = BITS // blocks
    if blocks * width != BITS or width & (width - 1):
        raise ValueError("blocks must be a power of two up to 64")
    place = np.arange(width)
    rows = np.bitwise_count(place[:, None] & place[None, :]) & 1
    rows[0] = 1
    local = (rows.astype(np.uint64) << place.astype(np.uint64)).sum(1, dtype=np.uint64)
    return np.concatenate([[_U(0)], *[local << _U(width * b) for b in range(blocks)]])


def distance_table(prints: np.ndarray, blocks: int = BLOCKS) -> np.ndarray:
    """Hamming distances of each fingerprint to every reference, one row each."""
    return np.bitwise_count(prints[:, None] ^ references(blocks)[None, :]).astype(np.int8)


def table_keys(prints: np.ndarray, radius: int, blocks: int = BLOCKS) -> np.ndarray:
    """Keys of each fingerprint, one per choice of all but ``radius`` blocks.

    A key is a digest of the distances to the chosen blocks' references less the distance to zero. Two
    fingerprints at most ``radius`` bits apart differ in that many blocks at most, so one of their keys is equal.
    """
    table = distance_table(prints, blocks)
    local = (table[:, 1:] - table[:, :1]).astype(np.int64).reshape(len(prints), blocks, -1)
    digest = np.zeros((len(prints), blocks), np.uint64)
    for i in range(local.shape[2]):
        digest = mix(digest * _U(0x2545F4914F6CDD1D) + local[:, :, i].view(np.uint64) + _U(i + 1))
    keys = []
    for n, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        key = np.full(len(prints), _U(n + 1))
        for b in chosen:
            key = mix(key * _U(0x9E3779B97F4A7C15) + digest[:, b])
        keys.append(key)
    return np.stack(keys, 1)


def near_pairs(prints: np.ndarray, radius: int, blocks: int = BLOCKS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of fingerprints at most ``radius`` bits apart, some at a time.

    Rows are sorted by their distance to the first reference; pairs whose distances to some reference differ
    by more than ``radius`` are discarded, reference by reference, and the survivors are compared bit by bit.
    """
    order = np.argsort(np.bitwise_count(prints), kind="stable")
    table = distance_table(prints[order], blocks)
    reach = np.searchsorted(table[:, 0], table[:, 0] + radius, "right") - np.arange(len(prints)) - 1
    for lo, hi in _slices(reach):
        i = np.repeat(np.arange(lo, hi), reach[lo:hi])
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(reach[lo:hi]) - reach[lo:hi], reach[lo:hi])
        for c in range(1, table.shape[1]):
            if not len(i):
                break
            good = np.abs(table[i, c] - table[j, c]) <= radius
            i, j = i[good], j[good]
        i, j = order[i], order[j]
        true = np.bitwise_count(prints[i] ^ prints[j]) <= radius
        yield i[true], j[true]


def _slices(reach: np.ndarray) -> Iterator[tuple[int, int]]:
    lo, n = 0, 0
    for i, r in enumerate(reach.tolist()):
        n += r
        if n >= PAIRS:
            yield lo, i + 1
            lo, n = i + 1, 0
    if lo < len(reach):
        yield lo, len(reach)


def spanning_links(prints: np.ndarray, radius: int, blocks: int = BLOCKS) -> list[tuple[int, int]]:
    """Index pairs that join whatever near pairs join: fewer than there are fingerprints."""
    root = np.arange(len(prints))
    out: list[tuple[int, int]] = []
    for i, j in near_pairs(prints, radius, blocks):
        while True:
            open_ = np.flatnonzero(root[i] != root[j])
            if not len(open_):
                break
            i, j = i[open_], j[open_]
            low, high = np.minimum(root[i], root[j]), np.maximum(root[i], root[j])
            # Of all links that end in one root, one is taken; roots only ever point downwards.
            high, one = np.unique(high, return_index=True)
            root_of = np.arange(len(root))
            root_of[high] = low[one]
            while (root_of[root_of] != root_of).any():
                root_of = root_of[root_of]
            root = root_of[root]
            out += zip(i[one].tolist(), j[one].tolist())
    return out


def _links_of_small_keys(rows: DataFrame, radius: int, blocks: int) -> DataFrame:
    """(u, v) that link the fingerprints of each key; at most BUCKET rows a key."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group, cut in complete_groups(batches, ["key"]):
            rep, prints = group["rep"].to_numpy(), group["fp"].to_numpy().view(np.uint64)
            found = [(rep[lo + i], rep[lo + j]) for lo, hi in zip(cut[:-1], cut[1:]) for i, j in spanning_links(prints[lo:hi], radius, blocks)]
            yield pd.DataFrame(found, columns=["u", "v"], dtype="int64")

    return rows.repartition("key").sortWithinPartitions("key").mapInPandas(work, "u long, v long")


def _links_of_large_keys(classes: DataFrame, radius: int) -> DataFrame:
    """(u, v) that link whatever lies ``radius`` (two at most) bits apart, without comparing pairs.

    Each fingerprint is sent to itself and to the 64 fingerprints one bit away. Two at two bits meet at one
    of these points, which has room for 65 fingerprints, and are linked to the least one there; two that meet
    at one bit or none when ``radius`` is two are at most two bits apart.
    """
    if radius > 2:
        raise ValueError("radius is two bits at most")
    points = F.expr(f"transform(sequence(0, {BITS - 1}), b -> fp ^ shiftleft(1L, b))")
    sent = classes.select("rep", "fp", F.explode(F.concat(F.array("fp"), points)).alias("point"))
    met = sent.groupBy("point").agg(F.collect_list(F.struct("rep", "fp")).alias("all")).filter(F.size("all") > 1)
    pairs = met.select(F.array_min("all").alias("hub"), F.explode("all").alias("one"))
    near = F.bit_count(F.col("one.fp").bitwiseXOR(F.col("hub.fp"))) <= radius
    return pairs.filter(near).select(F.col("one.rep").alias("u"), F.col("hub.rep").alias("v")).filter("u != v").distinct()


def _links_of_ids(prints: DataFrame, classes: DataFrame) -> DataFrame:
    """(u, v) that link the classes of ids with several fingerprints."""
    several = prints.groupBy("id").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).filter("a != b").select("id")
    held = prints.join(several, "id").distinct().join(classes, "fp").select("id", "rep")
    hubs = held.groupBy("id").agg(F.min("rep").alias("hub"))
    return held.join(hubs, "id").select(F.col("rep").alias("u"), F.col("hub").alias("v")).filter("u != v")


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42, radius: int = 2, blocks: int = BLOCKS,
) -> DataFrame:
    """(id, fingerprint, component_id) per row of ``docs``: groups of fingerprints ``radius`` bits apart or less.

    A text's words are runs outside space and \\x09-\\x0D with A-Z lower-cased; its shingles are all runs of
    ``shingle`` words joined by spaces (fewer words: all of them; none: fingerprint zero). A bit is one if it
    is one in over half of the shingles' XXH64 digests. Groups are the connected components of fingerprints
    at most ``radius`` (0 to 2) bits apart, named by their smallest id.

    Equal fingerprints are one class. Each class computes its distances to the reference fingerprints once.
    Classes meet where their tables agree on all references of all but ``radius`` blocks of bits, which two
    fingerprints that near always do for some choice of blocks; pairs whose tables differ by more than ``radius`` at
    some reference are discarded, the rest compared bit by bit. Keys with over BUCKET classes are linked
    through shared neighbours instead, exactly and in linear work. No list of all pairs arises, and no link is lost.

    Null or wordless texts have fingerprint zero and link like any other. A row with a null id has its
    fingerprint, a null component, and links nothing. Rows that share an id are one node; each comes back.
    Other columns are ignored; an empty table gives an empty result.
    """
    if not 0 <= radius <= 2 or radius >= blocks:
        raise ValueError("radius is two bits at most and less than the number of blocks")
    prints = materialise(fingerprints(docs, id_col, text_col, shingle, seed))
    given = prints.filter("id is not null")
    classes = materialise(given.groupBy("fp").agg(F.min("id").alias("rep")))

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = table_keys(batch["fp"].to_numpy().view(np.uint64), radius, blocks)
            n = keys.shape[1]
            yield pd.DataFrame({
                "key": keys.ravel().view(np.int64), "rep": np.repeat(batch["rep"].to_numpy(), n), "fp": np.repeat(batch["fp"].to_numpy(), n),
            })

    keys = materialise(classes.select("rep", "fp").mapInPandas(keyed, "key long, rep long, fp long"))
    shared = materialise(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    busy = materialise(keys.join(shared, "key"))
    links = _links_of_small_keys(busy.filter(F.col("n") <= BUCKET).drop("n"), radius, blocks)
    crowded = busy.filter(F.col("n") > BUCKET).select("rep", "fp").distinct()
    links = links.union(_links_of_large_keys(crowded, radius))
    links = materialise(links.union(_links_of_ids(given, classes)))
    parts = materialise(connected_components(links))

    named = classes.join(parts, F.col("rep") == F.col("node"), "left")
    named = materialise(named.select("fp", F.coalesce("component", "rep").alias("component")))
    out = prints.join(named, "fp", "left")
    component = F.when(F.col("id").isNotNull(), F.col("component"))
    return out.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), component.alias("component_id"))
