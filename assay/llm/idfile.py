"""Token-id files: frequency-ranked ids in byte-aligned variable length with separate control bytes.

A file set is a Parquet table of blocks, so Spark's committer, retries and any store it writes to hold.
One block is: magic, counts of documents, ids and ranks; the id of each rank, most frequent first; the
length of each document; two control bits per id (its rank's byte count less one, four ids to a byte);
then the ranks' bytes, low byte first.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from assay.llm.frames import BROADCAST_IDS
from assay.llm.pieces import PieceCache, mapped
from assay.llm.words import runs

MAGIC = b"AID1"
BLOCK_IDS = 4 << 20  # ids that close a block
TABLE_IDS = 1 << 24  # ids below this are ranked by a table
PART_CHARS = 24 << 20  # characters of text per file
_HEAD = struct.Struct("<4sIII")
_SIZES = np.array([[(c >> s & 3) + 1 for s in (0, 2, 4, 6)] for c in range(256)], np.uint8)


def pack(docs: list[np.ndarray]) -> bytes:
    """One block of the documents' ids."""
    ids = np.concatenate(docs) if docs else np.zeros(0, np.uint32)
    if len(ids) and ids.max() < TABLE_IDS:  # a vocabulary's ids: count and look up, no sorting of the text
        counts = np.bincount(ids)
        values = np.flatnonzero(counts)
        counts, place = counts[values], None
    else:
        values, place, counts = np.unique(ids, return_inverse=True, return_counts=True)
    order = np.lexsort((values, -counts))
    rank_of = np.empty(len(order), np.uint32)
    rank_of[order] = np.arange(len(order), dtype=np.uint32)
    if place is None:
        by_id = np.zeros(int(values[-1]) + 1, np.uint32)
        by_id[values] = rank_of
        ranks = by_id[ids]
    else:
        ranks = rank_of[place]
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(ids) // 4) * 4, np.uint8)
    padded[: len(ids)] = size - 1
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    four = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)
    data = four[np.arange(4) < size[:, None]]
    lengths = np.array([len(d) for d in docs], "<u4")
    head = _HEAD.pack(MAGIC, len(docs), len(ids), len(order))
    return head + values[order].astype("<u4").tobytes() + lengths.tobytes() + control.astype(np.uint8).tobytes() + data.tobytes()


def unpack(block: bytes) -> list[np.ndarray]:
    """The documents' ids of one block, by table lookup over its control bytes."""
    magic, n_docs, n_ids, n_ranks = _HEAD.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a token-id block")
    at = _HEAD.size
    ids = np.frombuffer(block, "<u4", n_ranks, at)
    at += 4 * n_ranks
    lengths = np.frombuffer(block, "<u4", n_docs, at)
    at += 4 * n_docs
    n_control = -(-n_ids // 4)
    size = _SIZES[np.frombuffer(block, np.uint8, n_control, at)].ravel()[:n_ids]
    data = np.frombuffer(block, np.uint8, offset=at + n_control)
    start = np.cumsum(size, dtype=np.int64) - size
    ranks = data[start].astype(np.uint32) if n_ids else np.zeros(0, np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(size > k)
        ranks[longer] |= data[start[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return np.split(ids[ranks], np.cumsum(lengths.astype(np.int64))[:-1]) if n_docs else []


class Encoder:
    """A tokenizers file as an encoder of whole texts; special strings in a text are ordinary text."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.cache = PieceCache(self._codes)

    def _codes(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        tokenize = self.tokenizer.model.tokenize
        rest = []
        for i, t in enumerate(texts):
            if t[1:].isalpha() and (t[0] == " " or t[0].isalpha()):  # one pre-token: straight to the merges
                out[i] = np.array([x.id for x in tokenize(mapped(t))], "<u4").tobytes()
            else:
                rest.append(i)
        for a in range(0, len(rest), 512):
            some = rest[a : a + 512]
            for i, e in zip(some, self.tokenizer.encode_batch_fast([texts[i] for i in some], add_special_tokens=False)):
                out[i] = np.array(e.ids, "<u4").tobytes()
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        return self.cache.codes(texts)


_encoders: dict[str, Encoder] = {}


def write_ids(docs: DataFrame, folder: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id`` and write blocks in ascending id order to ``folder``.

    A null text counts as empty and gives the end id alone. Null ids come first; rows that share an id stay
    side by side and are all written. Other columns are ignored; an empty table writes no blocks. Documents
    are dealt by ranges of the id, so each task writes a run of them in order and holds one block at a time.
    """
    spark = docs.sparkSession
    chars = docs.agg(F.sum(F.length(text_col))).first()[0] or 0
    n_parts = max(spark.sparkContext.defaultParallelism, -(-chars // PART_CHARS))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        end = np.array([end_id], "<u4").tobytes()
        keys: list[str | None] = []
        ids: list[np.ndarray] = []
        size, seq = 0, 0

        def block(part: int) -> pd.DataFrame:
            return pd.DataFrame({"part": [part], "seq": [seq], "n_ids": [size], "keys": [keys], "block": [pack(ids)]})

        part = 0
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            part = int(batch["part"].iloc[0]) if len(batch) else part
            for a, b in runs(texts):
                for key, code in zip(batch["id"].iloc[a:b], _encoders[path].encode(texts[a:b])):
                    keys.append(key)
                    ids.append(np.frombuffer(code + end, "<u4"))
                    size += len(ids[-1])
                    if size >= BLOCK_IDS:
                        yield block(part)
                        keys, ids, size, seq = [], [], 0, seq + 1
        if ids:
            yield block(part)

    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange(n_parts, "key").sortWithinPartitions("key")
    rows = rows.select(F.col("key").cast("string").alias("id"), "text", F.spark_partition_id().alias("part"))
    rows.mapInPandas(work, "part int, seq int, n_ids long, keys array<string>, block binary").write.parquet(folder)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(id text, start, ids): each document's ids as little-endian 32-bit binary, and how many ids come before it."""
    blocks = spark.read.parquet(folder)
    inside = Window.partitionBy("part").orderBy("seq")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    firsts = blocks.select("part", "seq", (F.sum("n_ids").over(inside) - F.col("n_ids")).alias("offset")).join(parts, "part")
    few = firsts.count() <= BROADCAST_IDS  # one row per block; beyond that the blocks are joined by a shuffle
    rows = blocks.join(F.broadcast(firsts) if few else firsts, ["part", "seq"]).select((F.col("base") + F.col("offset")).alias("base"), "keys", "block")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for base, keys, block in zip(batch["base"], batch["keys"], batch["block"]):
                docs = unpack(block)
                sizes = np.array([len(d) for d in docs], np.int64)
                starts = base + np.cumsum(sizes) - sizes
                for a in range(0, len(docs), 1024):
                    yield pd.DataFrame({"id": list(keys[a : a + 1024]), "start": starts[a : a + 1024], "ids": [d.tobytes() for d in docs[a : a + 1024]]})

    return rows.mapInPandas(work, "id string, start long, ids binary")
