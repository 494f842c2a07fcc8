"""Byte-level BPE by a sentencepiece model that is serialised straight from a rank vocabulary."""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

from assay.llm.pieces import PieceCache, mapped
from assay.llm.words import runs

# Field numbers and enum values of the public sentencepiece model format.
_PIECE, _TRAINER, _NORMALIZER = 1, 2, 3
_NORMAL, _UNKNOWN, _BPE = 1, 2, 2
CACHED = 150_000  # pieces per generation that a worker keeps


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a file of base64 tokens and ranks."""
    pairs = [line.split() for line in open(path, "rb").read().splitlines() if line.strip()]
    out = [b""] * len(pairs)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out) + bytes([n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose piece i is token i with score -i, byte-mapped; one unknown piece follows.

    Normalisation is the identity: no prefix, no escaping, no white-space folding.
    """
    pieces = [
        _block(_PIECE, _block(1, mapped_token(t).encode()) + b"\x15" + struct.pack("<f", -i) + _number(3, _NORMAL))
        for i, t in enumerate(tokens)
    ]
    pieces.append(_block(_PIECE, _block(1, b"<unk>") + b"\x15" + struct.pack("<f", 0.0) + _number(3, _UNKNOWN)))
    trainer = _number(3, _BPE) + _number(4, len(pieces)) + _number(40, len(tokens)) + _number(41, -1) + _number(42, -1) + _number(43, -1)
    normalizer = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + _block(_TRAINER, trainer) + _block(_NORMALIZER, normalizer)


def mapped_token(token: bytes) -> str:
    from assay.llm.pieces import _MAP

    return token.decode("latin-1").translate(_MAP)


class Codec:
    """Encoder and decoder of one vocabulary; ids are ranks."""

    def __init__(self, tokens: list[bytes], pattern: str) -> None:
        import sentencepiece

        self.tokens = np.array([*tokens, b""], object)
        self.model = sentencepiece.SentencePieceProcessor()
        self.model.LoadFromSerializedProto(serialise(tokens))
        self.split = regex.compile(pattern).findall
        self.cache = PieceCache(self._codes, CACHED)

    def _codes(self, texts: list[str]) -> list[bytes]:
        """32-bit ids of each text, by its pre-tokens."""
        parts = [[mapped(m) for m in self.split(t)] for t in texts]
        ids = iter(self.model.encode([m for p in parts for m in p], num_threads=1))
        return [np.array([i for _ in p for i in next(ids)], np.uint32).tobytes() for p in parts]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        return [np.frombuffer(c, np.uint32) for c in self.cache.codes(texts)]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that ids stand for."""
        return b"".join(self.tokens[ids].tolist())


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file, one per Python worker."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(read_ranks(path), pattern)
    return _codecs[path, pattern]


def encode_decode(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False,
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256[, ids]) per row: ids of the whole text and what they decode to.

    Each match of ``pattern`` is encoded by itself. ids_sha256 is the lowercase hex SHA-256 of the decimal ids
    joined by one space, decoded_sha256 that of the decoded bytes; with ``keep_ids`` the ids come as
    array<int> too. A null text counts as empty: no ids, digests of nothing. Ids may be null or repeat: each
    row comes back. Other columns are ignored; an empty table gives an empty result. The work is one map
    over the input; a worker holds the vocabulary, a bounded piece cache and about a megabyte of text, or
    one longer text.
    """
    import hashlib

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        use = codec(path, pattern)
        spelled = np.array([str(i) for i in range(len(use.tokens))], object)
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            for a, b in runs(texts):
                rows = []
                for ids in use.encode(texts[a:b]):
                    digest = hashlib.sha256(" ".join(spelled[ids].tolist()).encode()).hexdigest()
                    row = [len(ids), digest, hashlib.sha256(use.decode(ids)).hexdigest()]
                    rows.append([*row, ids.astype(np.int32)] if keep_ids else row)
                out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids)
                out.insert(0, "id", batch["id"].iloc[a:b].to_numpy())
                yield out

    schema = "id string, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).mapInPandas(work, schema)
    kind = docs.schema[id_col].dataType
    return rows.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)
