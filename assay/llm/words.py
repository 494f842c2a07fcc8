"""Vectorised word hashing of text batches, shared by the word-based operators.

A word is a run of bytes outside space and \\x09-\\x0D, with A-Z lower-cased; a null text has no words.
Word hashes are 64-bit polynomial hashes over a random byte table; texts are handled in runs of about
a megabyte, so temporary arrays stay small however large a batch is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

RUN_BYTES = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20_240_101).integers(1, 1 << 63, 256, dtype=np.uint64)
_VALUE = _BYTE[_LOWER]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit values; a bijection."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class _Powers:
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def grow(cls, n: int) -> None:
        if len(cls.up) < n:
            n = max(n, RUN_BYTES * 2)
            inverse = pow(_BASE, -1, 1 << 64)
            cls.up = np.concatenate([np.ones(1, np.uint64), np.full(n - 1, _BASE, np.uint64)]).cumprod(dtype=np.uint64)
            cls.down = np.concatenate([np.ones(1, np.uint64), np.full(n - 1, inverse, np.uint64)]).cumprod(dtype=np.uint64)


def runs(raws: list[bytes], limit: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of neighbouring texts of about ``limit`` bytes together; a longer text stands alone."""
    start, size = 0, 0
    for i, raw in enumerate(raws):
        if size and size + len(raw) > limit:
            yield start, i
            start, size = i, 0
        size += len(raw) + 1
    if start < len(raws):
        yield start, len(raws)


def byte_runs(texts, limit: int = RUN_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """(start, end, UTF-8 bytes) of neighbouring texts of about ``limit`` characters together."""
    texts = [t if isinstance(t, str) else "" for t in texts]
    for a, b in runs(texts, limit):
        yield a, b, as_bytes(texts[a:b])


def as_bytes(texts) -> list[bytes]:
    """UTF-8 bytes of each text; null becomes empty."""
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]


def word_hashes(raws: list[bytes], blank: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text and one past the last, byte start, byte end of words).

    Byte places count from the start of the joined texts, with one byte between texts.
    """
    joined = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
    gap = blank[joined]
    edge = np.flatnonzero(np.diff(gap.view(np.int8), prepend=np.int8(1)))
    begin, end = edge[0::2], edge[1::2]
    _Powers.grow(len(joined) + 1)
    total = np.cumsum(_VALUE[joined] * _Powers.up[: len(joined)], dtype=np.uint64)
    before = np.where(begin > 0, total[begin - 1], _U(0)) if len(begin) else np.zeros(0, np.uint64)
    last = total[end - 1] if len(end) else before
    hashes = mix((last - before) * _Powers.down[begin] + (end - begin).astype(np.uint64) * _U(0xD6E8FEB86659FD93))
    offsets = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raws])]) if raws else np.zeros(1, np.int64)
    return hashes, np.searchsorted(begin, offsets), begin, end


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words (by first word, across text borders too; mask those yourself)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * _U(0x2545F4914F6CDD1D) + hashes[j : j + n]
    return mix(out)


def shingle_sets(raws: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct k-word shingles of each text; fewer words form one shingle; no words, none."""
    out: list[np.ndarray] = []
    for a, b in runs(raws):
        hashes, first, _, _ = word_hashes(raws[a:b])
        all_grams = grams(hashes, k)
        for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
            if hi - lo >= k:
                out.append(np.unique(all_grams[lo : hi - k + 1]))
            elif hi > lo:
                whole = grams(hashes[lo:hi], hi - lo)
                out.append(mix(whole + _U(hi - lo)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out
