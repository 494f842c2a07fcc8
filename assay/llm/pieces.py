"""Cutting texts into pieces that a byte-level BPE treats independently, and a bounded cache of their codes.

A single space between two other non-space characters always opens a new pre-token of the fixed pattern,
so a text may be cut before each such space and the pieces' codes joined. Most pieces of a corpus repeat,
so each is encoded once while it stays in the cache.
"""

from __future__ import annotations

import re
from collections.abc import Callable

CACHE_PIECES = 300_000  # per generation and Python worker; some 250 bytes each
_SAFE = re.compile(r"(?<=\S) (?=\S)")
_TAIL = ".,;:!?%$#*&|)]}\""


def mapped_bytes() -> dict[int, str]:
    """The printable character that stands for each byte: itself where printable, else one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_MAP = mapped_bytes()


def mapped(text: str) -> str:
    """A text's UTF-8 bytes as mapped characters."""
    return text.encode("utf-8", "surrogatepass").decode("latin-1").translate(_MAP)


class PieceCache:
    """Code of each piece under ``encode``, a function from a list of strings to a list of byte strings.

    Codes of neighbouring pieces can be joined. Two generations bound the memory: when the young one is
    full it becomes the old one, and pieces still in use move up again.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], capacity: int = CACHE_PIECES) -> None:
        self.encode, self.capacity = encode, capacity
        self.young: dict[str, bytes | None] = {}
        self.old: dict[str, bytes | None] = {}
        self.tails: dict[str, bytes] = {}

    def codes(self, texts: list[str]) -> list[bytes]:
        """Code of each text."""
        if len(self.young) > self.capacity:
            self.old, self.young = self.young, {}
        cut = [t.split(" ") for t in texts]
        known = self.young
        self._learn({p for pieces in cut for p in pieces if p not in known})
        heads = self.encode([p[0] for p in cut])
        out = []
        for text, head, pieces in zip(texts, heads, cut):
            try:
                odd = pieces[0] == "" or pieces[0][-1].isspace()
                del pieces[0]
                out.append(self._careful(text) if odd else head + b"".join(map(known.__getitem__, pieces)))
            except TypeError:  # a piece with white space at its edge has no code of its own
                out.append(self._careful(text))
        return out

    def _learn(self, missing: set[str]) -> None:
        """Codes of pieces behind a space; a piece's closing marks are a pre-token apart from a letter before them."""
        young, old = self.young, self.old
        cores: dict[str, str] = {}
        for p in missing:
            if p in old:
                young[p] = old[p]
            elif p == "" or p[0].isspace() or p[-1].isspace():
                young[p] = None
            else:
                core = p.rstrip(_TAIL)
                cores[p] = core if core and core[-1].isalpha() else p
        new = list({c for c in cores.values() if c not in young and c not in old})
        young.update(zip(new, self.encode([" " + c for c in new])))
        tails = list({p[len(c):] for p, c in cores.items() if p != c}.difference(self.tails))
        if len(self.tails) > 10_000:
            self.tails = {}
            tails = list({p[len(c):] for p, c in cores.items() if p != c})
        self.tails.update(zip(tails, self.encode(tails)))
        for p, c in cores.items():
            if p != c:
                code = young.get(c)
                young[p] = (old[c] if code is None else code) + self.tails[p[len(c):]]

    def _careful(self, text: str) -> bytes:
        """Cut only at single spaces between other characters; edges of the text stay whole."""
        pieces = _SAFE.split(text)
        head = self.encode([pieces[0]])[0]
        plain = {p for p in pieces[1:] if not p[-1].isspace()}
        self._learn(plain.difference(self.young))
        return b"".join([head, *[self.young[p] if p in plain else self.encode([" " + p])[0] for p in pieces[1:]]])
