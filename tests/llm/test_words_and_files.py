"""Word hashing, id files and both byte-level encoders."""

import base64
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from assay.llm import bpe, idfile, words
from assay.llm.pieces import PieceCache

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
RANKS, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "a", "  a  b   c ", " x", "tail   ", "it's  they'll\n\n  foo\tbar 12 34a", "　x y z", "a\n b", "x" * 3000,
    "日本語 テスト 🎉🎉 don't", "aa! bb?! cc). dd'). 5. 5's x's, ²³ ½. Ⅷ. ", "\x00\x01 é́ á b́", "<|endoftext|> hi", "ab,) ab, ab ab.", None,
]


@given(st.text(alphabet=" \t\naAbBÄé日,.!", max_size=80), st.integers(1, 4))
@settings(max_examples=200, deadline=None)
def test_shingle_sets_count_like_plain_python(text, k):
    found = re.findall(r"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)}))
    want = {tuple(found[i : i + k]) for i in range(len(found) - k + 1)} if len(found) >= k else {tuple(found)} - {()}
    assert len(words.shingle_sets(words.as_bytes([text, "x", text]), k)[2]) == len(want)


@given(st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=40), max_size=8))
@settings(max_examples=100, deadline=None)
def test_block_round_trip(lists):
    docs = [np.array(x, np.uint32) for x in lists]
    back = idfile.unpack(idfile.pack(docs))
    assert len(back) == len(docs) and all((a == b).all() and len(a) == len(b) for a, b in zip(back, docs))


def test_frequent_ids_take_one_byte():
    ids = np.array([40_000] * 1000 + list(range(300)), np.uint32)
    assert len(idfile.pack([ids])) < 4 * 301 + 1400 + 400


@given(st.text(alphabet=" \n\t'aAbs.,!5é🎉　", max_size=60))
@settings(max_examples=300, deadline=None)
def test_serialised_model_encodes_like_tiktoken(text):
    use = bpe.codec(RANKS, public_tokenizers.PATTERN)
    ids = use.encode([text])[0]
    assert ids.tolist() == _tiktoken().encode_ordinary(text) and use.decode(ids) == text.encode()


def _tiktoken(held=[]):
    if not held:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
        held.append(tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}))
    return held[0]


def test_cache_generations_keep_codes_right():
    cache = PieceCache(lambda texts: [t.encode() for t in texts], 3)
    for text in ["a bb, ccc dddd", "bb, a eeeee", "ccc a bb, f, g", "  x y", "p q \n"] * 3:
        assert cache.codes([text])[0] == text.encode()


def test_encode_decode_of_odd_texts(spark):
    rows = [(i if i % 5 else None, t) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "'x' as ids")
    got = bpe.encode_decode(docs, RANKS, public_tokenizers.PATTERN, keep_ids=True).collect()
    want = sorted((_tiktoken().encode_ordinary(t or "") for t in ODD), key=str)
    assert sorted((r.ids for r in got), key=str) == want and len(got) == len(rows)
    assert bpe.encode_decode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_id_files_in_order(spark, tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(idfile, "BLOCK_IDS", 50)
    rows = [(7 * i % 31, ODD[i % len(ODD)]) for i in range(40)] + [(None, "null id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as part", "2 as key")
    idfile.write_ids(docs, str(tmp_path / "ids"), JSON, 2)
    got = sorted(idfile.read_ids(spark, str(tmp_path / "ids")).collect(), key=lambda r: r.start)
    plain = Tokenizer.from_file(JSON)
    plain.encode_special_tokens = True
    coded = {(i, t): plain.encode(t or "", add_special_tokens=False).ids + [2] for i, t in rows}
    ids = [None if r.id is None else int(r.id) for r in got]
    assert ids == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    assert [r.start for r in got] == [sum(len(bytes(x.ids)) // 4 for x in got[:k]) for k in range(len(got))]
    have = sorted((-1 if r.id is None else int(r.id), zlib.crc32(bytes(r.ids))) for r in got)
    assert have == sorted((-1 if i is None else i, zlib.crc32(np.array(c, "<u4").tobytes())) for (i, t), n in _counted(rows).items() for c in [coded[i, t]] * n)
    idfile.write_ids(docs.limit(0), str(tmp_path / "none"), JSON, 2)
    assert idfile.read_ids(spark, str(tmp_path / "none")).count() == 0


def _counted(rows):
    out = {}
    for r in rows:
        out[r] = out.get(r, 0) + 1
    return out
