import functools
import math
import re

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece as library

from trendspark.llm import sentencepiece as sp

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [None, "", " ", "   ", "Hello world", " two  blanks   and end ", "ends ", "a▁b ▁ c", "日本語テキスト 😀 naïve\n\ttabs", "ΑΒΓ ѣ \x00\x01",
         "word " * 300, "x" * 700, "ab" * 60 + "😀" * 50, "it's 12,345.67!?", "Hello world", "\n", "𓀀𓀁 é́"]


@pytest.fixture(scope="module")
def p():
    return sp.Pieces(PATH)


def brute(p, text):
    """Plain dynamic programming over the characters of each chunk."""
    return [i for c in re.findall(" *[^ ]+| +", " " + text) for i in brute_chunk(p, c)] if text else []


@functools.lru_cache(1)
def keys_of(p):
    return {t: i for i, t in enumerate(p.text) if math.isfinite(p.score[i])}


@functools.lru_cache(100_000)
def brute_chunk(p, chunk):
    key = keys_of(p)
    longest = 48
    chars = [sp.MARK if c == " " else "\0own" if c == sp.MARK else c for c in chunk]
    best, back = [0.0] + [-math.inf] * len(chars), [None] * (len(chars) + 1)
    for i in range(len(chars)):
        single = False
        for j in range(i + 1, min(len(chars), i + longest) + 1):
            piece = key.get("".join(chars[i:j])) if "\0own" not in chars[i:j] else None
            if piece is not None:
                single |= j == i + 1
                if best[i] + p.score[piece] > best[j]:
                    best[j], back[j] = best[i] + p.score[piece], (i, [piece])
        if not single and best[i] + p.unknown > best[i + 1]:
            raw = (sp.MARK if chars[i] == "\0own" else chars[i]).encode()
            best[i + 1], back[i + 1] = best[i] + p.unknown, (i, [p.byte[b] for b in raw])
    ids, at = [], len(chars)
    while at:
        at, piece = back[at]
        ids = piece + ids
    return ids


def test_equals_brute_force_and_round_trip(spark, p):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "null id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as ids", "'y' as decoded")
    out = sp.decode(sp.encode(df)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (None if r.ids is None else list(r.ids)) == (None if r.text is None else brute(p, r.text))
        assert r.decoded == r.text


def test_documents(spark, p):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    text = {r.doc_id: r.text for r in df.collect()}
    out = sp.digest(df).collect()
    assert len(out) == len(text) and all(r.round_trip for r in out)
    for r in sorted(out, key=lambda r: len(text[r.doc_id]))[:25]:
        assert list(r.ids) == brute(p, text[r.doc_id])
        assert r.n_tokens == len(r.ids) and r.n_byte_tokens == sum(i in p.byte.values() for i in r.ids)


def test_long_and_padded_paths_agree(p, monkeypatch):
    chunks = [" " + t for t in TEXTS if t]
    chunks = pa.array([p._prepared(c) for c in chunks], pa.binary())
    ids, n = p.segment(chunks)
    monkeypatch.setattr(sp, "LONG", 0)
    again = p.segment(chunks)
    assert ids.tolist() == again[0].tolist() and n.tolist() == again[1].tolist()


def test_memo_starts_anew(p, monkeypatch):
    """With a memo that holds next to nothing, ids are the same."""
    texts = pa.array(TEXTS * 3)
    want = [x.tolist() for x in p.encode(texts)]
    small = sp.Pieces(PATH)
    small.memo.limit = 100
    for _ in range(2):
        assert [x.tolist() for x in small.encode(texts)] == want
    assert small.memo.words.nbytes < 100


def test_digest_of_odd_tables(spark, p):
    rows = [(1, "Hello world"), (1, "Hello world"), (None, None), (None, ""), (2, "long " * 200_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as ids", "2 as round_trip", "3 as __text2")
    got = sorted(((r.doc_id, None if r.ids is None else list(r.ids), r.n_tokens, r.round_trip) for r in sp.digest(df).collect()), key=str)
    want = [(i, None if t is None else brute(p, t), len(brute(p, t or "")), True) for i, t in rows]
    assert got == sorted(want, key=str)
    assert sp.digest(df.limit(0)).collect() == []


def test_equals_library_unigram(p, tmp_path):
    """The library's own unigram model over the same pieces and scores."""
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    m = proto.ModelProto()
    m.ParseFromString(open(PATH, "rb").read())
    m.trainer_spec.model_type = 1
    for i, piece in enumerate(m.pieces):
        if math.isfinite(p.score[i]):
            piece.score = float(p.score[i])
    model = library.SentencePieceProcessor(model_proto=m.SerializeToString())
    for t in TEXTS:
        if t and sp.MARK not in t and "\0" not in t:
            ours, theirs = brute(p, t), model.encode(t)
            cost = lambda ids: sum(p.score[i] for i in ids if math.isfinite(p.score[i]))
            assert ours == theirs or abs(cost(ours) - cost(theirs)) < 1e-3 * len(ours)  # the library adds in single precision


def test_trie_holds_exactly_its_keys():
    keys = {b"a": 0, b"ab": 1, b"abc": 2, b"b": 3, b"\xff\xfe": 4, b"\x00": 5, b"ca": 6}
    t = sp.DoubleArray(keys)

    def get(k):
        s = 0
        for b in k:
            n = int(t.base[s]) + b
            if n == 0 or n >= len(t.check) or t.check[n] != s:
                return None
            s = n
        return int(t.end[s]) if t.end[s] >= 0 else None
    assert {k: get(k) for k in keys} == keys
    assert get(b"c") is None and get(b"abd") is None and get(b"") is None


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert sp.digest(df).collect() == []
