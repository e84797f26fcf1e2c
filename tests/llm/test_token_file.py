import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from trendspark.llm import rans
from trendspark.llm import token_file as tf

TEXTS = ["", None, " ", "  ", "   ", " a", "  a", "   a", "a ", "a  ", "a\n b", "a \nb", "a\n  b", "a \n x", "a\n \nb", "a\t\tb  c   d",
         "Hello, world's 'end's.\n\nİstanbul ﬁne  x", "a<|endoftext|>b <|endoftext|> c<|endoftext", "x   y", "x   y",
         "word " * 5000, "z" * 3000, "日本語 テキスト　x", "a\x0b \x0cb\x1c c", "it's 12,345.67!? $$$ *** |", "É́ é"]


def expected(rows):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, start, ids))
        start += len(ids)
    return out


@pytest.mark.parametrize("segment", [1, 4 << 20])
def test_round_trip_equals_library(spark, tmp_path, monkeypatch, segment):
    monkeypatch.setattr(tf, "SEGMENT", segment)
    rows = [(i * 7 - 30, t) for i, t in enumerate(TEXTS)] + [(None, "nobody"), (5, "same"), (5, "same")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).selectExpr("*", "1 as start", "2 as ids")
    path = str(tmp_path / "tokens")
    tf.write_tokens(df, path, shards=4)
    want = expected(rows)
    got = sorted(((r.doc_id, r.start, list(r.ids)) for r in tf.read_tokens(spark, path).collect()), key=lambda r: r[1])
    assert got == want
    digest = sorted((tuple(r) for r in tf.read_digest(spark, path).collect()), key=lambda r: r[1])
    assert digest == [(i, s, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, s, x in want]


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = [(i, s, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
            for i, s, x in expected([(r.doc_id, r.text) for r in df.collect()])]
    assert sorted((tuple(r) for r in tf.token_digest(df).collect()), key=lambda r: r[1]) == want


def test_empty_table(spark):
    assert tf.token_digest(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("n", [1, 31, 32, 33, 65536, 65537, 300_000])
def test_coder_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 60_000) - 1
    s, f = rans.frequencies(ids)
    assert f.sum() == 1 << rans.BITS and f.min() >= 1
    blocks = rans.encode(ids, s, f)
    table = rans.unpack_table(rans.pack_table(s, f))
    assert (np.concatenate(rans.decode(blocks, *table)) == ids).all()
    if len(blocks) > 2:  # blocks stand alone
        one = rans.decode(blocks[1:2], *table)[0]
        assert (one == ids[65536:131072]).all()
    if n >= 65536:
        _, k = np.unique(ids, return_counts=True)
        assert sum(map(len, blocks)) * 8 / n < -(k / n * np.log2(k / n)).sum() * 1.02 + 0.3


def test_damage_is_found():
    ids = np.arange(1000) % 7
    s, f = rans.frequencies(ids)
    block = bytearray(rans.encode(ids, s, f)[0])
    block[-20] ^= 1
    with pytest.raises(ValueError):
        rans.decode([bytes(block)], s, f)
    table = bytearray(rans.pack_table(s, f))
    table[9] ^= 1
    with pytest.raises(ValueError):
        rans.unpack_table(bytes(table))
