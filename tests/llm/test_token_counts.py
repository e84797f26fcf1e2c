import public_tokenizers
import pytest
from tokenizers import Tokenizer

from trendspark.llm import token_counts as tc

TEXTS = [None, "", " ", "Hello, world's end.\n\nİstanbul ﬁne  x", "a<|endoftext|>b <|startoftext|> <|endoftext", "é é ́a ΣΑΣ ß",
         "word " * 3000, "x" * 5000, "it's 'sup 'S 12,345.67!?!", "\t\r\n\x0b\x0c tab", "日本語 テキスト", "Hello, world's end.\n\nİstanbul ﬁne  x"]


def test_equals_whole_text_encoding(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "a b", "y"), (0, None, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in tc.token_counts(df).collect()}
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    n = [len(tok.encode(t or "", add_special_tokens=False)) for _, t, _ in rows]
    assert got == {(i, len((t or "").encode()), k, k > 2048) for (i, t, _), k in zip(rows, n)}


def test_empty_table(spark):
    assert tc.token_counts(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_memo_bound(monkeypatch):
    monkeypatch.setattr(tc, "MEMO_WORDS", 3)
    c = tc.WordCounter(public_tokenizers.path("word_bpe_49k.json"))
    words = ["alpha", "beta", "gamma", "delta", "epsilon"]
    a, b = c.lengths(words), c.lengths(words[::-1])
    assert (a == b[::-1]).all() and len(c.memo) <= 3


def test_real_texts(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {r.doc_id: len(tok.encode(r.text or "", add_special_tokens=False)) for r in df.collect()}
    assert {r.doc_id: r.n_tokens for r in tc.token_counts(df).collect()} == want
