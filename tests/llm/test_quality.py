import re
import zlib

import numpy as np

from trendspark.llm import quality as ql
from trendspark.llm.common import runs


def test_held_out_accuracy_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    extra = spark.createDataFrame([(None, "Some text."), (90001, None), (90002, ""), (90003, "  \n")], "doc_id long, text string")
    d = docs.select("doc_id", "text").union(extra).selectExpr("*", "1 as score", "0 as quality")
    out = {r.doc_id: r for r in ql.quality(d, labels).collect()}
    assert len(out) == docs.count() + 4
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out.values())
    assert out[90001].score == out[90002].score == out[90003].score
    assert all(r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2) for i, r in out.items())
    held = [(out[r.doc_id].predicted, r.quality) for r in labels.collect() if out[r.doc_id].held_out]
    assert len(held) > 60 and np.mean([p == q for p, q in held]) > 0.88


def test_context_table_by_definition(spark):
    texts = ["a b c a", "b!! a", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    want = np.zeros((ql.BUCKETS, ql.DIMS))
    for t in texts[:2]:
        b, s, _ = ql.tokens([t.encode()])
        e = ql._BY_BUCKET[b] + ql._BY_SHAPE[s]
        for i in range(len(b)):
            for j in range(max(0, i - ql.SIDE), min(len(b), i + ql.SIDE + 1)):
                if i != j:
                    want[b[i]] += e[j]
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-9)
    assert np.allclose(ql.context_table(df), want, atol=1e-6)


def test_runs_by_definition():
    text = "Hello WORLD!! x.\t$$$ 12ab é’s  A " + "y" * 41
    got_h, shape, offsets = runs([b"", text.encode(), b"Hello"])
    parts = [m[0] for m in re.finditer(rb"[A-Za-z\x80-\xff]+|[0-9]+|([!-~])\1*", text.encode())]
    assert list(offsets) == [0, 0, len(parts), len(parts) + 1]
    first = {p: h for p, h in zip(parts, got_h)}
    assert len(set(first.values())) == len(first) and all(first[p] == h for p, h in zip(parts, got_h))
    assert got_h[-1] == first[b"Hello"]
    want = {b"Hello": 1, b"WORLD": 2, b"!!": 6, b"x": 0, b".": 4, b"$$$": 6, b"12": 3, b"ab": 0, b"A": 1, b"y" * 41: 7}
    assert all(dict(zip(parts, shape))[k] == v for k, v in want.items())


def test_network_learns_and_is_calibrated():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 5))
    p = 1 / (1 + np.exp(-3 * x[:, 0] * x[:, 1]))
    y = (rng.random(4000) < p).astype(float)
    net = ql.train(x[:3000], y[:3000])
    s = net.score(x[3000:])
    assert np.mean((s > 0.5) == (p[3000:] > 0.5)) > 0.85
    for lo in (0.0, 0.3, 0.7):
        at = (s >= lo) & (s < lo + 0.3)
        assert abs(s[at].mean() - p[3000:][at].mean()) < 0.12


def test_one_class_no_labels_empty(spark):
    d = spark.createDataFrame([(i, f"word {i}") for i in range(20)], "doc_id long, text string")
    ones = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    assert {r.predicted for r in ql.quality(d, ones).collect()} == {1}
    assert {r.score for r in ql.quality(d, ones.limit(0)).collect()} == {0.5}
    assert ql.quality(d.limit(0), ones).collect() == []
