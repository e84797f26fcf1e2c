import math

import numpy as np
import pytest

from trendspark.llm import topk


def brute(rows, every, k):
    v = [(i, [math.floor(64 * x) for x in e]) for i, e in rows
         if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for q, a in v:
        if q % every == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in v if i != q)[:k]
            out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s)]
    return sorted(out)


@pytest.mark.parametrize("block", [64, 2048])
def test_equals_brute_force(spark, block):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 16))
    x = (centres[rng.integers(0, 8, 600)] + 0.3 * rng.normal(size=(600, 16))) / 5
    rows = [(i, [float(c) for c in e]) for i, e in enumerate(x)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)]  # one very common vector
    rows += [(2000, None), (2020, [1.0, None]), (2040, [float("nan")] * 16), (2060, [float("inf")] * 16), (None, rows[1][1]),
             (2080, []), (2100, [1e3] * 16), (2120, [0.0] * 16), (-20, [-0.001] * 20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as score", "2 as rank")
    got = sorted(tuple(r) for r in topk.top_k(df, every=20, k=20, block=block).collect())
    assert got == brute(rows, 20, 20)


def test_huge_values_few_rows_and_empty(spark):
    rows = [(20, [1e6, -3.0]), (21, [2e6, 1.0]), (40, [0.5, 0.25])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in topk.top_k(df).collect()) == brute(rows, 20, 20)
    assert topk.top_k(df.limit(0)).collect() == []


def test_reading_stops_on_proof(monkeypatch):
    """With clear winners, low-impact segments are not read, and the result is still exact."""
    rng = np.random.default_rng(1)
    x = rng.integers(-3, 4, (500, 32))
    x[:20, :4] = 60
    import pyarrow as pa
    t = topk._segments(pa.table({"vec_id": pa.array(range(500)), "v": pa.array(x.tolist()), "block": pa.array([0] * 500)}))
    b = t.to_pylist()[0]
    read = []
    real = np.frombuffer
    monkeypatch.setattr(topk.np, "partition", lambda a, n, axis, f=np.partition: (read.append(1), f(a, n, axis=axis))[1])
    q = np.zeros((1, 32), np.int64)
    q[0, :4] = 64
    rests = real(b["rests"], "<f8").reshape(len(b["places"]), 500)
    _, ids, score = topk.best(np.arange(500), 32, b["places"], b["values"], rests, np.array([999]), q, 10)
    want = sorted((-(x @ q[0])[i], i) for i in range(500))[:10]
    assert [(-s, i) for s, i in zip(score, ids)] == want
    assert len(read) == 1 < len(b["places"]) - 1
