import math

import numpy as np
import pytest

from trendspark.llm import hard_negatives as hn


def brute(rows, every=50, scale=256):
    kept = {}
    for i, e, label in rows:
        if i is not None and e is not None and label is not None and all(x is not None and math.isfinite(x) for x in e):
            r = (label, [math.floor(scale * x) for x in e])
            kept[i] = min(kept.get(i, r), r)
    out = []
    for a, (label, v) in kept.items():
        if a % every:
            continue
        s = sorted((-sum(x * y for x, y in zip(v, w)), i, own) for i, (own, w) in kept.items() if i != a)
        for p, pid, _ in [x for x in s if x[2] == label][:5]:
            found = [x for x in s if x[2] != label and -50 * p <= -100 * x[0] <= -95 * p][:3]
            out += [(a, pid, r + 1, n, -p, -score) for r, (score, n, _) in enumerate(found)]
    return sorted(out)


SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("group", [200, 16_384])
def test_equals_brute_force(spark, group):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(4, 12))
    label = rng.integers(0, 4, 900)
    x = (centres[rng.integers(0, 4, 900)] + 0.6 * rng.normal(size=(900, 12))) * rng.uniform(0.1, 2, (900, 1)) / 4
    rows = [(i, [float(c) for c in e], int(k)) for i, e, k in zip(range(900), x, label)]
    rows += [(1000 + i, rows[0][1], i % 2) for i in range(400)]  # one very common vector
    rows += [(2000, None, 1), (2050, [1.0, None], 1), (2100, [float("nan")] * 12, 2), (2150, [float("inf")] * 12, 0), (None, rows[1][1], 0),
             (2200, rows[1][1], None), (2250, [], 3), (2300, [1e3] * 12, 1), (2350, [0.0] * 12, 1), (-50, [-0.001] * 14, 2),
             (2400, [0.5] * 5, 0), rows[50], (50, [0.1] * 12, rows[50][2])]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as grp", "2 as rank", "3 as v", "4 as part")
    got = sorted(tuple(r) for r in hn.hard_negatives(df, group=group).collect())
    want = brute(rows)
    assert len(want) > 300 and got == want


def test_huge_values_few_rows_and_empty(spark):
    rows = [(50, [1e6, -3.0], 0), (51, [2e6, 1.0], 0), (52, [1.5e6, 8.0], 1), (53, [1.8e6, 0.0], 1), (100, [0.5, 0.25], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(tuple(r) for r in hn.hard_negatives(df).collect()) == brute(rows)
    assert hn.hard_negatives(df.limit(0)).collect() == []
    assert hn.hard_negatives(df.where("vec_id = 50")).collect() == []


def test_shifted_label(spark):
    df = spark.createDataFrame([(7, 9), (14, None), (8, 9), (None, 3)], "vec_id long, label int")
    assert [r[0] for r in df.select(hn.shifted_label()).collect()] == [0, None, 9, 3]


def test_candidates_hold_every_row_and_leave_most_out():
    rng = np.random.default_rng(2)
    x = rng.integers(-40, 40, (1000, 16))
    x[:, :2] *= 8
    order = np.argsort(x, axis=0, kind="stable").T
    row = {"ids": np.arange(1000, dtype="<i8").tobytes(), "labels": np.zeros(1000, "<i8").tobytes(), "dims": 16,
           "x": x.astype("<i8").tobytes(), "orders": order.astype("<u4").tobytes()}
    b = hn.Bucket(row, 16)
    q = hn.Anchors(np.arange(50), np.zeros(50, np.int64), x[:50])
    exact = q.x @ b.x.T
    for share in (0.0, 0.5, 0.8):
        least = share * q.length * b.top
        who, place = hn.candidates(q, b, least)
        got = set(zip(who.tolist(), place.tolist()))
        assert got >= set(zip(*(c.tolist() for c in np.nonzero(exact >= least[:, None]))))
    assert len(got) < 0.2 * 50 * 1000
    who, place = hn.candidates(q, b, np.full(50, -np.inf))
    assert len(who) == 50_000
    who, place = hn.candidates(q, b, q.length * b.top * 1.1)
    assert not len(who)
