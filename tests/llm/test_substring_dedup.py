import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from trendspark.llm import substring_dedup as sd


def brute(rows, least):
    texts = [(i, (t or "").encode()) for i, t in rows]
    met = Counter(t[p:p + least] for _, t in texts for p in range(len(t) - least + 1))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - least + 1):
            if met[t[p:p + least]] > 1:
                gone[p:p + least] = True
        spans = int((np.diff(gone.astype(int)) == -1).sum())
        kept = bytes(np.frombuffer(t, np.uint8)[~gone[:-1]])
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def digest(spark, rows, extra=(), **kwargs):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *extra)
    return sorted((tuple(r) for r in sd.repeats_digest(df, **kwargs).collect()), key=str)


def corpus(rng, n=120):
    words = ["".join(rng.choice("abcdefgé ") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(90))
    docs = []
    for i in range(n):
        t = " ".join(rng.choice(words) for _ in range(rng.randrange(0, 250)))
        if i % 4 == 0:  # parts of one passage in many surroundings
            a, b = sorted(rng.sample(range(len(passage)), 2))
            cut = rng.randrange(len(t) + 1)
            t = t[:cut] + passage[a:b] + t[cut:]
        docs.append((i, t))
    docs += [(1000 + i, docs[3][1]) for i in range(5)]  # copies
    docs += [(1100 + i, docs[5][1][:150] + str(i) + docs[5][1][150:]) for i in range(6)]  # near copies
    return docs


@pytest.mark.parametrize("least, hot", [(200, 1 << 20), (60, 1 << 20), (60, 3000), (5, 2000)])
def test_equals_brute_force(spark, least, hot):
    docs = corpus(random.Random(least), 120 if least > 5 else 25)
    want = brute(docs, least)
    assert sum(r[2] for r in want) > 1000
    assert digest(spark, docs, least=least, hot=hot) == want


def test_odd_tables(spark):
    """Null ids and texts, repeated ids and rows, a repetitive and a very long text, clashing columns, an empty table."""
    rng = random.Random(9)
    long_ = "".join(rng.choice("abcdefghij\n") for _ in range(30_000))
    docs = [(None, None), (None, "x" * 500), (1, "x" * 100), (1, long_), (1, long_[:7000] + "!" + long_[7000:9000]), (2, ""), (None, "q" + long_[500:1100]),
            (3, "repeat me " * 30), (3, "repeat me " * 30), (4, "ab" * 4000), (5, "\x00" * 450), (6, long_[::-1])]
    want = brute(docs, 200)
    assert digest(spark, docs) == want
    assert digest(spark, docs, extra=["1 as h", "2 as gram", "3 as key", "4 as kept", "5 as n_bytes", "6 as start"]) == want
    assert digest(spark, []) == []


def test_pieces_of_a_long_text(spark, monkeypatch):
    """Cut into pieces, windows across the cuts are found all the same."""
    rng = random.Random(1)
    t = "".join(rng.choice("abcdefgh") for _ in range(5000))
    parts = [(0, t), (1, t[1500:1900])]
    monkeypatch.setattr(sd, "STEP", 512)
    data = [x.encode() for _, x in parts]
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([0, 1]), pa.array([7, 8]), pa.array([x for _, x in parts])], names=["doc_id", "h", "text"])
    found = [r for b in sd._occurrences(200, 64)([batch]) for r in b.to_pylist()]
    windows = Counter((r["doc_id"], p) for r in found for p in range(r["start"], r["start"] + r["size"]))
    assert windows == Counter((i, p) for i, x in enumerate(data) for p in range(len(x) - 199))
    gram = {(r["doc_id"], p): r["gram"] for r in found for p in range(r["start"], r["start"] + r["size"])}
    assert all(gram[0, 1500 + p] == gram[1, p] for p in range(201))


def test_common_prefixes_by_definition():
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"ab\xff") for _ in range(rng.randrange(0, 120))) for _ in range(40)]
    texts += [texts[0] + b"a" * 60, texts[0][10:] + b"b" * 50, b"a" * 150, b"ab" * 70]
    for least in (3, 7, 8, 40):
        codes = np.array([c for t in texts for c in (*(b + 1 for b in t), 0)], np.int16)
        order, common = sd.common_prefixes(codes, least)
        assert sorted(order) == list(range(len(codes)))
        row = codes.tolist()
        for i in range(1, len(codes)):
            a, b = order[i - 1], order[i]
            n = 0
            while max(a, b) + n < len(row) and row[a + n] == row[b + n] != 0 and n < least:
                n += 1
            if n == least:
                assert common[i] == -1
            elif not (max(a, b) + n < len(row) and row[a + n] == row[b + n] == 0):
                assert common[i] == n
        met = Counter(t[p:p + least] for t in texts for p in range(len(t) - least + 1))
        want = [[met[t[p:p + least]] > 1 for p in range(len(t) - least + 1)] for t in texts]
        assert [x.tolist() for x in sd.repeated_windows(texts, least)] == want
