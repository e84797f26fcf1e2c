import re

import numpy as np
import pytest

from trendspark.llm import near_dedup as nd
from trendspark.llm.common import U64
from trendspark.llm.components import components
from trendspark.llm.superminhash import EMPTY, mix64, signatures


def brute(rows, num=85, den=100):
    """{row: (n, component)} by all pairs of full sets."""
    def words(t):
        return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    comp = {i: i for i, _ in rows}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for i, (a, _) in enumerate(rows):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * len(sets[i] | sets[j]):
                x, y = root(a), root(rows[j][0])
                comp[max(x, y)] = min(x, y)
    return {a: (len(s), root(a)) for (a, _), s in zip(rows, sets)}


def check(spark, rows):
    got = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_equals_brute_force_on_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows)


def test_family_without_its_original(spark):
    """Members linked only through others, members that reach nobody, edge texts."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for k in range(60):
        w = list(base)
        for at in rng.choice(60, size=k % 5, replace=False):
            w[at] = f"x{rng.integers(6)}"
        rows.append((1000 - k, " ".join(w)))
    rows += [(1, None), (2, ""), (3, " \t"), (4, "one two"), (5, "ONE  two"), (6, "one two three"), (7, "É é"), (8, "é é"),
             (9, " ".join(base) * 300), (10, " ".join(base).upper() * 300)]
    check(spark, rows)


def test_null_ids_repeats_empty_and_extra_columns(spark):
    df = spark.createDataFrame([(None, "a b c d e f", 1), (3, "a b c d e f", 2), (3, "a b c d e f", 2), (2, "A b c d e f", 3)],
                               "doc_id long, text string, n long")
    got = sorted((tuple(r) for r in nd.near_duplicates(df).collect()), key=str)
    assert got == sorted([(2, 2, 2, True), (3, 2, 2, False), (3, 2, 2, False), (None, 2, None, True)], key=str)
    assert nd.near_duplicates(df.limit(0)).collect() == []


def test_signature_by_definition():
    def by_element(elements, m):
        h = [int(EMPTY)] * m
        for d in elements:
            p = list(range(m))
            for j in range(m):
                step = U64(0xA0761D6478BD642F * (j + 1) & 0xFFFFFFFFFFFFFFFF)
                x = int(mix64(np.array([d], U64) + step)[0])
                k = j + (((x & 0xFFFFFFFF) * (m - j)) >> 32)
                p[j], p[k] = p[k], p[j]
                h[p[j]] = min(h[p[j]], (j << 32) | (x >> 32))
        return h
    rng = np.random.default_rng(1)
    e = rng.integers(0, 2**63, 300, dtype=U64)
    offsets = np.array([0, 0, 1, 5, 40, 300])
    sig = signatures(e, offsets, 32)
    for i in range(5):
        assert [int(x) for x in sig[i]] == by_element(e[offsets[i]:offsets[i + 1]], 32)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(2)
    err = []
    for _ in range(200):
        e = rng.integers(0, 2**63, 130, dtype=U64)
        s = signatures(np.concatenate([e[:100], e[30:]]), np.array([0, 100, 200]), 125)
        err.append((s[0] == s[1]).mean() - 70 / 130)
    assert abs(np.mean(err)) < 0.01 and np.std(err) < (70 / 130 * 60 / 130 / 125) ** 0.5 * 1.05


@pytest.mark.parametrize("n", [1, 2, 7, 40])
def test_components_of_chains_and_stars(spark, n):
    links = [(i, i + 1) for i in range(n)] + [(500, 500 + i) for i in range(1, n + 1)] + [(None, 3), (4, 4)] + [(1000, 1001)] * 3
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(n + 1)} | {500 + i: 500 for i in range(n + 1)} | {1000: 1000, 1001: 1000}
    assert got == want


def test_components_empty(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
