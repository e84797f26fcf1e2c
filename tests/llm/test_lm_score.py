import math
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from trendspark.llm import lm_score as lm
from trendspark.session import checkpoint_root


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


class Brute:
    """The same tree from plain dictionaries over word tuples; START is 0, the end None."""

    def __init__(self, texts, depth):
        self.c = Counter(w for t in texts for w in words(t))
        self.n, self.v = sum(self.c.values()), len(self.c)
        enough, some = (max(2, math.ceil(e * self.n)) for e in (lm.EPS, lm.DELTA))
        self.tree = {}
        for length in range(1, depth + 1):
            follow, count = {}, Counter()
            for t in texts:
                w = [0] + words(t)
                for i in range(1, len(w)):
                    if i - length >= 0:
                        g = tuple(w[i - length:i])
                        count[g] += 1
                        follow.setdefault(g, Counter())[w[i]] += 1
            level = {}
            for g, f in follow.items():
                if not (count[g] if length > 1 else (self.c[g[0]] if g[0] else len(texts))) >= enough and g != (0,):
                    continue
                if length > 1 and any(self.c[x] < some for x in g[1:]):
                    continue
                f = {w: k for w, k in f.items() if k >= some and self.c[w] >= some}
                if not f:
                    continue
                q = {w: 10 ** self.logp(g[1:], w) for w in f}
                p = {w: (k - lm.DISCOUNT) / count[g] for w, k in f.items()}
                left, rest = max(1 - sum(p.values()), 1e-9), max(1 - sum(q.values()), 1e-9)
                gain = sum(k * math.log(p[w] / q[w]) for w, k in f.items()) + (count[g] - sum(f.values())) * math.log(left / rest)
                if gain > 0.5 * (len(f) + 1) * math.log(count[g] + 1):
                    level[g] = ({w: math.log10(x) for w, x in p.items()}, math.log10(left / rest))
            self.tree |= level

    def logp(self, context, w):
        for k in range(len(context), 0, -1):
            if (g := tuple(context[len(context) - k:])) in self.tree:
                p, backoff = self.tree[g]
                return p[w] if w in p else backoff + self.logp(g[1:], w)
        return math.log10((self.c[w] + 1) / (self.n + self.v + 1))

    def score(self, t, depth):
        w = [0] + words(t)
        return sum(self.logp(tuple(w[max(0, i - depth):i]), w[i]) for i in range(1, len(w)))


def check(spark, rows, depth=3):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as score", "2 as n")
    got = {r.doc_id: r for r in lm.lm_scores(df, depth=depth).collect()}
    b = Brute([t for i, t in rows if not is_held(i)], depth)
    assert len(got) == len(rows)
    for i, t in rows:
        r, w = got[i], words(t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (is_held(i), len(w), sum(b.c[x] > 0 for x in w), b.n)
        assert r.base_score == pytest.approx(sum(math.log10((b.c[x] + 1) / (b.n + b.v + 1)) for x in w), abs=1e-6)
        assert r.score == pytest.approx(b.score(t, depth), abs=1e-6)
    return got, b


def sample(n=250):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(n):
        own = [f"{'xyz'[i % 3]}{k}" for k in range(30)]
        t = " ".join(rng.choice(own, 40, p=np.arange(30, 0, -1) / 465)) + " The  common passage of\tall texts. "
        rows.append((i, t))
    return rows + [(1000, None), (1001, ""), (1002, " \n"), (1003, "unseen ÄÖ " * 50), (None, "the common passage")]


def test_equals_brute_force(spark):
    got, b = check(spark, sample())
    assert any(len(g) > 1 for g in b.tree) and any(len(g) > 2 for g in b.tree)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_uncommon_symbols_are_joined(spark, monkeypatch):
    monkeypatch.setattr(lm, "COMMON", 0.01)
    monkeypatch.setattr(lm, "DELTA", 0.02)
    monkeypatch.setattr(lm, "EPS", 0.02)
    check(spark, sample(), depth=2)


def test_distributions_sum_to_one():
    b = Brute([t for _, t in sample(120)], 3)
    for g in list(b.tree)[:40] + [()]:
        total = sum(10 ** b.logp(g, w) for w in b.c) + 10 ** b.logp(g, "never seen")
        assert total == pytest.approx(1, abs=1e-6)


def test_nothing_to_learn_from_and_empty(spark):
    rows = [(i, "a b a b") for i in range(200) if is_held(i)][:5]
    check(spark, rows)
    assert lm.lm_scores(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_rare_contexts_stay_in_a_large_corpus(spark):
    """A phrase seen twice among some 250,000 other words (1e-5 of them would be more) scores better than the root."""
    phrase = " ".join(f"p{k}" for k in range(8))
    filler = [(i, " ".join(f"f{(i * 7919 + k * 104729) % 50021}" for k in range(1000))) for i in range(300)]
    train, held = ([i for i in range(10000, 10100) if is_held(i) == h] for h in (False, True))
    held = held[0]
    rows = filler + [(train[0], phrase), (train[1], phrase), (held, phrase)]
    got = {r.doc_id: r for r in lm.lm_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[held].held_out and got[held].n_known == 9
    assert got[held].score > got[held].base_score + 20  # the start mark alone gives about 3


def test_many_chunks_and_parts_equal_brute_force(spark, monkeypatch):
    """Passages that stand in several chunks, as a whole, in part and in held-out texts only, each key in one of many parts."""
    monkeypatch.setattr(lm, "PART_KEYS", 400)
    rng = np.random.default_rng(5)
    passages = [" ".join(rng.choice([f"q{k}" for k in range(60)], 12)) for _ in range(12)]
    rows = [(i, t) for i, t in sample(60)]
    for i in range(2000, 2120):
        p = passages[i % 12].split()
        rows.append((i, " ".join(p[i % 3:len(p) - i % 4]) + f" own{i} " + passages[(i * 7) % 12]))
    rows += rows[:20]
    b = Brute([t for i, t in rows if not is_held(i)], 3)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    got = lm.lm_scores(df).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(([r.doc_id, r.n_tokens] for r in got), key=key) == sorted(([i, len(words(t))] for i, t in rows), key=key)
    text = {i: t for i, t in rows}
    for r in got:
        assert (r.held_out, r.n_known) == (is_held(r.doc_id), sum(b.c[x] > 0 for x in words(text[r.doc_id])))
        assert r.train_tokens == b.n and r.score == pytest.approx(b.score(text[r.doc_id], 3), abs=1e-6)


def test_tables_left_are_a_few_bytes_a_symbol(spark):
    """A symbol takes its number and what is told of its grams; tables of all distinct grams with their keys took 95 bytes."""
    root = checkpoint_root(spark).removeprefix("file://")
    size = lambda: sum(p.stat().st_size for p in Path(root).rglob("*") if p.is_file())
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{k}" for k in rng.zipf(1.3, 500) % 20000)) for i in range(160)]
    before, kept = size(), lm.lm_scores(spark.createDataFrame(rows, "doc_id long, text string"))
    assert size() - before < 16 * sum(len(words(t)) for _, t in rows)
    assert kept.count() == len(rows)
