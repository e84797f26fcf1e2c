import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from trendspark.llm import toxicity as tx

INSULTS = ["blorgan", "krazzit", "munfolip"]


def corpus(n=900):
    rng = np.random.default_rng(3)
    parts = ["ta", "ne", "ri", "so", "lu", "ke", "ma", "do"]
    words = ["".join(rng.choice(parts, 3)) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        w = list(rng.choice(words, 40))
        bad = i % 5 == 0
        if bad:
            w[7], w[23] = rng.choice(INSULTS), rng.choice(INSULTS) + str(rng.choice(parts))
        docs.append((i, " ".join(w[:20]) + ". " + " ".join(w[20:])))
        labels.append((i, int(bad)))
    return docs, labels


def phi(unit):
    """Weights of a unit's subsequences by definition, with and without word starts."""
    chars = re.findall(r"\^?.", unit)
    out, total = Counter(), 0
    for told in (True, False):
        u = chars if told else [c[-1] for c in chars]
        for a, b, c in itertools.combinations(range(len(u)), 3):
            if c - a < tx.SPAN:
                v = tx.DECAY ** (c - a + 1)
                out[told, u[a], u[b], u[c]] += v
                total += v * v
    if not any("^" in c for c in chars):  # both readings are the same subsequences
        out = Counter({(True, *k[1:]): v * 2 for k, v in out.items() if k[0]})
    else:
        merged = Counter()
        for (told, *k), v in out.items():
            merged[tuple(k)] += v
        out = Counter({(True, *k): v for k, v in merged.items()})
    return out, max(total, 1e-24) ** 0.5


def test_kernel_by_definition():
    words = ["^idiot", "^id^iot", "^banana", "^xyz", "aaaaaaa", "^idxiot", "^i^diot"]
    want = np.array([[sum(v * phi(b)[0].get(g, 0) for g, v in phi(a)[0].items()) / phi(a)[1] / phi(b)[1] for b in words]
                     for a in words])
    assert np.allclose(tx.kernel(words, words), want, atol=1e-5)


def plain_units(text):
    """Units of a text, one character at a time."""
    out = []
    for sentence in re.split(r"[.!?](?=\s|$)|\n", text.lower()):
        words = ["".join(filter(str.isalnum, w)) for w in sentence.split()]
        words, run = [w for w in words if w], []
        joined = []
        for w in [*words, "??"]:
            if len(w) == 1:
                run.append(w)
                continue
            joined += ["".join(run)] if len(run) > 2 else run
            run = []
            joined.append(w)
        pieces = []
        for w in joined[:-1]:
            n = tx.LONGEST // 2
            pieces += ["^" + w] if len(w) <= tx.LONGEST else [("^" if i == 0 else "") + w[i:i + n] for i in range(0, len(w), n)]
        own = []
        for i in range(len(pieces)):
            for m in range(1, tx.RUN + 1):
                u = "".join(pieces[i:i + m])
                if i + m <= len(pieces) and len(u.replace("^", "")) <= tx.LONGEST:
                    own.append(u)
        out.append(own)
    return out


def test_units_and_scores_equal_a_plain_version(spark):
    """A fitted model's scores, from the subsequences of every unit one by one."""
    docs, labels = corpus(200)
    texts = [t for _, t in docs] + ["", "!?", "b.l.o.r g a n! Next 3.14 ok", "x " * 9, "a b c d e. f g h", "word" * 20 + " end", "É ß İ ﬁ naïve_x"]
    codes, offsets = tx.characters(texts)
    start, ends = tx.units(codes)
    got = [[] for _ in texts]
    for k, p in enumerate(start.tolist()):
        d = int(np.searchsorted(offsets, p, "right") - 1)
        got[d] += [tx.written_unit(codes[p:e]) for e in ends[:, k].tolist() if e >= 0]
    assert got == [[u for s in plain_units(t) for u in s] for t in texts]
    model = tx.fit(spark.createDataFrame([(t, y) for (_, t), (_, y) in zip(docs, labels)], "text string, label int"))
    table = {}

    def margin(unit):
        if unit not in table:
            who, slot, weight = tx.subsequences([unit])
            table[unit] = sum(w * model.values[s] for s, w in zip(slot.tolist(), weight.tolist())) + model.bias
        return table[unit]

    want = []
    for t in texts:
        best = [max(map(margin, s)) for s in plain_units(t) if s]
        x = [max([*best, model.bias - 1]), math.log1p(sum(b > 1e-4 for b in best))]
        x = [min(max(v, -3), 3) for v in x]
        want.append(1 / (1 + math.exp(-(x[0] * model.doc[0] + x[1] * model.doc[1] + model.doc[2]))))
    assert np.allclose(model.score(texts), want, atol=2e-3)


def probe(spark, change):
    """Share of held-out rows judged right after ``change(i, text, toxic)``."""
    rng = np.random.default_rng(8)
    docs, labels = corpus(900)
    plain = [(i, " ".join(w for w in t.split(" ") if not any(x in w for x in INSULTS))) for i, t in docs]
    docs = [(i, change(rng, i, t, y)) for (i, t), (_, y) in zip(plain, labels)]
    out = {r.doc_id: r for r in tx.toxicity(spark.createDataFrame(docs, "doc_id long, text string"),
                                            spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 3 == 1 and y]
    assert len({round(r.score, 6) for r in out.values()}) > 1
    return np.mean([out[i].predicted == 1 for i, _ in held])


def test_insults_in_some_clean_documents_too(spark):
    assert probe(spark, lambda rng, i, t, y: t + " " + str(rng.choice(INSULTS)) if y or rng.random() < 0.05 else t) > 0.9


def test_a_phrase_of_ordinary_words(spark):
    words = sorted({w for _, t in corpus(900)[0] for w in t.replace(".", "").split()})[:3]
    assert probe(spark, lambda rng, i, t, y: t.replace(". ", " " + " ".join(words) + ". ") if y else t) > 0.9


def test_repeated_rows_and_clashing_columns(spark):
    docs, labels = corpus(120)
    d = spark.createDataFrame(docs + docs[:3] + [(docs[0][0], docs[1][1])], "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    out = tx.toxicity(d, lab).collect()
    assert len(out) == 124 and len({r.score for r in out if r.doc_id == docs[2][0]}) == 1
    extra = d.withColumn("score", F.lit("own"))
    kept = tx.toxicity_scores(extra, lab, keep=("text", "score"), out_col="p")
    assert kept.columns == ["doc_id", "text", "score", "p"] and {r.score for r in kept.collect()} == {"own"}


def test_held_out_accuracy_gaps_and_inserted_letters(spark):
    docs, labels = corpus()
    base = docs[1][1]
    extra = [(5000, base.replace(". ", " b.l.o.r.g.a.n. ")), (5001, base + " krazzzit"), (5002, base + " m u n f o l i p"),
             (5003, base + " munxfolip"), (5004, None), (5005, ""), (5006, " \n.. "), (5007, base * 200), (None, base)]
    d = spark.createDataFrame(docs + extra, "doc_id long, text string").selectExpr("*", "1 as score", "0 as toxic")
    out = {r.doc_id: r for r in tx.toxicity(d, spark.createDataFrame(labels + [(3, None), (None, 1)], "doc_id long, toxic int")).collect()}
    assert len(out) == len(docs + extra)
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(out[i].held_out for i, _ in held) and not out[None].held_out
    assert np.mean([out[i].predicted == y for i, y in held]) > 0.98
    assert [out[i].predicted for i in (5000, 5001, 5002, 5003)] == [1, 1, 1, 1]
    assert [out[i].predicted for i in (5004, 5005, 5006, 5007, None)] == [0] * 5
    assert all(0 <= r.score <= 1 for r in out.values())


def test_one_class_no_labels_and_empty(spark):
    docs, labels = corpus(50)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    assert {r.predicted for r in tx.toxicity(d, lab.where("toxic = 0")).collect()} == {0}
    assert {r.predicted for r in tx.toxicity(d, lab.limit(0)).collect()} == {0}
    assert tx.toxicity(d.limit(0), lab).collect() == []


def test_units_are_mapped_without_their_whole_kernel():
    import tracemalloc
    rng = np.random.default_rng(5)
    words = ["^" + "".join(rng.choice(list("abcdefghij"), 6)) for _ in range(20000)]
    marks = sorted(set(words))[:320]
    root = rng.normal(size=(len(marks), 2)).astype(np.float32)
    tracemalloc.start()
    got = tx.mapped(words, marks, root)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    whole = tx.kernel(words, marks)
    assert np.allclose(got, whole @ root, atol=1e-5)
    assert peak < whole.nbytes
