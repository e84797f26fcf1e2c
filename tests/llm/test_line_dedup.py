import os

import numpy as np

from trendspark.llm import buckets
from trendspark.llm import line_dedup as ld


def brute(rows, chars=ld.CHARS):
    """{row number: (removed, text)} by all pairs of lines."""
    def parts(c):
        return {c[i:i + chars] for i in range(max(1, len(c) - chars + 1))}
    lines = sorted({(i is not None, i or 0, k, ld.canonical(x)) for i, t in rows for k, x in enumerate((t or "").split("\n"))
                    if ld.canonical(x)})
    first = {}
    for a, i, k, c in lines:
        first.setdefault(c, (a, i, k))
    keys = list(first)
    root = {c: c for c in keys}

    def up(c):
        while root[c] != c:
            c = root[c]
        return c
    sets = {c: parts(c) for c in keys}
    for n, x in enumerate(keys):
        for y in keys[:n]:
            both = len(sets[x] & sets[y])
            if 5 * both >= 4 * len(sets[x] | sets[y]):
                a, b = sorted((up(x), up(y)), key=first.get)
                root[b] = a
    out = []
    for i, t in rows:
        kept, seen, gone = [], set(), 0
        for k, x in enumerate((t or "").split("\n")):
            c = ld.canonical(x)
            if c:
                if c in seen or first[up(c)] != (i is not None, i or 0, k):
                    gone += 1
                    continue
                seen.add(c)
            kept.append(x)
        out.append((i, gone, None if t is None else "\n".join(kept)))
    return out


def key(r):
    return tuple((x is not None, x if x is not None else 0) for x in r)


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "7 as node", "text", "1 as lines_removed")
    out = ld.line_dedup(df)
    assert out.columns == ["doc_id", "node", "text", "lines_removed"]
    got = sorted(((r.doc_id, r.lines_removed, r.text) for r in out.collect()), key=lambda r: (key(r[:2]), r[2] or ""))
    assert got == sorted(brute(rows), key=lambda r: (key(r[:2]), r[2] or ""))


def test_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(400)]
    base = [" ".join(rng.choice(words, 12)) for _ in range(25)]
    rows = []
    for i in range(120):
        ls = []
        for _ in range(rng.integers(0, 6)):
            w = str(rng.choice(base)).split()
            for _ in range(rng.integers(0, 3)):
                w[rng.integers(12)] = str(rng.choice(words))
            ls.append(str(rng.choice([" ".join(w), "  " + " ".join(w).upper(), str(rng.choice(words)), "", "x"])))
        rows.append((i * 3 - 20, "\n".join(ls)))
    rows += [(900, None), (901, ""), (902, "\n\n"), (903, base[0] + "\n" + base[0]), (904, " ".join(base) * 50), (905, " ".join(base) * 50 + " x"),
             (None, base[1] + "\nonly here"), (910, "Only  here\nß é\n日本")]
    check(spark, rows)


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows)


def test_repeated_ids_and_empty(spark):
    df = spark.createDataFrame([(1, "a line of text\nb"), (1, "a line of text\nb"), (2, "A line of  text")], "doc_id long, text string")
    assert sorted((r.doc_id, r.lines_removed, r.text) for r in ld.line_dedup(df).collect()) == [
        (1, 0, "a line of text\nb"), (1, 0, "a line of text\nb"), (2, 1, "")]
    assert ld.line_dedup(df.limit(0)).collect() == []


def test_pairs_at_the_threshold_share_a_band():
    """Sets with 80 of 100 elements in common; 16 bands missed 3 of these 4,000 pairs."""
    rng = np.random.default_rng(7)
    missed = 0
    for _ in range(8):
        e = rng.integers(0, 2**63, (500, 100)).astype(np.uint64)
        sets = np.stack([e[:, :90], e[:, 10:]], axis=1)
        b = ld.bands(ld.signatures(sets.ravel(), np.arange(0, 90001, 90), ld.BANDS * ld.ROWS), ld.BANDS, ld.ROWS)
        b = b.reshape(500, 2, ld.BANDS)
        missed += int((~(b[:, 0] == b[:, 1]).any(axis=1)).sum())
    assert missed == 0


def test_marks_never_part_similar_sets():
    """Bits in which two marks differ are at most the elements in one of the sets only."""
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    sets = [np.unique(rng.choice(pool, n)) for n in (0, 1, 5, 80, 400, 400, 2500)] + [pool[:100], pool[:90], pool[5:100]]
    m = buckets.marks(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])]))
    assert m.shape == (len(sets), buckets.MARK)
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            bits = sum(int(v).bit_count() for v in (m[i] ^ m[j]).view(np.uint64))
            apart = len(np.setxor1d(x, y))
            assert bits <= apart and (apart > 100 or bits >= 0.8 * apart)


def test_family_of_variants_forms_few_pairs(spark, monkeypatch):
    """Variants of one line, about 0.7 similar to it and to each other: the pairs
    to confirm grew with the square of their number (7,000 for these)."""
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(300)]
    line = list(rng.choice(words, 60))
    rows = []
    for i in range(160):
        w = list(line)
        for k in rng.choice(60, rng.integers(4, 8), replace=False):
            w[k] = str(rng.choice(words))
        rows.append((i, " ".join(w)))
    held = {}

    def noted(df, name):
        held[name] = out = written(df, name)
        return out
    written = buckets.written
    monkeypatch.setattr(buckets, "written", noted)
    check(spark, rows)
    assert held["left"].select("node").distinct().count() > 50
    assert held["rest"].count() <= 2 * len(rows)


def test_shuffles_of_a_stage_do_not_stay(spark):
    """Only a round of bands is on disk at a time: written() leaves no shuffle files behind."""
    def files():
        root = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {root.apply(i).getPath() for i in range(root.size()) if root.apply(i).getName().startswith("shuffle_")}
    before = files()
    nodes = spark.range(2000).selectExpr("id as node", "array(id % 7, 100 + id, 300 + id % 900, 5000 + id) as buckets")
    got = {(r.node, r.bucket, r.met) for r in buckets.crowded(nodes, 4, rounds=3).collect()}
    by = {}
    for n in range(2000):
        for b in (n % 7, 100 + n, 300 + n % 900, 5000 + n):
            by.setdefault(b, []).append(n)
    # a bucket is of one band: those above that two bands name are counted band by band
    assert {x for x in got if x[1] < 7} == {(n, b, len(by[b])) for b in range(7) for n in by[b]}
    assert not any(b >= 5000 for _, b, _ in got)
    # one-row shuffles of counts are all that may wait for the heap's collection
    assert sum(os.path.getsize(f) for f in files() - before if f.endswith(".data") and os.path.exists(f)) < 2000


def test_packed_bands_give_the_sets_of_nodes_that_share_a_hash(spark):
    """Six bytes a hash; nodes of far apart bases, hashes that differ in one half only."""
    rng = np.random.default_rng(4)
    nodes = np.concatenate([np.arange(300), (3 << 33) + np.arange(65400, 65800)])
    bands = rng.integers(-2**63, 2**63, (len(nodes), 3))
    bands[5:9, 0] = bands[5, 0]
    bands[5:9, 2] = 17
    bands[290:310, 1] = -1
    bands[400, 0], bands[401, 0], bands[401, 1] = 5 << 32, (5 << 32) + 1, 6 << 32
    bands[[2, 500], [0, 1]] = 99
    rows = list(buckets.packed(nodes, bands, 7))
    assert sum(len(r["places"]) + len(r["hashes"]) for b in rows for r in b.to_pylist()) == 6 * bands.size
    by = {}
    for n, row in zip(nodes.tolist(), bands.tolist()):
        for h in row:
            by.setdefault(h, set()).add(n)
    want = {frozenset(v) for v in by.values() if len(v) > 1}
    df = spark.createDataFrame([(n, r) for n, r in zip(nodes.tolist(), bands.tolist())], "node long, hashes array<long>")

    def banded(deals):
        def run(batches):
            for batch in batches:
                yield from buckets.packed(batch.column(0).to_numpy(), batch.column(1).values.to_numpy().reshape(-1, 3), deals)
        return run
    got = {}
    for r in buckets.crowded_packed(df.coalesce(3), banded).collect():
        assert r.node not in got.setdefault((r.bucket, r.met), set())
        got[r.bucket, r.met].add(r.node)
    assert len(got) == len(want) == 3 and {frozenset(v) for v in got.values()} == want
    assert all(met == len(v) for (_, met), v in got.items())
    assert buckets.crowded_packed(df.limit(0), banded).collect() == []


def test_classes_hold_a_line_and_no_bands(spark, monkeypatch):
    """28 longs a class took 234 bytes a line of 60 characters; copies of a line in a batch are one row."""
    rng = np.random.default_rng(9)
    common = "a line that all of the documents have"
    rows = [(i, "\n".join([common, *("".join(rng.choice(list("abcdefgh "), 60)) for _ in range(5))])) for i in range(600)]
    held = {}

    def noted(df, name, **options):
        held[name] = out = written(df, name, **options)
        return out
    written = ld.written
    monkeypatch.setattr(ld, "written", noted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {r.doc_id: r.lines_removed for r in ld.line_dedup(df).collect()}
    assert got == {i: int(i > 0) for i in range(600)}
    classes = held["line-classes"]
    assert {r.docs for r in classes.where(classes.line == common).collect()} == {600}
    size = sum(os.path.getsize(f.removeprefix("file:").replace("///", "/")) for f in classes.inputFiles())
    assert size < 140 * classes.count()
    batches = df.selectExpr("doc_id", "text", "1L as h").mapInArrow(ld._lines, "k1 long, k2 long, doc_id long, place long, h long, docs long, line string")
    assert batches.where(batches.line == common).count() == 2


def test_canonical_lines():
    for line in ("", " ", "a", "A b", " a", "a ", "a  b", "a\tb", "a\u00a0b", "a\u2028b", "\u3000", "\x1fa", "İ ß Σ", "a\u200bb", "日本 語", "a\u1680b\x85"):
        assert ld.canonical(line) == " ".join(line.lower().split())


def test_shingles_by_definition():
    lines = ["", "abc", "abcdefg", "日本 語", "x" * 60000, "", "abcdefgh", "é" * 6, "a"]
    h, offsets = ld.shingles(lines)
    seen = {}
    for i, line in enumerate(lines):
        parts = [line[k:k + ld.CHARS] for k in range(max(1, len(line) - ld.CHARS + 1))] if line else []
        assert offsets[i + 1] - offsets[i] == len(parts)
        for x, part in zip(h[offsets[i]:offsets[i + 1]].tolist(), parts):
            assert seen.setdefault(part, x) == x
    assert len(set(seen.values())) == len(seen)


def test_sketch_by_definition(monkeypatch):
    """Slots of the sketch equal those of a loop over rounds and elements."""
    from trendspark.llm import similarity_sketch as sk

    def plain(e, slots):
        mix = lambda x, seed: int(sk._mixed(np.array([x], np.uint32), seed)[0])
        out = [None] * slots
        for r in range(sk.ROUNDS):
            drawn = {}
            for x in e.tolist():
                s = (mix(x & 0xFFFFFFFF, sk._SLOT * (r + 1)) >> 16) * slots >> 16
                drawn.setdefault(s, []).append(mix(x >> 32, sk._VALUE * (r + 1)))
            for s, v in drawn.items():
                out[s] = r << 32 | min(v) if out[s] is None else out[s]
        for s in range(slots):
            if out[s] is None:
                out[s] = (sk.ROUNDS + s) << 32 | min(mix(x >> 32, sk._VALUE * (sk.ROUNDS + 1 + s)) for x in e.tolist())
        return out

    rng = np.random.default_rng(3)
    e = rng.integers(0, 2**64, 400, dtype=np.uint64)
    offsets = np.array([0, 0, 1, 3, 30, 400])
    for together in (32000, 20):
        monkeypatch.setattr(sk, "TOGETHER", together)
        sig = sk.signatures(e, offsets, 32)
        assert (sig[0] == sk.EMPTY).all()
        for i in range(1, 5):
            assert [int(x) for x in sig[i]] == plain(e[offsets[i]:offsets[i + 1]], 32)
    assert sk.signatures(e[:0], np.zeros(1, int), 32).shape == (0, 32)


def test_a_signature_takes_few_draws(monkeypatch):
    """Sets stop drawing once their slots are taken: the numbers mixed for slots stay near slots * log(slots) a set."""
    from trendspark.llm import similarity_sketch as sk
    drawn, mixed = [], sk._mixed
    monkeypatch.setattr(sk, "_mixed", lambda x, seed: drawn.append(len(x)) or mixed(x, seed))
    e = np.random.default_rng(4).integers(0, 2**64, 200 * 350, dtype=np.uint64)
    sk.signatures(e, np.arange(0, len(e) + 1, 350), ld.BANDS * ld.ROWS)
    assert sum(drawn) < 200 * 3 * 140 * np.log(140)


def test_canonical_texts_are_canonical_lines():
    texts = ["A b\nC", " a\nb", "a \nb", "a  b\nc", "\n\nX\n", "tab\there", "ΑΣ\nΣΑ", "ÄÖ\n x", "a\x1fb\nc", "", "x\r\ny", "x y\nz"]
    for t in texts:
        assert ld.canonicals(t) == [ld.canonical(line) for line in t.split("\n")]
    assert [tuple(k) for k in ld._line_keys(["a", "b\ud800"]).tolist()] == [ld.line_key("a"), ld.line_key("b\ud800")]
