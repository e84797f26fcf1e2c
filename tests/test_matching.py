"""Gram-index matcher: exact against brute force, in every plan shape."""

import random

import pytest
from pyspark.sql import functions as F

from trendspark.operators import matching as M


def brute(texts, kws):
    return {(i, k) for i, s in texts if s is not None for k in set(kws) if k and k in s}


def run(spark, texts, kws, **opts):
    t = spark.createDataFrame(texts, "id long, s string")
    k = spark.createDataFrame([(x,) for x in kws], "keyword string")
    return {tuple(r) for r in M.substring_matches(t, k, "s", carry=["id"], **opts).collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    alpha = "abc"  # small alphabet: many overlaps, repeats and near misses
    texts = [(i, "".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 80)))) for i in range(60)]
    texts.append((999, None))
    kws = ["".join(rnd.choice(alpha) for _ in range(rnd.randint(1, 20))) for _ in range(40)] + ["", None]
    want = brute(texts, kws)
    assert run(spark, texts, kws) == want
    # shuffle-join path (no broadcast) gives the same pairs
    assert run(spark, texts, kws, broadcast_max_bytes=0) == want
    # keyword grams split into broadcast chunks, one text pass per chunk
    kdf = spark.createDataFrame([(x,) for x in kws], "keyword string").where("keyword <> ''").distinct()
    _, size = M.plan_tiers(kdf)
    assert run(spark, texts, kws, broadcast_max_bytes=size // 3 + 1) == want
    # other exact tier layouts too
    assert run(spark, texts, kws, tiers=((1, 0, 1),)) == want
    assert run(spark, texts, kws, tiers=((9, 5, 5), (1, 0, 1))) == want


def test_unicode_and_overlaps(spark):
    texts = [(1, "ééabcé"), (2, "aaaa"), (3, "xyz"), (4, "wherewolf")]
    kws = ["é", "abcé", "aa", "aaaa", "aaaaa", "here", "wolf", "ééa"]
    assert run(spark, texts, kws) == brute(texts, kws)


def test_candidates_count_every_occurrence(spark):
    t = spark.createDataFrame([(1, "abcabcabc")], "id long, s string")
    k = spark.createDataFrame([("abc",), ("bcab",)], "keyword string")
    got = sorted(tuple(r) for r in M.substring_candidates(t, k, "s", carry=["id"]).collect())
    assert got == [(1, "abc")] * 3 + [(1, "bcab")] * 2


def test_keyword_lists_and_any(spark):
    t = spark.createDataFrame([(1, "onmoanaandwicked"), (2, "nothing"), (3, None)], "id long, s string")
    k = spark.createDataFrame([("wicked",), ("moana",)], "keyword string")
    lists = {r.id: r.mentions for r in M.keyword_lists(t, k, "s", "id").collect()}
    assert lists == {1: ["moana", "wicked"], 2: [], 3: []}
    assert [r.id for r in M.texts_matching_any(t, k, "s", carry=["id"]).collect()] == [1]


def test_no_keywords(spark):
    t = spark.createDataFrame([(1, "abc")], "id long, s string")
    k = spark.createDataFrame([(None,), ("",)], "keyword string")
    assert M.substring_matches(t, k, "s", carry=["id"]).count() == 0


def test_plan_is_broadcast_hash_join(spark):
    t = spark.createDataFrame([(1, "abcdefghijklmnopqrstuvwxyz")], "id long, s string")
    k = spark.createDataFrame([("klmnopqrstuvwxy",), ("cde",)], "keyword string")
    plan = M.substring_matches(t, k, "s", carry=["id"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "PythonUDF" not in plan


def test_long_text_spans_chunks(spark, monkeypatch):
    """Occurrences across chunk borders are found (small chunk for the test)."""
    monkeypatch.setattr(M, "_CHUNK", 16)
    rnd = random.Random(11)
    texts = [(i, "".join(rnd.choice("ab") for _ in range(rnd.randint(0, 120)))) for i in range(30)]
    kws = ["".join(rnd.choice("ab") for _ in range(rnd.randint(1, 24))) for _ in range(30)]
    assert run(spark, texts, kws) == brute(texts, kws)


@pytest.mark.parametrize("seed", [5, 6])
def test_long_keywords_use_long_strides(spark, seed):
    """Keywords of 30–120 bytes (tiers with strides 8, 32 and 64), cut from
    the texts themselves so that hits, overlaps and near misses occur."""
    rnd = random.Random(seed)
    texts = [(i, "".join(rnd.choice("ab") for _ in range(rnd.randint(100, 400)))) for i in range(40)]
    kws = []
    for _ in range(30):
        i, s = texts[rnd.randrange(len(texts))]
        n = rnd.randint(30, 120)
        if len(s) > n:
            p = rnd.randrange(len(s) - n)
            k = s[p:p + n]
            if rnd.random() < 0.3:  # near miss: flip one byte
                q = rnd.randrange(n)
                k = k[:q] + ("a" if k[q] == "b" else "b") + k[q + 1:]
            kws.append(k)
    want = brute(texts, kws)
    assert len(want) > 0
    assert run(spark, texts, kws) == want
    kdf = spark.createDataFrame([(x,) for x in kws], "keyword string")
    plan, _ = M.plan_tiers(kdf)
    assert {t.stride for t in plan} & {32, 64}


def brute_tokens(texts, kws):
    """Whole-token rule: some run of consecutive tokens concatenates to k."""
    import re
    out = set()
    for i, s in texts:
        if not s:
            continue
        toks = [t for t in re.split(r"[^a-z0-9]+", s.lower()) if t]
        runs = {"".join(toks[a:b]) for a in range(len(toks)) for b in range(a + 1, len(toks) + 1)}
        out |= {(i, k) for k in set(kws) if k and k in runs}
    return out


@pytest.mark.parametrize("seed", [21, 22])
def test_whole_token_mode_against_brute_force(spark, seed):
    from trendspark.functions import simple_text, token_end_mask, token_start_mask
    rnd = random.Random(seed)
    texts = [(i, "".join(rnd.choice("ab ,Ab-é") for _ in range(rnd.randint(0, 40)))) for i in range(60)]
    kws = ["".join(rnd.choice("ab") for _ in range(rnd.randint(1, 9))) for _ in range(40)]
    t = spark.createDataFrame(texts, "id long, raw string").select(
        "id", simple_text("raw").alias("s"), token_start_mask("raw").alias("sm"),
        token_end_mask("raw").alias("em"))
    k = spark.createDataFrame([(x,) for x in kws], "keyword string")
    for opts in ({}, {"broadcast_max_bytes": 0}):
        got = {tuple(r) for r in M.substring_matches(t, k, "s", carry=["id"], token_masks=("sm", "em"),
                                                      **opts).collect()}
        assert got == brute_tokens(texts, kws)
    # substring mode on the same frame is unchanged
    plain = {tuple(r) for r in M.substring_matches(t, k, "s", carry=["id"]).collect()}
    assert plain == brute([(i, M_simple(s)) for i, s in texts], kws)


def M_simple(s):
    import re
    return re.sub(r"[^A-Za-z0-9]", "", s.lower()) if s else None


def test_whole_token_examples(spark):
    from trendspark.functions import simple_text, token_end_mask, token_start_mask
    t = spark.createDataFrame([(1, "Where to watch"), (2, "The Lion King!"), (3, "lionking")], "id long, raw string")
    t = t.select("id", simple_text("raw").alias("s"), token_start_mask("raw").alias("sm"),
                 token_end_mask("raw").alias("em"))
    k = spark.createDataFrame([("here",), ("thelionking",), ("lion",), ("lionking",)], "keyword string")
    got = {tuple(r) for r in M.substring_matches(t, k, "s", carry=["id"], token_masks=("sm", "em")).collect()}
    assert got == {(2, "thelionking"), (2, "lion"), (2, "lionking"), (3, "lionking")}


def test_shuffle_path_without_carry_is_refused(spark):
    texts = spark.createDataFrame([(1, "abcdef")], "id int, t string")
    kws = spark.createDataFrame([("abc",), ("def",)], "keyword string")
    with pytest.raises(ValueError, match="carry"):
        M.substring_candidates(texts, kws, "t", broadcast_max_bytes=1, max_passes=0)
    got = M.substring_candidates(texts, kws, "t", carry=["id"], broadcast_max_bytes=1, max_passes=0)
    assert sorted(r.keyword for r in got.collect()) == ["abc", "def"]
