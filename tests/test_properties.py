"""Property tests: the native expressions equal plain-Python statements of
the reference's rules on random inputs (empty, null, accents, punctuation)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trendspark.functions import text as tx

ALPHABET = st.sampled_from(list("aAzZ09 the,.!-_éÉßİıKΩ\t") + ["r/", "The", "THE"])
TEXT = st.one_of(st.none(), st.lists(ALPHABET, max_size=12).map("".join))
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


# Plain-Python statements of the rules.
def py_unify(k):
    return k.lower() if k else None


def py_alternate(k):
    if k and k.startswith("the"):
        return k[3:]
    if k:
        return "the" + k
    return None


def py_final(title, body):
    return f"{title} {body}" if body else title


def py_simple(t):
    return re.sub(r"[^A-Za-z0-9]", "", t.lower()) if t else None


def py_channel(s):
    return s[2:].lower() if s else None


def spark_eval(spark, pairs, expr):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


@SETTINGS
@given(st.lists(st.tuples(TEXT, TEXT), min_size=1, max_size=30))
def test_text_functions_match_rules(spark, pairs):
    a = [p[0] for p in pairs]
    assert spark_eval(spark, pairs, tx.unify_keyword("a")) == [py_unify(x) for x in a]
    assert spark_eval(spark, pairs, tx.channel_name("a")) == [py_channel(x) for x in a]
    assert spark_eval(spark, pairs, tx.simple_text("a")) == [py_simple(x) for x in a]
    assert spark_eval(spark, pairs, tx.final_text("a", "b")) == [py_final(x, y) for x, y in pairs]
    assert spark_eval(spark, pairs, tx.alternate_keyword(tx.unify_keyword("a"))) == \
        [py_alternate(py_unify(x)) for x in a]
    assert spark_eval(spark, pairs, F.lit(1)) == [1] * len(pairs)


def test_coverage_by_day_deals_rows_to_tasks_by_their_number(spark, monkeypatch):
    from trendspark.operators import quality
    expected = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "id long")
    seen = [(1, "a"), (1, "a"), (2, "a"), (9, "a"), (None, "a"), (3, "b"), (1, None), (9, "c")]
    observed = spark.createDataFrame(seen, "item long, day string")
    monkeypatch.setattr(quality, "ROWS_A_TASK", 1, raising=False)
    out = quality.coverage_by_day(expected, observed, "id", "item", "day")
    assert {tuple(r) for r in out.collect()} == {("a", 5, 2, 3), ("b", 5, 1, 4), (None, 5, 1, 4)}
    plan = re.sub(r"#\d+L?", "", out._jdf.queryExecution().executedPlan().toString())
    assert "hashpartitioning(_k, day, 8)" in plan
