"""Scalar functions (FIXTURES §3.2) and time helpers (§3.3, §3.4, calendar)."""

import datetime as dt

from pyspark.sql import functions as F

from trendspark.functions import text as tx
from trendspark.functions import timeutil as tu


def one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_unify_keyword(spark):
    assert one_col(spark, ["Wicked", "", None], tx.unify_keyword) == ["wicked", None, None]


def test_alternate_keyword(spark):
    got = one_col(spark, ["thewildrobot", "wicked", "theory", "the", None, ""], tx.alternate_keyword)
    assert got == ["wildrobot", "thewicked", "ory", "", None, None]


def test_final_text(spark):
    df = spark.createDataFrame([(0, "x", None), (1, "x", ""), (2, None, "y"), (3, "x", "y"), (4, None, None)],
                               "i int, t string, b string")
    got = [r[0] for r in df.orderBy("i").select(tx.final_text("t", "b")).collect()]
    assert got == ["x", "x", "None y", "x y", None]
    alt = [r[0] for r in df.orderBy("i").select(tx.final_text("t", "b", missing_title=None)).collect()]
    assert alt[2] == "y"


def test_simple_text(spark):
    got = one_col(spark, ["Amélie: Part 2", "!!!", "", None, "Pídeme la Luna", "A,B c"], tx.simple_text)
    assert got == ["amliepart2", "", None, None, "pdemelaluna", "abc"]


def test_simple_text_matches_reference_rule(spark):
    """Equivalent to: lower, then delete every char outside [A-Za-z0-9]."""
    import random
    import re
    rnd = random.Random(7)
    alphabet = "aZ09 ,.!éÉßİKΩ\t\n-_" + "abcXYZ"
    vals = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 30))) for _ in range(300)]
    got = one_col(spark, vals, tx.simple_text)
    want = [re.sub(r"[^A-Za-z0-9]", "", v.lower()) for v in vals]
    assert got == want


def test_channel_name(spark):
    assert one_col(spark, ["r/TrueFilm", "r/", "", None], tx.channel_name) == ["truefilm", "", None, None]


def test_iso_weekday(spark):
    got = one_col(spark, [dt.date(2024, 1, 1), dt.date(2024, 12, 29)], tu.iso_weekday, "date")
    assert got == [1, 7]


def test_epoch_helpers(spark):
    got = spark.range(1).select(tu.epoch_to_date(F.lit(1733659200.5)).alias("d"),
                                tu.epoch_to_text(F.lit(1733659200.5)).alias("t")).first()
    assert got["d"] == dt.date(2024, 12, 8) and got["t"] == "2024-12-08 12:00:00"


def test_hour_slice_bounds(spark):
    stamps = ["2024-12-08 12:00:00", "2024-12-08 12:30:00", "2024-12-08 13:00:00"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").select(F.col("s").cast("timestamp").alias("ts"))
    s, e = "2024-12-08 12:00:00", "2024-12-08 13:00:00"
    op = [r.ts.strftime("%H:%M") for r in df.where(tu.in_interval("ts", s, e, "open")).collect()]
    ho = sorted(r.ts.strftime("%H:%M") for r in df.where(tu.in_interval("ts", s, e)).collect())
    assert op == ["12:30"] and ho == ["12:00", "12:30"]


def test_hour_grid(spark):
    df = spark.createDataFrame([("2024-12-08 10:37:00", "2024-12-08 13:05:00"),
                                ("2024-12-08 10:05:00", "2024-12-08 10:55:00")], "s string, e string")
    df = df.select(F.col("s").cast("timestamp").alias("s"), F.col("e").cast("timestamp").alias("e"))
    got = [[t.strftime("%H:%M") for t in r[0]] for r in df.select(tu.hour_grid("s", "e")).collect()]
    assert got == [["10:00", "11:00", "12:00"], []]


def test_calendar_parity_and_full(spark):
    b = spark.range(1).select(F.lit("2024-06-01").cast("date").alias("start"))
    cal = tu.calendar(b, "start", 1)
    r = cal.agg(F.count("*"), F.min("date"), F.max("date")).first()
    assert (r[0], r[1], r[2]) == (365, dt.date(2024, 1, 1), dt.date(2024, 12, 30))
    first = cal.where(F.col("date") == "2024-01-01").first()
    assert (first.weekday, first.day, first.month, first.year) == (1, 1, 1, 2024)
    full = tu.calendar(b, "start", 1, full_years=True)
    assert full.count() == 366


def test_json_field_bad_input(spark):
    df = spark.createDataFrame([('{"k": 5}',), ("not json",), (None,)], "p string")
    got = [r[0] for r in df.select(tx.json_field("p", "k BIGINT")["k"]).collect()]
    assert got == [5, None, None]


def test_past_hour_interval(spark):
    s, e = tu.past_hour_interval("2024-12-08 13:37:10")
    r = spark.range(1).select(s.alias("s"), e.alias("e")).first()
    assert (r.s.strftime("%H:%M:%S"), r.e.strftime("%H:%M:%S")) == ("12:00:00", "13:00:00")


def test_path_parts_zero_padded(spark):
    df = spark.range(1).select(F.lit("2024-01-05 07:00:00").cast("timestamp").alias("t"))
    r = df.select(*tu.path_parts("t")).first()
    assert (r.year, r.month, r.day, r.hour) == ("2024", "01", "05", "07")
