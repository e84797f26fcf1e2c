"""Ranking (FIXTURES §3.6), star join (T7) and slicing."""

import datetime as dt

from tests.conftest import rows
from trendspark.operators import trends


def totals(spark):
    return spark.createDataFrame([("a", 1), ("b", 5), ("c", 3), ("d", 3), ("e", 2)], "name string, total long")


def test_trim_top_three(spark):
    assert rows(trends.trim_top(totals(spark), 3), "name") == [("a",), ("e",)]
    small = spark.createDataFrame([("a", 1), ("b", 2)], "name string, total long")
    assert trends.trim_top(small, 3).count() == 0


def test_top_after_trim(spark):
    got = [r.name for r in trends.top_after_trim(totals(spark), 3, 20).collect()]
    assert got == ["e", "a"]
    assert [r.name for r in trends.top_after_trim(totals(spark), 1, 2).collect()] == ["d", "c"]


def test_name_totals_drop_nulls_and_merge(spark):
    df = spark.createDataFrame([("x", 1), ("x", 2), (None, 5)], "name string, mention_count long")
    assert rows(trends.name_totals(df)) == [("x", 3)]


def test_star_join_daily_does_not_multiply(spark):
    fact = spark.createDataFrame([(1, dt.date(2024, 12, 8), 4)], "id long, date date, mention_count long")
    met = spark.createDataFrame([(1, dt.date(2024, 12, 8), 1.5), (1, dt.date(2024, 12, 9), 2.5)],
                                "id long, date date, popularity double")
    cal = spark.createDataFrame([(dt.date(2024, 12, 8), 7), (dt.date(2024, 12, 9), 1)], "date date, weekday int")
    mov = spark.createDataFrame([(1, "Wicked")], "id long, name string")
    daily = trends.star_join(fact, met, cal, mov, daily=True)
    assert rows(daily, "id", "popularity", "weekday", "name") == [(1, 1.5, 7, "Wicked")]
    snap = trends.star_join(fact, met, cal, mov, daily=False)
    assert snap.count() == 2  # snapshot form multiplies when metrics hold two days (T7)


def test_slice_and_options(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 12, 8)), ("b", dt.date(2024, 12, 10))], "name string, date date")
    assert trends.slice_trends(df, "All", "2024-12-08", "2024-12-09").count() == 1
    assert trends.slice_trends(df, "b", "2024-12-01", "2024-12-31").count() == 1
    opts = {r.option for r in trends.name_options(df).collect()}
    assert opts == {"All", "a", "b"}
    b = trends.date_bounds(df).first()
    assert (b.min_date, b.max_date) == (dt.date(2024, 12, 8), dt.date(2024, 12, 10))


def test_trailing_sum_skips_missing_days(spark):
    df = spark.createDataFrame([("x", dt.date(2024, 1, 1), 1), ("x", dt.date(2024, 1, 5), 2),
                                ("x", dt.date(2024, 1, 9), 4)], "name string, date date, n long")
    got = rows(trends.trailing_sum(df, "n", by=("name",), out="n7"), "date", "n7")
    assert [g[1] for g in got] == [1, 3, 6]
    assert rows(trends.last_days(df, 7), "date") == [(dt.date(2024, 1, 5),), (dt.date(2024, 1, 9),)]
