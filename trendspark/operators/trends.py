"""Star join, ranking, time series and slicing.

All of these return DataFrames; nothing is collected.  Global orderings are
done as bounded top-k (``orderBy().limit()`` → per-task top-k then a merge of
k rows) instead of a window over the whole table, which would put every row
in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def star_join(fact: DataFrame, metrics: DataFrame, calendar: DataFrame, items: DataFrame, *,
              key: str = "id", date: str = "date", daily: bool = True,
              broadcast_calendar: bool = True) -> DataFrame:
    """J3/J3b + J4 + J5: fact ⋈ metrics ⋈ calendar ⋈ item dimension.

    ``daily=True`` joins metrics on (key, date), which stays correct when the
    metric table holds many days.  ``daily=False`` is the snapshot form: the
    metric table must hold one snapshot (one row per key); its date column,
    if any, is dropped so it cannot collide.  The calendar is broadcast: it
    has one row per day, a bound that does not grow with the fact.  The item
    dimension may grow with the data, so its strategy is left to Spark's
    size checks (planner threshold, then AQE on runtime sizes), with a
    sort-merge join beyond them.
    """
    if daily:
        j = fact.join(metrics, [key, date], "inner")
    else:
        m = metrics.drop(date) if date in metrics.columns else metrics
        j = fact.join(m, key, "inner")
    cal = F.broadcast(calendar) if broadcast_calendar else calendar
    return j.join(cal, date, "inner").join(items, key, "inner")


def name_totals(df: DataFrame, name: str = "name", value: str = "mention_count",
                out: str = "total") -> DataFrame:
    """A3: total of ``value`` per name; rows sharing a name merge, null names dropped."""
    return (df.where(F.col(name).isNotNull()).groupBy(name)
            .agg(F.sum(value).alias(out)))


def _rank_order(value: str, name: str) -> list[Column]:
    return [F.col(value).desc(), F.col(name).desc()]


def trim_top(totals: DataFrame, k: int = 3, name: str = "name", value: str = "total") -> DataFrame:
    """L2 (T8): drop the k largest totals (ties broken by name, descending).

    The last of the bounded top-k is a scalar that the totals are filtered
    by, so both read the same aggregate.  With k or fewer names the result is
    empty.
    """
    rank = F.struct(F.col(value).alias("v"), F.col(name).alias("n"))
    last = totals.orderBy(*_rank_order(value, name)).limit(k).agg(F.min(rank)).scalar()
    return totals.where(rank < last)


def top_after_trim(totals: DataFrame, k: int = 3, n: int = 20, name: str = "name",
                   value: str = "total") -> DataFrame:
    """L3: the n largest after dropping the k largest (offset k, limit n)."""
    return totals.orderBy(*_rank_order(value, name)).offset(k).limit(n)


def ascending(totals: DataFrame, name: str = "name", value: str = "total") -> DataFrame:
    """L1: ascending by total, then name (deterministic tie order)."""
    return totals.orderBy(F.col(value).asc(), F.col(name).asc())


def name_options(df: DataFrame, name: str = "name", all_label: str = "All") -> DataFrame:
    """A5: (position, option) in order: the 'All' option leads (position 0), then the distinct
    names (position 1) by name."""
    names = df.where(F.col(name).isNotNull()).select(F.lit(1).alias("position"), F.col(name).alias("option")).distinct()
    label = df.sparkSession.range(1).select(F.lit(0).alias("position"), F.lit(all_label).alias("option"))
    return label.unionByName(names).orderBy("position", "option")


def date_bounds(df: DataFrame, date: str = "date") -> DataFrame:
    """Min and max date (slider limits), one row."""
    return df.agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"))


def slice_trends(df: DataFrame, name_value: str | None = "All", start=None, end=None, *,
                 name: str = "name", date: str = "date", all_label: str = "All") -> DataFrame:
    """W2 (P4 + P5): closed date range [start, end]; name 'All' means no name filter."""
    out = df
    if start is not None:
        out = out.where(F.col(date) >= F.lit(str(start)).cast("date"))
    if end is not None:
        out = out.where(F.col(date) <= F.lit(str(end)).cast("date"))
    if name_value is not None and name_value != all_label:
        out = out.where(F.col(name) == F.lit(name_value))
    return out


def trend_series(df: DataFrame, metrics: list[str], *, date: str = "date",
                 keys: tuple[str, ...] = ("name",)) -> DataFrame:
    """Tidy series (keys..., date, metric, value) — one row per metric."""
    return df.unpivot([*keys, date], metrics, "metric", "value")


def trailing_sum(df: DataFrame, value: str, *, date: str = "date", days: int = 7,
                 by: tuple[str, ...] = (), out: str | None = None) -> DataFrame:
    """Sum over the last ``days`` calendar days, inclusive, per ``by`` group.

    A range frame on the day number, so missing days do not stretch the
    window.  Run it on per-day rows (one row per group and day).
    """
    dn = F.unix_date(F.col(date).cast("date"))
    w = Window.partitionBy(*by).orderBy(dn).rangeBetween(-(days - 1), 0)
    return df.withColumn(out or f"{value}_{days}d", F.sum(value).over(w))


def last_days(df: DataFrame, days: int = 7, date: str = "date") -> DataFrame:
    """Rows of the last ``days`` days present in the data (scalar subquery)."""
    latest = df.agg(F.max(F.col(date).cast("date"))).scalar()
    return df.where(F.col(date).cast("date") > F.date_sub(latest, days))


def running_totals(view: DataFrame, value: str, *, name: str = "name", date: str = "date") -> DataFrame:
    """(name, date, total): the sum of ``value`` up to and with each day of a name.

    Days are summed before the window, so a name's window holds a row per day.
    """
    daily = view.where(F.col(name).isNotNull()).groupBy(name, date).agg(F.sum(value).alias("v"))
    order = Window.partitionBy(name).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    return daily.select(name, date, F.sum("v").over(order).alias("total"))


def name_bucket(name, buckets: int) -> Column:
    """The folder that a name's running totals stand in."""
    return F.pmod(F.xxhash64(name), F.lit(buckets)).cast("int")


def range_totals(running: DataFrame, start, end, *, name: str = "name", date: str = "date", out: str = "total") -> DataFrame:
    """Totals per name of a closed date range from :func:`running_totals`:
    of each name the last row up to the end less the last one before the start.
    Names without a row up to the end are left out."""
    first, last = (F.lit(str(d)).cast("date") for d in (start, end))
    before = F.max_by(F.when(F.col(date) < first, F.col("total")), F.when(F.col(date) < first, F.col(date)))
    return (running.where(F.col(date) <= last).groupBy(name)
            .agg((F.max_by("total", date) - F.coalesce(before, F.lit(0))).alias(out)))
