"""Date and time helpers (F6–F15, W4, N3) as native expressions.

All of them assume ``spark.sql.session.timeZone = UTC`` (see session.py).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendspark.functions.text import _c

DATETIME_FMT = "yyyy-MM-dd HH:mm:ss"
DATE_FMT = "yyyy-MM-dd"


def epoch_to_date(c) -> Column:
    """epoch seconds (fraction truncated) → UTC date."""
    return F.to_date(F.timestamp_seconds(_c(c)))


def epoch_to_text(c) -> Column:
    """epoch seconds → 'yyyy-MM-dd HH:mm:ss' (UTC)."""
    return F.date_format(F.timestamp_seconds(_c(c)), DATETIME_FMT)


def ts_to_epoch(c) -> Column:
    """Timestamp (NTZ or LTZ) → whole epoch seconds as double."""
    return F.unix_seconds(_c(c).cast("timestamp")).cast("double")


def text_to_date(c, strict: bool = True) -> Column:
    """datetime text → date; ``strict=False`` gives null for dirty input."""
    return F.to_date(_c(c)) if strict else F.try_to_date(_c(c))


def date_parts(c) -> list[Column]:
    """F8: year, month, day-of-month columns (INT)."""
    d = _c(c)
    return [F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day")]


def date_from_parts(y="year", m="month", d="day") -> Column:
    """date from (year, month, day)."""
    return F.make_date(_c(y), _c(m), _c(d))


def format_date(c) -> Column:
    """date → 'yyyy-MM-dd'."""
    return F.date_format(_c(c), DATE_FMT)


def iso_weekday(c) -> Column:
    """ISO weekday, Monday = 1 … Sunday = 7."""
    return F.weekday(_c(c)) + 1


def hour_floor(c) -> Column:
    """Start of the hour containing the stamp."""
    return F.date_trunc("hour", _c(c))


def past_hour_interval(as_of=None) -> tuple[Column, Column]:
    """[floor(now) - 1 h, floor(now)); ``as_of`` pins 'now' for tests."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    end = F.date_trunc("hour", now)
    return end - F.expr("INTERVAL 1 HOUR"), end


def path_parts(c) -> list[Column]:
    """zero-padded year, month, day, hour strings of a stamp."""
    t = _c(c)
    return [F.date_format(t, "yyyy").alias("year"), F.date_format(t, "MM").alias("month"),
            F.date_format(t, "dd").alias("day"), F.date_format(t, "HH").alias("hour")]


def in_interval(c, start, end, bounds: str = "half_open") -> Column:
    """Interval test.  'half_open' = [start, end); 'open' = (start, end)
    (reference parity: a stamp exactly on the hour is in neither slice)."""
    t = _c(c)
    # String bounds stay literals: Spark coerces them to the column's own
    # type (TIMESTAMP or TIMESTAMP_NTZ), which keeps the predicate pushable.
    s = F.lit(start) if isinstance(start, str) else start
    e = F.lit(end) if isinstance(end, str) else end
    if bounds == "open":
        return (t > s) & (t < e)
    if bounds == "half_open":
        return (t >= s) & (t < e)
    if bounds == "closed":
        return (t >= s) & (t <= e)
    raise ValueError(f"unknown bounds {bounds!r}")


def hour_grid(start, end) -> Column:
    """Array of hour starts in [floor(start), floor(end)); empty if start >= end."""
    s, e = F.date_trunc("hour", _c(start)), F.date_trunc("hour", _c(end))
    one = F.expr("INTERVAL 1 HOUR")
    return F.when(s < e, F.sequence(s, e - one, one)).otherwise(F.array().cast("array<timestamp>"))


def calendar(bounds: DataFrame, start_col: str = "start", num_years: int | str = 1,
             full_years: bool = False) -> DataFrame:
    """Calendar dimension (date, weekday, day, month, year).

    ``bounds`` holds one row per calendar to build: ``start_col`` is any
    date in the first year and ``num_years`` a literal or a column name.
    Parity mode (default) emits 365·n days from 1 January, so a leap year
    ends on 30 December; ``full_years=True`` gives real calendar years.
    Rows are generated per input row, so the work is spread over tasks.
    """
    n = F.lit(num_years) if isinstance(num_years, int) else F.col(num_years)
    first = F.make_date(F.year(F.col(start_col)), F.lit(1), F.lit(1))
    if full_years:
        last = F.date_sub(F.add_months(first, n * 12), 1)
    else:
        last = F.date_add(first, n * 365 - 1)
    d = F.col("date")
    return (bounds.select(F.explode(F.sequence(first, last)).alias("date"))
            .select(d, iso_weekday(d).cast("int").alias("weekday"), F.dayofmonth(d).alias("day"),
                    F.month(d).alias("month"), F.year(d).alias("year")))
