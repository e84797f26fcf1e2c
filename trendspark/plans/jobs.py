"""Batch job entry points.

Each job takes a SparkSession and paths, builds one declarative plan and
ends in one write (or returns a DataFrame).  Nothing is collected to the
driver except small plan statistics (keyword-table size, see matching.py).
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from trendspark import schemas
from trendspark.functions.text import token_end_mask, token_start_mask
from trendspark.functions.timeutil import calendar
from trendspark.operators import dims, facts, quality, trends
from trendspark.session import scratch_dir
from trendspark.sources import readers, sinks
from trendspark.streaming import ingest

log = logging.getLogger("trendspark.jobs")


def _dates(df: DataFrame, start: str, end: str, days: list[str] | None = None) -> DataFrame:
    """``df`` repeated once per day in [start, end], or per listed day (a generator, not a join)."""
    listed = (F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date")) if days is None
              else F.array(*[F.lit(d).cast("date") for d in days]))
    return df.select("*", F.explode(listed).alias("date"))


def _epoch_bounds(start: str, end: str) -> tuple[float, float]:
    """Epoch seconds of start 00:00 UTC and of the day after ``end``."""
    import datetime as _dt
    utc = _dt.timezone.utc
    s = _dt.datetime.fromisoformat(start).replace(tzinfo=utc)
    e = _dt.datetime.fromisoformat(end).replace(tzinfo=utc) + _dt.timedelta(days=1)
    return float(s.timestamp()), float(e.timestamp())


def mention_fact(spark: SparkSession, posts_path: str, items_path: str, date: str | None = None,
                 start: str | None = None, end: str | None = None,
                 num_partitions: int | None = None, day_folders: bool = True,
                 missing_title: str | None = "None", observation=None,
                 whole_tokens: bool = False, posts_format: str = "json", days: list[str] | None = None) -> DataFrame:
    """E1 plan: mention statistic per item, channel and UTC day.

    ``date`` (one day), ``start``/``end`` (closed range) or ``days`` (a list).  Posts are read
    with the declared schema; only the requested ``Y/M/D`` landing folders are
    listed (``day_folders=False``: the whole root).  ``posts_format="parquet"``
    reads the archive of an ingest.  Unmentioned items
    get one zero row per day (T2).
    """
    if days:
        days = sorted(map(facts._check_date, days))
        start, end = days[0], days[-1]
    start = facts._check_date(start or date)
    end = facts._check_date(end or date or start)
    items = readers.read_items(spark, items_path)
    if day_folders:
        raw = readers.read_posts(spark, posts_path, start, end, fmt=posts_format, days=days)
    else:
        raw = readers.read_posts(spark, posts_path, fmt=posts_format)
    if observation is not None:  # A9 counters, computed while the scan runs
        raw = raw.observe(observation, F.count(F.lit(1)).alias("rows_read"),
                          F.count("_corrupt_record").alias("malformed_lines"))
    # The UTC day of an epoch stamp is in [start, end] exactly when the stamp
    # is in [start 00:00, end+1 00:00); this plain range on the raw column is
    # pushed into the JSON/Parquet reader, so other days are dropped while
    # parsing.  The date filter below stays as the definition.
    lo, hi = _epoch_bounds(start, end)
    raw = raw.where((F.col("created_utc") >= F.lit(lo)) & (F.col("created_utc") < F.lit(hi)))
    posts = readers.normalise_posts(raw, missing_title=missing_title)
    posts = posts.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    if days:
        posts = posts.where(F.col("date").isin(*[F.lit(d).cast("date") for d in days]))
    opts = {}
    if whole_tokens:  # T10 option: occurrences must start and end on token boundaries
        posts = posts.select("*", token_start_mask("final_text").alias("_sm"),
                             token_end_mask("final_text").alias("_em"))
        opts["token_masks"] = ("_sm", "_em")
    if num_partitions:
        posts = posts.repartition(num_partitions)  # E7: explicit parallelism
    stats = facts.mention_stats(posts, _dates(items.select("item_id", "keyword"), start, end, days),
                                by=("date",), **opts)
    return facts.with_partition_date(stats)


def run_mention_fact(spark: SparkSession, posts_path: str, items_path: str, out: str,
                     date: str | None = None, counters: bool = False, **kw) -> dict:
    """Build and write the mention fact; reruns replace only their days.

    ``counters=True`` also returns (and logs) counters observed on the posts
    scan during the same write: lines read and malformed lines.  Counting
    every line needs the unfiltered scan, so it turns off the epoch-range
    pushdown into the reader; the default keeps the pushdown and returns {}.
    """
    obs = Observation("mention_fact_input") if counters else None
    sinks.write_fact(mention_fact(spark, posts_path, items_path, date, observation=obs, **kw), out)
    if obs is None:
        return {}
    counters = dict(obs.get)
    log.info("mention fact %s..%s written to %s: %s", kw.get("start") or date, kw.get("end") or date,
             out, counters)
    return counters


def refresh_mention_fact(spark: SparkSession, archive: str, items_path: str, out: str, **kw) -> list[str]:
    """D6 + E1: build the mention fact again for the days that an ingest touched
    since the last refresh; the days, in order.

    The ledger beside the archive names the days of every batch, late posts'
    too.  Only those days are read and only their folders replaced; the ledger
    entries are marked as done (``<out>_refreshed``) behind the write, so a
    refresh that stopped is done again.
    """
    todo = scratch_dir(spark, "refresh")
    ingest.touched_days(spark, archive, f"{out}_refreshed").write.mode("overwrite").parquet(todo)
    todo = spark.read.parquet(todo)  # entries that come from now on are for the next refresh
    days = sorted(f"{r.year}-{r.month}-{r.day}" for r in todo.select("year", "month", "day").distinct().collect() if r.year is not None)
    if days:
        sinks.write_fact(mention_fact(spark, archive, items_path, days=days, posts_format="parquet", **kw), out)
    todo.select("entry").write.mode("append").parquet(f"{out}_refreshed")
    return days


def run_metric_fact(spark: SparkSession, metrics_path: str, out: str, date: str,
                    day_folders: bool = True) -> None:
    """Metric snapshot of one day → partitioned metric fact (dynamic overwrite).

    With ``day_folders`` only that day's landing folder is listed and read
    (the date filter on ``query_datetime`` is still applied).
    """
    date = facts._check_date(date)
    raw = (readers.read_metrics(spark, metrics_path, date, date) if day_folders
           else readers.read_metrics(spark, metrics_path))
    sinks.write_fact(facts.metric_fact(raw, date), out)


def build_dimensions(spark: SparkSession, snapshot: DataFrame, as_of: str,
                     num_years: int = 1, full_years: bool = True) -> dict[str, DataFrame]:
    """E3 plan: genre, company and item dimensions plus the calendar.

    The view joins the calendar, so it has every day of its years;
    ``full_years=False`` gives 365 days a year.
    """
    out = dims.build_dims(snapshot)
    bounds = spark.range(1).select(F.lit(as_of).cast("date").alias("start"))
    out["date"] = calendar(bounds, "start", num_years, full_years)
    return out


def run_build_dims(spark: SparkSession, metrics_path: str, out_root: str, load: str,
                   as_of: str, fmt: str = "parquet", **kw) -> None:
    """Write every dimension under ``<out_root>/<name>/dataload=<load>``, as one load.

    Built from the snapshot landed for ``as_of`` only (one row per item, as
    the reference's one query per item); reading every landed day would
    repeat each item once per day and multiply the star join.
    """
    as_of = facts._check_date(as_of)
    snapshot = readers.read_metrics(spark, metrics_path, as_of, as_of)
    sinks.write_load(build_dimensions(spark, snapshot, as_of, **kw), out_root, load, fmt)


def merge_dimensions(spark: SparkSession, metrics_path: str, out_root: str, day: str) -> None:
    """E3 across loads: the genre and company dimensions of the newest complete
    load with one more landed day, written as the load of that day."""
    day = facts._check_date(day)
    snapshot, names = readers.read_metrics(spark, metrics_path, day, day), ("genres", "production_companies")
    try:
        stored = readers.read_load(spark, out_root, names)
    except (ValueError, AnalysisException):  # no load yet
        stored = {}
    sinks.write_load({"genres": dims.merge_pairs(stored.get("genres"), dims.genre_dim(snapshot)),
                      "production_companies": dims.merge_companies(stored.get("production_companies"), snapshot, day)},
                     out_root, day.replace("-", ""))


def land_metrics(spark: SparkSession, incoming: DataFrame, out: str, items: DataFrame,
                 as_of: str | None = None) -> DataFrame:
    """E5: stamp and land one day of metric snapshots; returns the coverage
    tally (items expected vs. items present) of the rows of this landing, on
    whatever day their own stamps put them."""
    stamp = F.lit(as_of) if as_of else F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    stamped = incoming.withColumn("query_datetime", F.coalesce(F.col("query_datetime"), stamp))
    sinks.land_daily(stamped, out, "query_datetime")
    return quality.coverage_summary(items.select(F.col("item_id").alias("id")), stamped.select("id"), "id")


def build_trends(spark: SparkSession, fact_root: str, metrics_root: str, dims_root: str,
                 start: str, end: str, load: str | None = None, daily: bool = True,
                 dims_format: str = "parquet") -> DataFrame:
    """The star view behind the dashboard for a closed date range.

    Only the requested day partitions of both facts are read, and the dimensions
    of one complete load (the newest if ``load`` is None).  ``daily``
    joins metrics on (id, date); ``daily=False`` expects one snapshot day.
    """
    fact = readers.read_fact_range(spark, fact_root, start, end, schemas.MENTION_FACT) \
        .withColumnRenamed("item_id", "id")
    met = readers.read_fact_range(spark, metrics_root, start, end, schemas.METRIC_FACT) \
        .drop("year", "month", "day")
    kinds = {"date": schemas.CALENDAR, "mov": schemas.ITEM_DIM}
    dim = readers.read_load(spark, dims_root, tuple(kinds), load, dims_format, kinds if dims_format == "csv" else None)
    return trends.star_join(fact.drop("year", "month", "day"), met, dim["date"], dim["mov"], daily=daily)


def rank_totals(view: DataFrame, k: int = 3, n: int | None = None, last: int | None = None) -> DataFrame:
    """E6 ranking: totals per name without the k largest; top ``n`` if given.
    ``last``: only the last so many days of the view count."""
    if last is not None:
        view = trends.last_days(view, last)
    totals = trends.name_totals(view, "name", "mention_count", "total")
    if n is None:
        return trends.trim_top(totals, k)
    return trends.top_after_trim(totals, k, n)
