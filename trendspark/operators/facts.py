"""Fact tables: mention statistics (J1, J2, A1, A2) and metric snapshots.

Mention statistic, per item and channel:
  mention_count = number of posts of the channel whose text contains the
                  item's keyword;
  text_count    = number of posts (any channel) that contain it.
Items nobody mentions keep one row with channel NULL and zero counts.
Items sharing a keyword are each credited.

Posts count by id: a post listed twice, or matching several keywords of an
item, is one mention; a post without an id is none (its channel shows with 0).
Items without an id are left out.

Plan: gram-index match (no Python, no nested-loop join) → distinct
(post, keyword) pairs → equi-join with the items' keywords → distinct posts
per (item, channel), partially aggregated before the shuffle → left join from
the items → per-item total by a window over the (small) per-channel rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendspark.functions.text import unify_keyword
from trendspark.functions.timeutil import date_parts, text_to_date
from trendspark.operators.matching import substring_matches


def _per_channel(posts: DataFrame, items: DataFrame, *, post_id: str, channel: str, text: str,
                 item_id: str, keyword: str, by: list[str], **match_opts) -> DataFrame:
    """(item_id, by..., channel, mention_count) for every item, zero rows kept."""
    kw = unify_keyword(F.col(keyword))
    items_kw = items.select(F.col(item_id).alias("item_id"), kw.alias("keyword"), *by).where("item_id is not null").distinct()
    masks = list(match_opts.get("token_masks") or ())  # whole-token mode (see matching)
    pairs = substring_matches(posts.select(post_id, channel, text, *by, *masks),
                              items_kw.select("keyword"), text, "keyword",
                              carry=[post_id, channel, *by], **match_opts)
    counts = (pairs.join(items_kw, ["keyword", *by])
              .groupBy("item_id", *by, channel).agg(F.countDistinct(post_id).alias("mention_count")))
    return (items_kw.select("item_id", *by).distinct().join(counts, ["item_id", *by], "left")
            .select("item_id", *by, F.col(channel).alias("channel"),
                    F.coalesce("mention_count", F.lit(0)).cast("bigint").alias("mention_count")))


def mention_stats(posts: DataFrame, items: DataFrame, *, post_id: str = "post_id",
                  channel: str = "channel", text: str = "simple_text",
                  item_id: str = "item_id", keyword: str = "keyword",
                  by: tuple[str, ...] = (), **match_opts) -> DataFrame:
    """(item_id, text_count, channel, mention_count[, by...]) for every item.

    ``posts`` holds one row per post with its id, channel, normalised text
    and the optional ``by`` columns (e.g. ``date``); ``items`` holds
    (item_id, keyword[, by...]).  With ``by`` the statistic is computed per
    value of those columns and items must carry them too (one row per item
    and value), so unmentioned items still get their zero row per value.
    """
    by = list(by)
    rows = _per_channel(posts, items, post_id=post_id, channel=channel, text=text,
                        item_id=item_id, keyword=keyword, by=by, **match_opts)
    total = F.sum("mention_count").over(Window.partitionBy("item_id", *by))
    return rows.select("item_id", total.cast("bigint").alias("text_count"), "channel",
                       "mention_count", *by)


def mention_stats_two_aggregates(posts: DataFrame, items: DataFrame, *, post_id: str = "post_id",
                                 channel: str = "channel", text: str = "simple_text",
                                 item_id: str = "item_id", keyword: str = "keyword",
                                 by: tuple[str, ...] = (), **match_opts) -> DataFrame:
    """Same rows as :func:`mention_stats`, shaped as the reference job: per-item
    totals ⋈ per-channel counts on item id (J2)."""
    by = list(by)
    rows = _per_channel(posts, items, post_id=post_id, channel=channel, text=text,
                        item_id=item_id, keyword=keyword, by=by, **match_opts)
    totals = rows.groupBy("item_id", *by).agg(F.sum("mention_count").cast("bigint").alias("text_count"))
    return (totals.join(rows, ["item_id", *by], "inner")
            .select("item_id", "text_count", "channel", "mention_count", *by))


def with_partition_date(df: DataFrame, date_col: str = "date") -> DataFrame:
    """K1/K2 layout columns: year, month, day (INT) from ``date_col``."""
    return df.select("*", *date_parts(F.col(date_col)))


def metric_fact(raw: DataFrame, day=None, *, id_col: str = "id",
                metrics=("popularity", "vote_average", "vote_count"),
                stamp_col: str = "query_datetime", start=None, end=None,
                strict: bool = True) -> DataFrame:
    """Metric snapshot → fact rows (id, metrics..., date, year, month, day).

    ``day`` keeps one UTC day (P1); ``start``/``end`` keep a closed date range.
    The date filter is applied on the projected date, which Catalyst pushes
    below the projection.  ``strict=False`` turns unparsable stamps into a
    null date (those rows then fall outside any day filter) instead of
    failing the job.
    """
    d = text_to_date(F.col(stamp_col), strict).alias("date")
    out = raw.select(F.col(id_col).alias("id"), *metrics, d)
    if day is not None:
        out = out.where(F.col("date") == F.lit(_check_date(day)).cast("date"))
    if start is not None or end is not None:
        out = out.where(F.col("date").between(F.lit(_check_date(start)).cast("date"),
                                              F.lit(_check_date(end)).cast("date")))
    return with_partition_date(out)


def _check_date(value) -> str:
    """Validate a 'YYYY-MM-DD' argument on the driver (clear error, not a cast failure)."""
    import datetime as _dt
    s = str(value)
    _dt.date.fromisoformat(s)
    return s
