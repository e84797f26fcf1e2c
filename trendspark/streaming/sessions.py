"""Bounded collection sessions over a landing, one offset a channel.

The reference's collector stops a session after so many posts or seconds.  Here a
session takes, of every channel, the rows behind the channel's offset in order
of arrival: at most ``posts`` of them, that arrived within ``seconds`` of the
first one taken.  Arrival is the landed file's modification time, then its path,
then the row's place in it, so it is total, and every row is taken by exactly
one session.

A session writes its rows under ``session=<n>`` first and its offsets
last; one that stopped between the two is run again under the same number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendspark.streaming.ingest import _has_entries

_PLACE = ("arrived", "arrived_file", "arrived_row")


def arrivals(spark: SparkSession, landing: str, since=None) -> DataFrame:
    """Rows of a Parquet landing with their place of arrival; files older than ``since`` are not read."""
    rows = spark.read.option("recursiveFileLookup", True).parquet(landing)
    rows = rows.select("*", F.col("_metadata.file_modification_time").alias("arrived"),
                       F.col("_metadata.file_path").alias("arrived_file"), F.col("_metadata.row_index").alias("arrived_row"))
    return rows if since is None else rows.where(F.col("arrived") >= since)


def channel_offsets(spark: SparkSession, offsets: str) -> DataFrame | None:
    """(channel, place): the last row taken of every channel."""
    if not _has_entries(spark, offsets):
        return None
    place = F.struct(*_PLACE)
    return spark.read.parquet(offsets).groupBy("channel").agg(F.max(place).alias("place"))


def pending(spark: SparkSession, landing: str, offsets: str, channel: str) -> DataFrame:
    """Rows behind the offset of their channel (null is a channel too)."""
    known = channel_offsets(spark, offsets)
    if known is None:
        return arrivals(spark, landing)
    since = known.agg(F.min("place.arrived")).scalar()  # whole files before it were taken by every channel
    rows = arrivals(spark, landing, since)
    known = known.select(F.col("channel").alias("_channel"), F.col("place").alias("_place"))
    j = rows.join(known, F.col(channel).eqNullSafe(F.col("_channel")), "left")
    return j.where(F.col("_place").isNull() | (F.struct(*_PLACE) > F.col("_place"))).drop("_channel", "_place")


def run_session(spark: SparkSession, landing: str, offsets: str, out: str, *, channel: str = "channel", posts: int = 100,
                seconds: int = 60) -> int:
    """One session; the number of rows taken (0: nothing is pending, nothing is written)."""
    last = spark.read.parquet(offsets).agg(F.max("session")).first()[0] if _has_entries(spark, offsets) else 0
    number = last + 1
    order = Window.partitionBy(channel).orderBy(*_PLACE)
    rows = pending(spark, landing, offsets, channel).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= posts)
    first = F.first("arrived").over(order)
    rows = (rows.withColumn("_first", first).where(F.unix_micros("arrived") <= F.unix_micros("_first") + seconds * 1_000_000)
            .drop("_n", "_first").withColumn("session", F.lit(number)))
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("session").parquet(out))
    if not _has_entries(spark, out):
        return 0
    taken = spark.read.parquet(out).where(F.col("session") == number)
    n = taken.count()
    if n:
        ends = taken.groupBy(F.col(channel).alias("channel")).agg(F.max(F.struct(*_PLACE)).alias("p"), F.count("*").alias("rows"))
        (ends.select("channel", *[F.col(f"p.{c}").alias(c) for c in _PLACE], "rows", F.lit(number).alias("session"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("session").parquet(offsets))
    return n


def run_sessions(spark: SparkSession, landing: str, offsets: str, out: str, *, most: int | None = None, **limits) -> int:
    """Sessions until nothing is pending, or ``most`` of them; their number."""
    done = 0
    while (most is None or done < most) and run_session(spark, landing, offsets, out, **limits):
        done += 1
    return done
