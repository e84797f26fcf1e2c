"""Landing of closed hours.

A stream whose rows carry an event time is landed hour by hour: an hour's
folder is written once, when the watermark (the latest event time seen in the
batches before, less ``delay``) has passed its end.  Rows that come for a closed
hour, or have no event time, go to the late folder, so no closed hour's file is
touched again.

``<out>_open`` holds the rows of open hours by day and batch, ``<out>_late`` the
late ones by batch and day, ``<out>_marks`` the latest event time after each batch,
written last.  Every write replaces what the same batch wrote before, so a batch
run again leaves the same files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trendspark.functions.timeutil import path_parts
from trendspark.sources.sinks import TEXT_TIME_OPTIONS, land_hourly
from trendspark.streaming.ingest import _has_entries

_HOUR = 3_600_000_000
_DAY = 24


def _replace(df: DataFrame, out: str, *parts: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(out))


class HourLanding:
    """The foreachBatch function of a closed-hour landing, and its end."""

    def __init__(self, spark: SparkSession, out: str, ts: str, delay_seconds: int, fmt: str = "json"):
        self.spark, self.out, self.ts, self.fmt, self.delay = spark, out, ts, fmt, delay_seconds * 1_000_000
        self.open, self.late, self.marks = f"{out}_open", f"{out}_late", f"{out}_marks"

    def _latest(self, number: int) -> int | None:
        """Latest event time (microseconds) of the batches before ``number``."""
        if not _has_entries(self.spark, self.marks):
            return None
        return self.spark.read.parquet(self.marks).where(F.col("batch") < number).agg(F.max("latest")).first()[0]

    def _limit(self, latest: int | None) -> int | None:
        """Hours (since 1970) below this are closed."""
        return None if latest is None else (latest - self.delay) // _HOUR

    def _close(self, number: int, before: int | None, latest: int | None) -> None:
        """Land the hours closed by ``latest`` and not ``before``, then mark the batch."""
        if latest is None:
            return
        limit, done = self._limit(latest), self._limit(before)
        if _has_entries(self.spark, self.open) and limit != done:
            rows = self.spark.read.parquet(self.open).where((F.col("day_no") <= limit // _DAY) & (F.col("hour_no") < limit))
            if done is not None:
                rows = rows.where((F.col("day_no") >= done // _DAY) & (F.col("hour_no") >= done))
            land_hourly(rows.drop("day_no", "hour_no", "batch"), self.out, self.ts, self.fmt)
        _replace(self.spark.range(1).select(F.lit(latest).cast("long").alias("latest"), F.lit(number).alias("batch")), self.marks, "batch")

    def process(self, batch: DataFrame, number: int) -> None:
        before = self._latest(number)
        limit = self._limit(before)
        hour = F.floor(F.unix_micros(F.col(self.ts).cast("timestamp")) / F.lit(_HOUR)).cast("long")
        b = batch.withColumn("hour_no", hour).withColumn("batch", F.lit(number)).persist()
        try:
            late = F.col("hour_no").isNull() if limit is None else F.coalesce(F.col("hour_no") < limit, F.lit(True))
            n, n_late, latest = b.agg(F.count("*"), F.coalesce(F.sum(late.cast("int")), F.lit(0)),
                                      F.max(F.unix_micros(F.col(self.ts).cast("timestamp")))).first()
            if n_late:
                _replace(b.where(late).drop("hour_no").select("*", *path_parts(F.col(self.ts))), self.late, "batch", "year", "month", "day")
            if n > n_late:
                rows = b.where(~late).withColumn("day_no", F.floor(F.col("hour_no") / _DAY))
                _replace(rows.hint("rebalance", "day_no"), self.open, "day_no", "batch")
            self._close(number, before, max((x for x in (before, latest) if x is not None), default=None))
        finally:
            b.unpersist()

    def finish(self) -> None:
        """Close every hour that is still open: rows for them are late from now on."""
        if not _has_entries(self.spark, self.open):
            return
        last = self.spark.read.parquet(self.marks).agg(F.max("batch")).first()[0]
        before = self._latest(last + 1)
        top = self.spark.read.parquet(self.open).agg(F.max("hour_no")).first()[0]
        self._close(last, before, max(before, (top + 1) * _HOUR + self.delay))


def start_hour_landing(stream: DataFrame, out: str, ts: str, delay_seconds: int, checkpoint: str, *, fmt: str = "json",
                       trigger: dict | None = None) -> tuple[StreamingQuery, HourLanding]:
    """Start the landing of ``stream``; its query and the landing (for ``finish``)."""
    landing = HourLanding(stream.sparkSession, out, ts, delay_seconds, fmt)
    w = stream.writeStream.foreachBatch(landing.process).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start(), landing


def read_landed_hours(spark: SparkSession, out: str, schema, fmt: str = "json") -> DataFrame:
    """Closed hours and late rows together, with ``late`` telling them apart."""
    names = [f.name for f in schema.fields]
    closed = spark.read.schema(schema).options(**TEXT_TIME_OPTIONS).option("recursiveFileLookup", True).format(fmt).load(out)
    closed = closed.select(*names, F.lit(False).alias("late"))
    if not _has_entries(spark, f"{out}_late"):
        return closed
    return closed.unionByName(spark.read.parquet(f"{out}_late").select(*names, F.lit(True).alias("late")))
