"""Structured Streaming ingest.

The reference collects posts with a Python loop, keeps those whose title
names a known item, inserts them into a keyed SQLite table (first write
wins) and once an hour cuts the previous hour into a JSON file.  Here:

  landing (JSON/Parquet files) --readStream--> phrase filter (P2)
      --> drop non-portable fields (F16)
      --> foreachBatch: rows without a key to a reject folder, first row per
          key in the batch, staged
      --> staged rows --readStream--> dropDuplicates over all keys ever seen
          (RocksDB state) --> archive by the row's own event day, and the
          days touched to a ledger.

Because rows are partitioned by event time, a post that arrives after its
hour was first written still lands in its day and hour (D6, no cut-off), and
the ledger names its day, so that day's facts are built again.  The keyed
state belongs to the archive: replaying the same input, even with a fresh
checkpoint, adds nothing (D2), and a batch asks the state for its own keys
only.  Where the state is missing it is filled from the archive's keys first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trendspark.functions.text import drop_fields, portable_variant
from trendspark.functions.timeutil import epoch_to_text, path_parts
from trendspark.operators.matching import texts_matching_any
from trendspark.sources.readers import track_phrases

# Fixed values (must equal the collector's): fields of a raw post object that
# are not portable and are dropped before the row is serialised.
NON_PORTABLE_FIELDS = ("_reddit", "subreddit", "author", "poll_data")


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
                max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """A file source with a declared schema (bounded batches by file count)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)


def stage_raw(lines: DataFrame, value: str = "value", *, key: str = "id", created: str = "created_utc",
              drop=NON_PORTABLE_FIELDS) -> DataFrame:
    """S2 + F16: landed JSON lines as staged rows (id_str, post_datetime, raw VARIANT, bad).

    ``raw`` is the whole object without its non-portable fields; whatever else a
    post holds stays readable by path.  ``bad`` counts 1 where the line is no
    JSON object (its other columns are null); the null line is one too.
    """
    rows = lines.select(portable_variant(value, drop).alias("raw"))
    return rows.select(F.try_variant_get("raw", f"$.{key}", "string").alias("id_str"),
                       epoch_to_text(F.try_variant_get("raw", f"$.{created}", "double")).alias("post_datetime"), "raw",
                       F.col("raw").isNull().cast("int").alias("bad"))


def event_time(df: DataFrame, ts: str, out: str = "event_time") -> DataFrame:
    """Event-time column as TIMESTAMP (watermarks reject TIMESTAMP_NTZ)."""
    return df.withColumn(out, F.col(ts).cast("timestamp"))


def dedup_within_watermark(stream: DataFrame, keys, ts: str, delay: str) -> DataFrame:
    """D1 with bounded state: drop repeated keys while the key is within the
    watermark delay.  Rows later than the watermark are dropped too; an ingest
    that must keep them finds repeats by unbounded keyed state (:func:`start_ingest`)."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def hourly_counts(stream: DataFrame, ts: str, delay: str, by=()) -> DataFrame:
    """Rows per event hour (and ``by``); in append mode a window is
    emitted once the watermark passes its end."""
    w = F.window(F.col(ts), "1 hour")
    return (stream.withWatermark(ts, delay).groupBy(w.alias("w"), *by)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *by, "n"))


def start_hourly_counts(stream: DataFrame, ts: str, delay: str, out: str, checkpoint: str, by=(),
                        trigger: dict | None = None) -> StreamingQuery:
    """D4 without a wait for the watermark: each batch writes the windows it
    changed under its number (a batch run again replaces its own)."""
    def keep(batch: DataFrame, number: int) -> None:
        (batch.withColumn("batch", F.lit(number)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out))

    w = hourly_counts(stream, ts, delay, by).writeStream.outputMode("update").foreachBatch(keep)
    return w.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def latest_hourly_counts(spark: SparkSession, out: str, by=()) -> DataFrame:
    """(window_start, by..., n): the last count written for each window."""
    return spark.read.parquet(out).groupBy("window_start", *by).agg(F.max_by("n", "batch").alias("n"))


def first_per_key(batch: DataFrame, keys, order) -> DataFrame:
    """One row per key: the smallest in ``order`` (partial aggregate, skew-safe).

    Rows tied on ``order`` are broken by their own (orderable) values, so the
    pick is deterministic across runs and retries.
    """
    keys, order = list(keys), list(order)
    cols = [c for c in batch.columns if c not in keys]
    tie = [f.name for f in batch.schema.fields
           if f.name in cols and f.name not in order and not isinstance(f.dataType, T.MapType)]
    picked = batch.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.struct(*order, *tie)).alias("_r"))
    return picked.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols]).select(*batch.columns)


def new_rows_only(batch: DataFrame, archive: DataFrame | None, keys) -> DataFrame:
    """Rows whose key is not in ``archive`` (any table with the key columns) yet."""
    if archive is None:
        return batch
    return batch.join(archive.select(*keys).distinct(), list(keys), "left_anti")


ARCHIVE_PARTS = ("year", "month", "day")


def _has_entries(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists and holds something other than markers
    (``_SUCCESS``, hidden files): one top-level listing on the driver."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # no JVM access (Spark Connect): try reading instead
        try:
            return spark.read.load(path).limit(1).count() > 0
        except Exception:
            return False
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return False
    return any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(p))


def _last_number(spark: SparkSession, path: str) -> int:
    """The greatest number among the names in a folder of a checkpoint, -1 without any."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    return max((int(n) for n in names if n.isdigit()), default=-1)


def _days_of(rows: DataFrame, parts) -> Column:
    """Whether an archived row lies in one of the days of ``rows`` (a few values, so folders are pruned)."""
    days = [tuple(r) for r in rows.select(*parts).distinct().collect()]  # at most as many as days touched by a batch
    hit = F.lit(False)
    for day in days:
        same = F.lit(True)
        for name, value in zip(parts, day):
            same = same & F.col(name).cast("string").cast("int").eqNullSafe(F.lit(None if value is None else int(value)))
        hit = hit | same
    return hit


class KeyedArchive:
    """An archive that keeps the first row of every key.

    ``<archive>_state`` holds the staged rows (``staged``, deleted once read)
    and the checkpoint of the query that reads them (``keys``): its state, in
    RocksDB, is every key ever archived.  ``<archive>_days`` is the ledger: the
    days a batch touched, written before the rows.
    """

    def __init__(self, spark: SparkSession, path: str, keys, ts: str, fmt: str = "parquet", parts=ARCHIVE_PARTS,
                 observe: str | None = None):
        self.observe = observe
        self.spark, self.path, self.keys, self.ts, self.fmt, self.parts = spark, path, list(keys), ts, fmt, list(parts)
        self.staged, self.state, self.ledger = f"{path}_state/staged", f"{path}_state/keys", f"{path}_days"
        self.schema: T.StructType | None = None
        self.new = 0

    def _stage(self, rows: DataFrame, number: int, seed: bool) -> None:
        (rows.select("*", F.lit(seed).alias("_seed"), F.lit(number).alias("_batch")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(self.staged))

    def _state_partitions(self) -> int:
        """Partitions of the keyed state, fixed when its checkpoint begins: each is opened and
        committed in every batch, rows or none, so their number goes with the cores, not with
        the shuffle partitions that a session has for its largest join."""
        return min(int(self.spark.conf.get("spark.sql.shuffle.partitions")), 2 * self.spark.sparkContext.defaultParallelism)

    def _open_batch(self) -> int | None:
        """The batch that was begun and not committed, if there is one."""
        last = _last_number(self.spark, f"{self.state}/offsets")
        return last if last > _last_number(self.spark, f"{self.state}/commits") else None

    def _drain(self) -> None:
        """Run the staged rows through the keyed state to the archive."""
        again = self._open_batch()
        schema = T.StructType([*self.schema.fields, T.StructField("_seed", T.BooleanType()), T.StructField("_batch", T.IntegerType())])

        def append(batch: DataFrame, number: int) -> None:
            rows = batch.drop("_seed", "_batch").select("*", *[c for c, n in zip(path_parts(F.col(self.ts)), ("year", "month", "day", "hour"))
                                                               if n not in batch.columns])
            if number == again and _has_entries(self.spark, self.path):  # a try before this one may have written some
                stored = self.spark.read.format(self.fmt).load(self.path).where(_days_of(rows, self.parts))
                rows = new_rows_only(rows, stored, self.keys)
            rows = rows.persist()
            try:
                n = rows.count()
                if n:
                    (rows.groupBy(*[F.col(p).cast("string").alias(p) for p in self.parts]).agg(F.count(F.lit(1)).alias("rows"))
                     .withColumn("entry", F.expr("uuid()")).write.mode("append").parquet(self.ledger))
                    rows.hint("rebalance", *self.parts).write.mode("append").partitionBy(*self.parts).format(self.fmt).save(self.path)
                self.new += n
            finally:
                rows.unpersist()

        s = self.spark.readStream.schema(schema).option("cleanSource", "delete").parquet(self.staged)
        s = s.dropDuplicates(self.keys).where("not _seed")
        if self.observe:
            s = s.observe(f"{self.observe}_new", F.count(F.lit(1)).alias("rows"))
        q = s.writeStream.foreachBatch(append).option("checkpointLocation", self.state).trigger(availableNow=True)
        tags = self.spark.sparkContext.getJobTags()  # of the query whose batch this is; the inner one has its own
        self.spark.sparkContext.clearJobTags()
        shuffles = self.spark.conf.get("spark.sql.shuffle.partitions")
        try:
            self.spark.conf.set("spark.sql.shuffle.partitions", str(self._state_partitions()))
            try:
                q = q.start()  # with a session of its own, which has the settings of now
            finally:
                self.spark.conf.set("spark.sql.shuffle.partitions", shuffles)
            q.awaitTermination()
        finally:
            for tag in tags:
                self.spark.sparkContext.addJobTag(tag)

    def add(self, rows: DataFrame, number: int) -> int:
        """Archive the rows (one per key) whose key is new; their number."""
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
        if not _has_entries(self.spark, self.state) and _has_entries(self.spark, self.path):
            known = self.spark.read.format(self.fmt).load(self.path).select(*self.keys).distinct()
            self._stage(known.select(*[F.col(f.name).cast(f.dataType) if f.name in self.keys else F.lit(None).cast(f.dataType).alias(f.name)
                                       for f in self.schema.fields]), -1, True)
            self._drain()
        if self._open_batch() is not None:
            self._drain()  # of the rows it was begun with, before any are staged anew
        self.new = 0
        self._stage(rows, number, False)
        self._drain()
        return self.new


def touched_days(spark: SparkSession, archive_path: str, done: str) -> DataFrame:
    """(entry, year, month, day, rows) of the ledger entries that are not in ``done`` yet."""
    if not _has_entries(spark, f"{archive_path}_days"):
        return spark.createDataFrame([], "entry string, year string, month string, day string, rows long")
    ledger = spark.read.parquet(f"{archive_path}_days").select("entry", "year", "month", "day", "rows")
    if not _has_entries(spark, done):
        return ledger
    return ledger.join(spark.read.parquet(done).select("entry"), "entry", "left_anti")


def archive_batch_writer(spark: SparkSession, archive_path: str, keys, ts: str, order=None,
                         keywords: DataFrame | None = None, text_col: str | None = None, fmt: str = "parquet",
                         partition_by=ARCHIVE_PARTS, token_masks: tuple[str, str] | None = None, counts: dict | None = None,
                         observe: str | None = None):
    """Build the foreachBatch function for D1+D2 (+ optional phrase filter).

    Rows are appended under their own event day (``partition_by``; the zero
    padded ``hour`` is kept as a column, or pass the four parts for hourly
    folders) by a :class:`KeyedArchive`; ``<archive>_rejected`` gets rows with a
    null key (malformed lines have one), in a folder per batch.

    A batch run again stages its rows anew; their keys are in the state by
    then, so nothing is lost or repeated.  ``counts``, if given, is filled with
    (read, rejected, repeated, new) summed over the batches.
    """
    keys, order = list(keys), list(order or [ts])
    reject_path = f"{archive_path}_rejected"
    archive = KeyedArchive(spark, archive_path, keys, ts, fmt, partition_by, observe)

    def process(batch: DataFrame, epoch_id: int) -> None:
        b = batch.persist()
        try:
            no_key = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
            total, rejected = b.agg(F.count(F.lit(1)), F.coalesce(F.sum(no_key.cast("int")), F.lit(0))).first()
            if rejected:
                (b.where(no_key).withColumn("batch", F.lit(epoch_id)).write.mode("overwrite")
                 .option("partitionOverwriteMode", "dynamic").partitionBy("batch").format(fmt).save(reject_path))
            rows = b.where(~no_key)
            if keywords is not None:
                rows = rows.join(texts_matching_any(rows, keywords, text_col, carry=keys, token_masks=token_masks), keys, "left_semi")
            if token_masks:
                rows = rows.drop(*token_masks)  # matching inputs only, not archived
            rows = first_per_key(rows, keys, order)
            n = archive.add(rows.drop(*[c for c in ARRIVAL_COLS if c in rows.columns]), epoch_id)
            if counts is not None:
                for name, k in (("read", total), ("rejected", rejected), ("new", n), ("repeated", total - rejected - n)):
                    counts[name] = counts.get(name, 0) + k
        finally:
            b.unpersist()

    return process


ARRIVAL_COLS = ("_arrival", "_arrival_file")


def with_arrival(stream: DataFrame) -> DataFrame:
    """Arrival order of a file source: the landed file's modification time
    and path (Spark's hidden ``_metadata`` column of file sources)."""
    return stream.select("*", F.col("_metadata.file_modification_time").alias("_arrival"),
                         F.col("_metadata.file_path").alias("_arrival_file"))


def start_ingest(spark: SparkSession, stream: DataFrame, archive_path: str, checkpoint: str, *,
                 keys=("id",), ts: str = "event_time", order=None, keywords=None,
                 text_col=None, drop=NON_PORTABLE_FIELDS,
                 trigger: dict | None = None, partition_by=ARCHIVE_PARTS,
                 token_masks: tuple[str, str] | None = None,
                 arrival_order: bool = False, counts: dict | None = None, observe: str | None = None) -> StreamingQuery:
    """Start the ingest query; returns the running StreamingQuery.

    ``trigger`` defaults to ``{"availableNow": True}`` (bounded sessions: the
    reference stopped after 100 posts or 60 s; use ``maxFilesPerTrigger`` on
    the source to bound a batch).  ``arrival_order=True`` (file sources)
    makes the first *arrived* copy of a key win inside a batch, ordering by
    file modification time, then file path, then event time; the helper
    columns are not archived.  ``observe`` names counters of the running
    queries (A9): rows read and rejected, and under ``<observe>_new`` the
    rows archived; a :class:`trendspark.streaming.counters.Counters` adds them up.
    """
    s = drop_fields(stream, drop)
    if observe:
        no_key = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
        s = s.observe(observe, F.count(F.lit(1)).alias("read"), F.sum(no_key.cast("long")).alias("rejected"))
    if arrival_order:
        s = with_arrival(s)
        order = [*ARRIVAL_COLS, *(order or [ts])]
    if keywords is not None:  # normalised once, not in every batch
        keywords = track_phrases(keywords).persist()
    fn = archive_batch_writer(spark, archive_path, keys, ts, order, keywords, text_col,
                              partition_by=partition_by, token_masks=token_masks, counts=counts, observe=observe)
    w = s.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()
