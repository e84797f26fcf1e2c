"""Streaming ingest (FIXTURES §3.7): replay is idempotent, first payload
wins, late rows land in their own event hour, hourly windows close."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.streaming import ingest

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("title", T.StringType()),
                       T.StructField("created_utc", T.DoubleType())])


def land(dirpath, name, recs):
    dirpath.mkdir(parents=True, exist_ok=True)
    (dirpath / name).write_text("\n".join(json.dumps(r) for r in recs) + "\n")


def stream(spark, path):
    s = ingest.file_stream(spark, str(path), SCHEMA, fmt="json", max_files_per_trigger=1)
    return s.withColumn("event_time", F.timestamp_seconds("created_utc"))


def test_replay_first_wins_and_late_rows(spark, tmp_path):
    inbox, archive = tmp_path / "in", str(tmp_path / "archive")
    land(inbox, "a.json", [{"id": "p1", "title": "first", "created_utc": 1733659200.0},
                           {"id": "p2", "title": "x", "created_utc": 1733659300.0},
                           {"id": "p2", "title": "x-later", "created_utc": 1733659400.0}])
    q = ingest.start_ingest(spark, stream(spark, inbox), archive, str(tmp_path / "ck1"), keys=("id",))
    q.awaitTermination()
    # same post again with another payload, plus a late post for hour 12
    land(inbox, "b.json", [{"id": "p1", "title": "second", "created_utc": 1733659200.0},
                           {"id": "p3", "title": "late", "created_utc": 1733660000.0}])
    for ck in ("ck2", "ck3"):  # fresh checkpoints: whole inbox replayed twice
        q = ingest.start_ingest(spark, stream(spark, inbox), archive, str(tmp_path / ck), keys=("id",))
        q.awaitTermination()
    back = spark.read.parquet(archive)
    got = {r.id: (r.title, int(r.hour)) for r in back.collect()}
    assert back.count() == 3
    assert got == {"p1": ("first", 12), "p2": ("x", 12), "p3": ("late", 12)}


def test_phrase_filter_in_stream(spark, tmp_path):
    inbox, archive = tmp_path / "in", str(tmp_path / "archive")
    land(inbox, "a.json", [{"id": "p1", "title": "Wicked!", "created_utc": 1733659200.0},
                           {"id": "p2", "title": "nothing here", "created_utc": 1733659200.0}])
    kws = spark.createDataFrame([("wicked",)], "keyword string")
    s = stream(spark, inbox).withColumn("st", F.regexp_replace(F.lower("title"), "[^a-z0-9]+", ""))
    q = ingest.start_ingest(spark, s, archive, str(tmp_path / "ck"), keys=("id",), keywords=kws, text_col="st")
    q.awaitTermination()
    assert [r.id for r in spark.read.parquet(archive).collect()] == ["p1"]


def test_hourly_windows_close_with_watermark(spark, tmp_path):
    inbox = tmp_path / "in"
    recs = [{"id": str(i), "title": "t", "created_utc": 1733659200.0 + i * 900} for i in range(20)]
    land(inbox, "a.json", recs)
    h = ingest.hourly_counts(stream(spark, inbox), "event_time", "1 hour")
    out = str(tmp_path / "out")
    q = (h.writeStream.outputMode("append").format("parquet").option("path", out)
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r.window_start.hour, r.n) for r in spark.read.parquet(out).collect())
    # 20 posts every 15 min from 12:00 → hours 12..16; watermark = 16:45 - 1h = 15:45
    assert got == [(12, 4), (13, 4), (14, 4)]


def test_dedup_within_watermark(spark, tmp_path):
    inbox = tmp_path / "in"
    land(inbox, "a.json", [{"id": "p1", "title": "a", "created_utc": 1733659200.0}])
    land(inbox, "b.json", [{"id": "p1", "title": "a", "created_utc": 1733659200.0},
                           {"id": "p2", "title": "b", "created_utc": 1733659260.0}])
    d = ingest.dedup_within_watermark(stream(spark, inbox), ["id"], "event_time", "1 hour")
    out = str(tmp_path / "out")
    q = (d.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["p1", "p2"]


def test_new_rows_only(spark):
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "id string, v int")
    archive = spark.createDataFrame([("b", 9), ("b", 9), ("z", 0)], "id string, v int")
    assert sorted(tuple(r) for r in ingest.new_rows_only(batch, archive, ["id"]).collect()) == [("a", 1), ("c", 3)]
    assert ingest.new_rows_only(batch, None, ["id"]).count() == 3


def test_first_per_key_ties_are_deterministic(spark):
    df = spark.createDataFrame([("k", 1, "b"), ("k", 1, "a"), ("k", 2, "0"), ("j", 5, "z")],
                               "id string, ts int, payload string")
    for _ in range(3):
        got = {r.id: (r.ts, r.payload) for r in ingest.first_per_key(df.repartition(3), ["id"], ["ts"]).collect()}
        assert got == {"k": (1, "a"), "j": (5, "z")}


def test_phrase_filter_whole_tokens_in_stream(spark, tmp_path):
    from trendspark.functions import simple_text, token_end_mask, token_start_mask
    inbox, archive = tmp_path / "in", str(tmp_path / "archive")
    land(inbox, "a.json", [{"id": "p1", "title": "Where to watch", "created_utc": 1733659200.0},
                           {"id": "p2", "title": "here we go", "created_utc": 1733659200.0}])
    kws = spark.createDataFrame([("here",)], "keyword string")
    s = stream(spark, inbox).select("*", simple_text("title").alias("st"), token_start_mask("title").alias("sm"),
                                    token_end_mask("title").alias("em"))
    q = ingest.start_ingest(spark, s, archive, str(tmp_path / "ck"), keys=("id",), keywords=kws, text_col="st",
                            token_masks=("sm", "em"))
    q.awaitTermination()
    assert [r.id for r in spark.read.parquet(archive).collect()] == ["p2"]


def test_masks_are_not_archived(spark, tmp_path):
    from trendspark.functions import simple_text, token_end_mask, token_start_mask
    inbox, archive = tmp_path / "in", str(tmp_path / "archive")
    land(inbox, "a.json", [{"id": "p2", "title": "here we go", "created_utc": 1733659200.0}])
    kws = spark.createDataFrame([("here",)], "keyword string")
    s = stream(spark, inbox).select("*", simple_text("title").alias("st"), token_start_mask("title").alias("sm"),
                                    token_end_mask("title").alias("em"))
    ingest.start_ingest(spark, s, archive, str(tmp_path / "ck"), keys=("id",), keywords=kws, text_col="st",
                        token_masks=("sm", "em")).awaitTermination()
    cols = spark.read.parquet(archive).columns
    assert "sm" not in cols and "em" not in cols and "st" in cols


def test_retried_batch_is_harmless(spark, tmp_path):
    """A micro-batch replayed after a failure (same epoch) adds nothing."""
    archive = str(tmp_path / "archive")
    fn = ingest.archive_batch_writer(spark, archive, ["id"], "event_time")
    batch = spark.createDataFrame([("p1", "a"), ("p2", "b"), ("p1", "c")], "id string, title string") \
        .withColumn("event_time", F.lit("2024-12-08 12:00:00").cast("timestamp"))
    fn(batch, 0)
    fn(batch, 0)  # retry of the same epoch
    back = spark.read.parquet(archive)
    assert sorted(r.id for r in back.collect()) == ["p1", "p2"]
    assert {r.id: r.title for r in back.collect()}["p1"] == "a"  # first by order, ties by value


def test_old_keys_late_rows_and_null_keys(spark, tmp_path):
    """A key archived long ago is known, late rows are kept, rows without a key are rejected and counted."""
    archive, counts = str(tmp_path / "archive"), {}
    fn = ingest.archive_batch_writer(spark, archive, ["id"], "event_time", counts=counts)

    def batch(rows):
        return spark.createDataFrame(rows, "id string, t string").withColumn("event_time", F.col("t").cast("timestamp")).drop("t")

    fn(batch([("old", "2024-12-01 10:00:00"), ("recent", "2024-12-07 10:00:00"), (None, "2024-12-07 10:00:00")]), 0)
    second = batch([("old", "2024-12-08 09:00:00"), ("recent", "2024-12-08 09:00:00"), ("late", "2024-11-02 09:00:00"),
                    (None, None), (None, None)])
    for _ in range(2):
        fn(second, 1)
    assert sorted((r.id, r.day) for r in spark.read.parquet(archive).collect()) == [("late", 2), ("old", 1), ("recent", 7)]
    assert spark.read.parquet(archive + "_rejected").count() == 3
    assert counts == {"read": 3 + 5 + 5, "rejected": 1 + 2 + 2, "new": 3, "repeated": 2 + 3}


def _late_batch(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, t string").withColumn("event_time", F.col("t").cast("timestamp")).drop("t")


def test_stop_between_state_and_rows_loses_nothing(spark, tmp_path, monkeypatch):
    """The write to the archive fails once, before or after the rows: the try again neither loses nor repeats one."""
    for after in (False, True):
        archive = str(tmp_path / f"archive{after}")
        fn = ingest.archive_batch_writer(spark, archive, ["id"], "event_time")
        fn(_late_batch(spark, ("p0", "2024-12-08 12:00:00")), 0)
        rows = _late_batch(spark, ("p1", "2024-12-08 12:00:00"), ("p2", "2024-12-09 12:00:00"))
        real = ingest.KeyedArchive._drain

        def broken(self):
            parts, self.parts = self.parts, self.parts if after else ["no such column"]
            ledger, self.ledger = self.ledger, f"{self.ledger}-lost" if after else self.ledger
            unpersist = type(rows).unpersist
            if after:
                monkeypatch.setattr(type(rows), "unpersist", lambda df, *a: (unpersist(df, *a), 1 / 0)[0])
            try:
                real(self)
            finally:
                self.parts, self.ledger = parts, ledger
                monkeypatch.setattr(type(rows), "unpersist", unpersist)

        monkeypatch.setattr(ingest.KeyedArchive, "_drain", broken)
        try:
            fn(rows, 1)
            raise AssertionError("did not fail")
        except AssertionError:
            raise
        except Exception:
            pass
        monkeypatch.setattr(ingest.KeyedArchive, "_drain", real)
        fn = ingest.archive_batch_writer(spark, archive, ["id"], "event_time")
        fn(rows, 1)
        fn(rows, 1)
        assert sorted(r.id for r in spark.read.parquet(archive).collect()) == ["p0", "p1", "p2"]


def test_state_is_filled_from_the_archive(spark, tmp_path):
    """An archive without its state (lost, or written by another tool): its keys are known all the same."""
    import shutil
    archive = str(tmp_path / "archive")
    fn = ingest.archive_batch_writer(spark, archive, ["id"], "event_time")
    fn(_late_batch(spark, ("p1", "2024-12-08 12:00:00"), ("p2", "2024-12-09 12:00:00")), 0)
    shutil.rmtree(archive + "_state")
    fn = ingest.archive_batch_writer(spark, archive, ["id"], "event_time")
    fn(_late_batch(spark, ("p1", "2024-12-10 12:00:00"), ("p3", "2024-12-08 12:00:00")), 0)
    assert sorted((r.id, r.day) for r in spark.read.parquet(archive).collect()) == [("p1", 8), ("p2", 9), ("p3", 8)]


def test_late_small_batch_reads_its_own_rows_only(spark, tmp_path, monkeypatch):
    """After many batches a small one reads neither the archive nor other keys, and staged rows are gone."""
    archive = str(tmp_path / "archive")
    fn = ingest.archive_batch_writer(spark, archive, ["id"], "event_time")
    for i in range(4):
        fn(_late_batch(spark, *[(f"{i}-{j}", f"2024-12-0{i + 1} 12:00:00") for j in range(50)]), i)
    read = []
    loads = type(spark.read).load
    monkeypatch.setattr(type(spark.read), "load", lambda self, path=None, *a, **k: (read.append(path), loads(self, path, *a, **k))[1])
    fn(_late_batch(spark, ("0-0", "2024-12-05 12:00:00"), ("new", "2024-11-30 12:00:00")), 4)
    assert read == []  # no table is read, only the staged stream
    staged = [p for p in (tmp_path / "archive_state" / "staged").rglob("*.parquet")]
    rows = sum(spark.read.parquet(str(p)).count() for p in staged)
    assert rows <= 52  # of 202: those of earlier batches were deleted once read
    assert spark.read.parquet(archive).count() == 201


def test_ledger_names_touched_days(spark, tmp_path):
    archive, done = str(tmp_path / "archive"), str(tmp_path / "done")
    fn = ingest.archive_batch_writer(spark, archive, ["id"], "event_time")
    assert ingest.touched_days(spark, archive, done).collect() == []
    fn(_late_batch(spark, ("a", "2024-12-08 12:00:00"), ("b", "2024-12-08 13:00:00"), ("c", "2024-12-09 12:00:00")), 0)
    got = ingest.touched_days(spark, archive, done)
    assert sorted((r.year, r.month, r.day, r.rows) for r in got.collect()) == [("2024", "12", "08", 2), ("2024", "12", "09", 1)]
    got.select("entry").write.parquet(done)
    fn(_late_batch(spark, ("a", "2024-12-08 12:00:00"), ("d", "2024-12-09 23:00:00")), 1)
    assert [(r.day, r.rows) for r in ingest.touched_days(spark, archive, done).collect()] == [("09", 1)]


def test_arrival_order_first_copy_wins(spark, tmp_path):
    """The first-arrived copy sorts last by value, so only arrival order picks it."""
    import os
    inbox = tmp_path / "in"
    land(inbox, "a.json", [{"id": "p1", "title": "zz arrived first", "created_utc": 1733659200.0}])
    land(inbox, "b.json", [{"id": "p1", "title": "aa arrived later", "created_utc": 1733659200.0}])
    os.utime(inbox / "a.json", (1_000_000_000, 1_000_000_000))
    os.utime(inbox / "b.json", (1_000_000_100, 1_000_000_100))

    def run(archive, ck, **kw):
        s = ingest.file_stream(spark, str(inbox), SCHEMA, fmt="json") \
            .withColumn("event_time", F.timestamp_seconds("created_utc"))
        ingest.start_ingest(spark, s, archive, ck, keys=("id",), **kw).awaitTermination()
        return spark.read.parquet(archive)

    by_arrival = run(str(tmp_path / "a1"), str(tmp_path / "c1"), arrival_order=True)
    assert [r.title for r in by_arrival.collect()] == ["zz arrived first"]
    assert "_arrival" not in by_arrival.columns and "_arrival_file" not in by_arrival.columns
    by_value = run(str(tmp_path / "a2"), str(tmp_path / "c2"))
    assert [r.title for r in by_value.collect()] == ["aa arrived later"]  # deterministic tie-break only


def test_keyed_state_goes_with_the_cores_not_the_shuffles(spark, tmp_path):
    inbox, archive = tmp_path / "in", str(tmp_path / "archive")
    land(inbox, "a.json", [{"id": f"p{i}", "title": "t", "created_utc": 1733659200.0} for i in range(50)])
    cores, before = spark.sparkContext.defaultParallelism, spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(2 * cores + 7))
    try:
        ingest.start_ingest(spark, stream(spark, inbox), archive, str(tmp_path / "ck"), keys=("id",)).awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(2 * cores + 7)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    stores = [p for p in (tmp_path / "archive_state" / "keys" / "state" / "0").iterdir() if p.name.isdigit()]
    assert len(stores) == 2 * cores
    assert spark.read.parquet(archive).select("id").distinct().count() == 50
