"""Closed-hour landing, bounded sessions, observed counters, late days and loads."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from trendspark.plans import jobs
from trendspark.sources import readers, sinks
from trendspark.streaming import counters, hours, ingest, sessions


def stamps(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, t string").withColumn("ts", F.col("t").cast("timestamp")).drop("t")


def files(root):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in Path(root).rglob("part-*")}


def test_closed_hours_are_written_once(spark, tmp_path):
    out = str(tmp_path / "hours")
    h = hours.HourLanding(spark, out, "ts", 1800, "json")
    first = stamps(spark, ("a", "2024-12-08 10:10:00"), ("b", "2024-12-08 11:50:00"), ("n", None))
    h.process(first, 0)  # watermark 11:20: hour 10 is closed
    assert sorted(p.split("/part")[0] for p in files(out)) == ["year=2024/month=12/day=08/hour=10"]
    before = files(out)
    second = stamps(spark, ("c", "2024-12-08 10:59:00"), ("d", "2024-12-08 11:01:00"), ("e", "2024-12-08 13:00:00"))
    for _ in range(2):  # a batch run again leaves the same files
        h.process(second, 1)  # c is late; watermark 12:30: hour 11 is closed
    assert {k: v for k, v in files(out).items() if "hour=10" in k} == before
    schema = first.schema
    got = {r.id: r.late for r in hours.read_landed_hours(spark, out, schema).collect()}
    assert got == {"a": False, "b": False, "c": True, "d": False, "n": True}
    h.finish()
    h.process(stamps(spark, ("f", "2024-12-08 13:59:00")), 2)  # its hour was closed by the end
    got = [(r.id, r.late) for r in hours.read_landed_hours(spark, out, schema).collect()]
    assert sorted(got) == [("a", False), ("b", False), ("c", True), ("d", False), ("e", False), ("f", True), ("n", True)]


def land(spark, root, name, rows, when):
    df = spark.createDataFrame(rows, "id int, channel string").coalesce(1)
    df.write.parquet(f"{root}/{name}")
    for p in Path(root, name).glob("part-*"):
        os.utime(p, (when, when))


def test_sessions_keep_their_caps_and_take_every_row_once(spark, tmp_path):
    root, offsets, out = (str(tmp_path / n) for n in ("in", "offsets", "out"))
    land(spark, root, "a", [(i, "x") for i in range(7)] + [(100, None), (101, None), (200, "y")], 1_700_000_000)
    land(spark, root, "b", [(i, "x") for i in range(7, 9)] + [(201, "y")], 1_700_000_030)
    land(spark, root, "c", [(202, "y")], 1_700_000_100)  # 100 s after the first: another session
    assert sessions.run_sessions(spark, root, offsets, out, posts=3, seconds=60) == 3
    taken = spark.read.parquet(out)
    assert taken.groupBy("session", "channel").count().agg(F.max("count")).first()[0] == 3
    got = {(r.session, r.channel): sorted(r.ids) for r in taken.groupBy("session", "channel").agg(F.collect_list("id").alias("ids")).collect()}
    assert got == {(1, "x"): [0, 1, 2], (2, "x"): [3, 4, 5], (3, "x"): [6, 7, 8], (1, None): [100, 101], (1, "y"): [200, 201], (2, "y"): [202]}
    land(spark, root, "d", [(300, "new"), (301, "x")], 1_700_000_500)
    assert sessions.run_session(spark, root, offsets, out) == 2
    assert sessions.run_session(spark, root, offsets, out) == 0
    ids = [r.id for r in spark.read.parquet(out).collect()]
    assert sorted(ids) == sorted([*range(9), 100, 101, 200, 201, 202, 300, 301])


def test_session_that_stopped_before_its_offsets_is_run_again(spark, tmp_path, monkeypatch):
    root, offsets, out = (str(tmp_path / n) for n in ("in", "offsets", "out"))
    land(spark, root, "a", [(i, "x") for i in range(5)], 1_700_000_000)
    sessions.run_session(spark, root, offsets, out, posts=2)
    real = sessions._has_entries
    monkeypatch.setattr(sessions, "_has_entries", lambda s, p: False if p == out else real(s, p))
    assert sessions.run_session(spark, root, offsets, out, posts=2) == 0  # stops behind the rows
    monkeypatch.setattr(sessions, "_has_entries", real)
    assert sessions.run_sessions(spark, root, offsets, out, posts=2) == 2
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 4]


def test_counters_add_up_over_batches(spark, tmp_path):
    root = str(tmp_path / "in")
    for i in range(3):
        land(spark, root, f"f{i}", [(i, "x"), (0, "y"), (None, "z")], 1_700_000_000 + i)
    s = spark.readStream.schema("id int, channel string").option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(root)
    s = s.withColumn("event_time", F.lit("2024-01-01").cast("timestamp"))
    with counters.Counters(spark) as c:
        ingest.start_ingest(spark, s, str(tmp_path / "archive"), str(tmp_path / "ckpt"), keys=("id",), observe="posts").awaitTermination()
    assert {(r.name, r.counter): r.value for r in c.table().collect()} == {("posts", "read"): 9, ("posts", "rejected"): 3, ("posts_new", "rows"): 3}


def test_refresh_touches_only_the_late_days(spark, tmp_path):
    archive, items, fact = (str(tmp_path / n) for n in ("archive", "items", "fact"))
    (tmp_path / "items").mkdir()
    (tmp_path / "items" / "i.csv").write_text("id,title,title_simple\n1,Wicked,wicked\n")

    def batch(*rows):
        return spark.createDataFrame([(i, t, float(u)) for i, t, u in rows], "id string, title string, created_utc double") \
            .withColumn("subreddit_name_prefixed", F.lit("r/films")).withColumn("event_time", F.timestamp_seconds("created_utc"))

    fn = ingest.archive_batch_writer(spark, archive, ["id"], "event_time")
    day = 1733616000  # 2024-12-08
    fn(batch(("a", "wicked", day + 10), ("b", "wicked", day + 86400 + 10)), 0)
    assert jobs.refresh_mention_fact(spark, archive, items, fact) == ["2024-12-08", "2024-12-09"]
    before = files(fact)
    fn(batch(("c", "so wicked", day + 20), ("a", "again", day + 86400 * 3)), 1)  # a late post, and one known already
    assert jobs.refresh_mention_fact(spark, archive, items, fact) == ["2024-12-08"]
    after = files(fact)
    assert {k: v for k, v in after.items() if "day=9" in k} == {k: v for k, v in before.items() if "day=9" in k} != {}
    got = {str(r.date): r.mention_count for r in readers.read_fact_range(spark, fact, "2024-12-01", "2024-12-31").collect()}
    assert got == {"2024-12-08": 2, "2024-12-09": 1}
    assert jobs.refresh_mention_fact(spark, archive, items, fact) == []


def test_a_load_that_stopped_is_never_read(spark, tmp_path):
    root = str(tmp_path / "dims")
    tables = {n: spark.createDataFrame([(n, 1)], "name string, v int") for n in ("genres", "mov", "date")}
    with pytest.raises(Exception):
        readers.read_load(spark, root, tables)
    sinks.write_load(tables, root, "20240101")
    newer = {n: spark.createDataFrame([(n, 2)], "name string, v int") for n in tables}
    for name in ("genres", "mov"):
        sinks.write_dimension(newer[name], f"{root}/{name}", "20240201")
    assert {n: df.first().v for n, df in readers.read_load(spark, root, tuple(tables)).items()} == {"genres": 1, "mov": 1, "date": 1}
    with pytest.raises(ValueError):
        readers.read_load(spark, root, tuple(tables), "20240201")
    sinks.write_load(newer, root, "20240201")
    got = readers.read_load(spark, root, tuple(tables))
    assert {n: df.first().v for n, df in got.items()} == {"genres": 2, "mov": 2, "date": 2}
    assert all("dataload=20240201" in p for df in got.values() for p in df.inputFiles())
    marks = spark.read.parquet(f"{root}/loads")
    assert sorted((r.load, r.table, r.rows) for r in marks.collect())[:3] == [("20240101", n, 1) for n in sorted(tables)]


def test_landing_tally_is_of_this_landing(spark, tmp_path):
    """The default stamp, on a second day: items of the day before do not count as covered."""
    items = spark.createDataFrame([(1,), (2,), (3,)], "item_id long")
    rows = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (2, None), (3, None)], "id long, query_datetime string")
    out = str(tmp_path / "landed")
    assert jobs.land_metrics(spark, rows, out, items, "2024-01-01 00:00:00").first()["covered"] == 3
    today = rows.where("id = 1").withColumn("query_datetime", F.lit(None).cast("string"))
    assert tuple(jobs.land_metrics(spark, today, out, items).first()) == (3, 1, 2)


def test_only_the_days_asked_for_are_listed(spark, tmp_path):
    root = str(tmp_path / "fact")
    days = spark.sql("select explode(sequence(date'2023-12-30', date'2024-02-03')) as date").withColumn("v", F.lit(1))
    sinks.write_fact(days, root)
    got = readers.read_fact_range(spark, root, "2023-12-31", "2024-01-02")
    assert sorted(str(r.date) for r in got.collect()) == ["2023-12-31", "2024-01-01", "2024-01-02"]
    assert len(got.inputFiles()) == 3  # of 36
    assert got.columns == ["date", "v", "year", "month", "day"]
    assert readers.read_fact_range(spark, root, "2030-01-01", "2030-01-02").count() == 0


def test_staged_raw_rows_keep_unknown_fields(spark):
    lines = spark.createDataFrame([('{"id": "a", "created_utc": 1733659200.5, "author": {"n": 1}, "odd": {"x": [1, 2]}}',), ("{broken",), (None,),
                                   ("[1]",), ('{"id": 7}',)], "value string")
    got = ingest.stage_raw(lines).select("id_str", "post_datetime", F.to_json("raw").alias("raw"), "bad").collect()
    assert [tuple(r) for r in got[:1]] == [("a", "2024-12-08 12:00:00", '{"created_utc":1733659200.5,"id":"a","odd":{"x":[1,2]}}', 0)]
    assert [tuple(r) for r in got[1:4]] == [(None, None, None, 1)] * 3 and tuple(got[4]) == ("7", None, '{"id":7}', 0)


def test_companies_merged_in_any_order_equal_one_pass(spark):
    from trendspark.operators import dims
    kind = "id long, production_companies array<struct<id: long, name: string, origin_country: string>>"
    days = {"2024-01-01": [(5, [(1, "x", "US"), (2, "y", None)])], "2024-01-02": [(1, [(1, "x", "FR"), (2, "y", "DE")])],
            "2024-01-03": [(9, [(3, "z", "IT"), (3, "z", "ES")]), (8, None)]}
    want = {(1, "x", "US"), (2, "y", None), (3, "z", "IT")}
    for order in (sorted(days), sorted(days, reverse=True), ["2024-01-02", "2024-01-03", "2024-01-01", "2024-01-02"]):
        stored = None
        for day in order:
            stored = dims.merge_companies(stored, spark.createDataFrame(days[day], kind), day)
        assert {(r.id, r.name, r.origin_country) for r in stored.collect()} == want


def test_a_selected_name_reads_one_folder(spark, tmp_path):
    from trendspark.operators import trends
    view = spark.sql("select concat('n', id % 20) as name, date_add(date'2024-01-01', cast(id % 30 as int)) as date, id as v from range(600)")
    out = str(tmp_path / "slices")
    sinks.write_slices(trends.running_totals(view, "v"), out, buckets=8)
    for start, end in (("2024-01-05", "2024-01-10"), ("2023-01-01", "2024-01-01"), ("2024-01-30", "2025-01-01"), ("2020-01-01", "2020-02-01")):
        want = {r.name: r.t for r in view.where(f"date <= '{end}'").groupBy("name").agg(F.sum(F.expr(f"if(date >= '{start}', v, 0)")).alias("t")).collect()}
        assert {r.name: r.total for r in trends.range_totals(readers.read_slice(spark, out), start, end).collect()} == want
    one = readers.read_slice(spark, out, "n7", buckets=8)
    assert {r.name for r in one.collect()} == {"n7"}
    plan = one._jdf.queryExecution().executedPlan()
    plan.execute().count()
    scan = [str(x) for x in plan.toString().split("\n") if "PartitionFilters" in x][0]
    assert "bucket" in scan.split("PartitionFilters")[1].split("]")[0]
