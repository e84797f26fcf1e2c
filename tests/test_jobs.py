"""Mention fact job (FIXTURES §3.1), metric fact, sinks (§3.7) and dims (§3.5)."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tests.conftest import rows
from trendspark import schemas
from trendspark.operators import dims, facts
from trendspark.plans import jobs
from trendspark.sources import readers, sinks

ITEMS_CSV = "id,title,title_simple\n1,Wicked,wicked\n2,Moana,moana\n3,Moana 2,moana\n4,Here,here\n" \
            "5,Unseen Film,unseenfilm\n6,Blank,\n"
POSTS = [
    {"id": "p1", "subreddit_name_prefixed": "r/movies", "title": "Wicked!", "selftext": "", "created_utc": 1733659200.0},
    {"id": "p2", "subreddit_name_prefixed": "r/TrueFilm", "title": "On Moana", "selftext": "and WICKED",
     "created_utc": 1733659200.5},
    {"id": "p3", "subreddit_name_prefixed": "r/movies", "title": None, "selftext": "Where to watch",
     "created_utc": 1733659200.0},
    {"id": "p4", "subreddit_name_prefixed": "r/movies", "title": "wicked", "selftext": None,
     "created_utc": 1733745600.0},
    {"id": "p5", "subreddit_name_prefixed": "r/movies", "title": "", "selftext": None, "created_utc": 1733659200.0},
]
EXPECTED = [(1, 2, "movies", 1), (1, 2, "truefilm", 1), (2, 1, "truefilm", 1), (3, 1, "truefilm", 1),
            (4, 1, "movies", 1), (5, 0, None, 0), (6, 0, None, 0)]


def write_inputs(tmp_path, posts=POSTS, bad_line=False):
    items = tmp_path / "items.csv"
    items.write_text(ITEMS_CSV)
    landing = tmp_path / "posts" / "2024" / "12" / "08" / "12"
    landing.mkdir(parents=True)
    lines = [json.dumps(p) for p in posts] + (["{not json"] if bad_line else [])
    (landing / "2024-12-08-12.json").write_text("\n".join(lines) + "\n")
    return str(tmp_path / "posts"), str(items)


def test_mention_fact_fixture(spark, tmp_path):
    posts, items = write_inputs(tmp_path)
    df = jobs.mention_fact(spark, posts, items, "2024-12-08")
    assert rows(df, "item_id", "text_count", "channel", "mention_count") == sorted(
        EXPECTED, key=lambda t: tuple((x is not None, x) for x in t))
    assert {r.date for r in df.select("date").distinct().collect()} == {dt.date(2024, 12, 8)}
    # listing only the day folders gives the same rows
    df2 = jobs.mention_fact(spark, posts, items, "2024-12-08", day_folders=True)
    assert rows(df2, "item_id", "text_count", "channel", "mention_count") == rows(
        df, "item_id", "text_count", "channel", "mention_count")


def test_mention_fact_range_and_two_aggregates(spark, tmp_path):
    posts, items = write_inputs(tmp_path)
    df = jobs.mention_fact(spark, posts, items, start="2024-12-08", end="2024-12-09")
    day9 = rows(df.where("date = '2024-12-09'"), "item_id", "text_count", "channel", "mention_count")
    assert (1, 1, "movies", 1) in day9 and (2, 0, None, 0) in day9
    p = readers.normalise_posts(readers.read_posts(spark, posts)).where("date = '2024-12-08'")
    items_df = readers.read_items(spark, items)
    a = facts.mention_stats(p, items_df)
    b = facts.mention_stats_two_aggregates(p, items_df)
    assert rows(a) == rows(b.select(*a.columns))


def test_corrupt_line_is_counted(spark, tmp_path):
    posts, _ = write_inputs(tmp_path, bad_line=True)
    raw = readers.read_posts(spark, posts).cache()
    assert raw.where(F.col("_corrupt_record").isNotNull()).count() == 1
    assert raw.where(F.col("id").isNotNull()).count() == 5


def test_dynamic_overwrite_and_range_read(spark, tmp_path):
    out = str(tmp_path / "fact")
    days = spark.createDataFrame([(1, dt.date(2024, 12, 8), 1.0), (2, dt.date(2024, 12, 9), 2.0)],
                                 "id long, date date, popularity double")
    sinks.write_fact(days, out)
    sinks.write_fact(days.where("id = 1").withColumn("popularity", F.lit(9.0)), out)  # rerun day 8
    back = readers.read_fact_range(spark, out, "2024-12-07", "2024-12-10")
    assert rows(back, "id", "popularity") == [(1, 9.0), (2, 2.0)]
    empty = readers.read_fact_range(spark, out, "2024-01-01", "2024-01-02")
    assert empty.count() == 0 and "popularity" in empty.columns
    missing = readers.read_fact_range(spark, str(tmp_path / "nope"), "2024-01-01", "2024-01-02",
                                      schemas.METRIC_FACT)
    assert missing.count() == 0 and missing.schema == schemas.METRIC_FACT
    plan = back._jdf.queryExecution().executedPlan().toString()
    import re
    pf = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert pf and "make_date" in pf[0]  # the range prunes on year/month/day


def test_metric_fact_job(spark, tmp_path):
    land = tmp_path / "metrics_landing" / "2024" / "12" / "18"
    land.mkdir(parents=True)
    recs = [{"id": 1, "popularity": 10.5, "vote_average": 7.0, "vote_count": 3,
             "query_datetime": "2024-12-18 01:00:00", "genres": [{"id": 18, "name": "Drama"}]},
            {"id": 2, "popularity": 1.5, "vote_average": 6.0, "vote_count": 9,
             "query_datetime": "2024-12-17 01:00:00"}]
    (land / "2024-12-18.json").write_text("\n".join(json.dumps(r) for r in recs))
    out = str(tmp_path / "metric")
    jobs.run_metric_fact(spark, str(tmp_path / "metrics_landing"), out, "2024-12-18")
    back = spark.read.parquet(out)
    assert rows(back, "id", "popularity", "year", "month", "day") == [(1, 10.5, 2024, 12, 18)]


def test_dimensions(spark):
    snap = spark.createDataFrame(
        [(0, "A", "A0", "en", [(18, "Drama")], [(7, "X", "US"), (9, "Y", None), (5, "A", "FR")]),
         (1, "B", "B0", "fr", None, [(5, "A", "US"), (5, "B", "GB")])],
        "id long, title string, original_title string, original_language string, "
        "genres array<struct<id:bigint,name:string>>, "
        "production_companies array<struct<id:bigint,name:string,origin_country:string>>")
    d = dims.build_dims(snap)
    assert rows(d["genres"]) == [(18, "Drama")]
    comp = rows(d["production_companies"], "id", "name", "origin_country")
    assert (5, "A", "FR") in comp and (5, "B", "GB") in comp and len(comp) == 4
    mov = {r.id: (r.genres_id, r.production_companies_id) for r in d["mov"].collect()}
    assert mov[0] == ([18], [7, 9, 5]) and mov[1] == ([], [5, 5])


def test_category_rollup(spark):
    fact = spark.createDataFrame([(1, 3), (1, 2), (2, 4)], "id long, mention_count long")
    mov = spark.createDataFrame([(1, [18, 35]), (2, [18])], "id long, genres_id array<int>")
    gen = spark.createDataFrame([(18, "Drama"), (35, "Comedy")], "id int, name string")
    got = rows(dims.category_rollup(fact, mov, gen), "category", "mention_count")
    assert got == [("Comedy", 5), ("Drama", 9)]


def test_strict_landing_rejects_empty_hour(spark, tmp_path):
    import pytest
    empty = spark.createDataFrame([], "id string, t timestamp")
    with pytest.raises(ValueError):
        sinks.land_hourly(empty, str(tmp_path / "land"), "t", strict=True)


def test_csv_dimension_keeps_arrays_as_json(spark, tmp_path):
    mov = spark.createDataFrame([(1, "Wicked", [18, 35])], "id long, name string, genres_id array<int>")
    sinks.write_dimension(mov, str(tmp_path / "mov"), "20241218", fmt="csv")
    back = readers.read_dimension(spark, str(tmp_path / "mov"), "20241218", fmt="csv")
    r = back.first()
    assert r.genres_id == "[18,35]" and str(r.dataload) == "20241218"
    parsed = back.select(F.from_json("genres_id", "array<int>").alias("g")).first().g
    assert parsed == [18, 35]


def test_cli_mention_fact_and_ingest(spark, tmp_path):
    from trendspark.plans import cli
    posts, items = write_inputs(tmp_path)
    out = str(tmp_path / "fact")
    assert cli.main(["mention-fact", "--posts", posts, "--items", items, "--out", out, "--date", "2024-12-08"]) == 0
    back = spark.read.parquet(out)
    assert rows(back, "item_id", "text_count", "channel", "mention_count") == sorted(
        EXPECTED, key=lambda t: tuple((x is not None, x) for x in t))
    assert [r.day for r in back.select("day").distinct().collect()] == [8]
    arch = str(tmp_path / "archive")
    assert cli.main(["ingest", "--landing", posts + "/2024/12/08/12", "--archive", arch,
                     "--checkpoint", str(tmp_path / "ck"), "--items", items]) == 0
    # p1 'Wicked!', p2 'On Moana', p4 'wicked' name an item in the title; p3 (no title) and p5 do not
    assert sorted(r.id for r in spark.read.parquet(arch).collect()) == ["p1", "p2", "p4"]


def test_drop_fields_and_json_row(spark):
    from trendspark.functions import text as tx
    df = spark.createDataFrame([(1, "t", "x", "a")], "id int, title string, author string, subreddit string")
    kept = tx.drop_fields(df, ["_reddit", "subreddit", "author", "poll_data"])
    assert kept.columns == ["id", "title"]
    assert kept.select(tx.to_json_row(kept).alias("j")).first().j == '{"id":1,"title":"t"}'


def test_read_fact_day_and_item_helpers(spark, tmp_path):
    out = str(tmp_path / "fact")
    days = spark.createDataFrame([(1, dt.date(2024, 12, 8)), (2, dt.date(2024, 12, 9))], "id long, date date")
    sinks.write_fact(days, out)
    assert rows(readers.read_fact_day(spark, out, "2024-12-09"), "id") == [(2,)]
    items = spark.createDataFrame([(1, "moana"), (2, "moana"), (3, None), (3, "")], "item_id long, keyword string")
    assert rows(readers.item_ids(items)) == [(1,), (2,), (3,)]
    assert rows(readers.track_phrases(items)) == [("moana",)]


def test_metric_fact_dirty_stamps(spark):
    raw = spark.createDataFrame([(1, 2.0, "2024-12-18 01:00:00"), (2, 3.0, "not a date")],
                                "id long, popularity double, query_datetime string")
    out = facts.metric_fact(raw, "2024-12-18", metrics=["popularity"], strict=False)
    assert rows(out, "id", "day") == [(1, 18)]
    import pytest
    with pytest.raises(Exception):
        facts.metric_fact(raw, None, metrics=["popularity"]).collect()


def test_mention_fact_num_partitions_same_rows(spark, tmp_path):
    posts, items = write_inputs(tmp_path)
    a = jobs.mention_fact(spark, posts, items, "2024-12-08")
    b = jobs.mention_fact(spark, posts, items, "2024-12-08", num_partitions=3)
    cols = ("item_id", "text_count", "channel", "mention_count")
    assert rows(a, *cols) == rows(b, *cols)


def test_cli_ingest_whole_tokens(spark, tmp_path):
    from trendspark.plans import cli
    posts, items = write_inputs(tmp_path)
    arch = str(tmp_path / "archive")
    assert cli.main(["ingest", "--landing", posts + "/2024/12/08/12", "--archive", arch,
                     "--checkpoint", str(tmp_path / "ck"), "--items", items, "--whole-tokens"]) == 0
    # titles 'Wicked!', 'On Moana', 'wicked' are whole tokens; p3 has no title
    assert sorted(r.id for r in spark.read.parquet(arch).collect()) == ["p1", "p2", "p4"]


def test_read_items_rfc4180(spark, tmp_path):
    f = tmp_path / "items.csv"
    f.write_text('id,title,title_simple\n1,"Lion, the Witch","lionthewitch"\n2,"Say ""Hi""",sayhi\n3,Blank,\n')
    got = rows(readers.read_items(spark, str(f)), "item_id", "title", "keyword")
    assert got == [(1, "Lion, the Witch", "lionthewitch"), (2, 'Say "Hi"', "sayhi"), (3, "Blank", None)]


def test_run_mention_fact_counters(spark, tmp_path):
    posts, items = write_inputs(tmp_path, bad_line=True)
    c = jobs.run_mention_fact(spark, posts, items, str(tmp_path / "fact"), "2024-12-08", counters=True)
    assert c == {"rows_read": 6, "malformed_lines": 1}
    assert jobs.run_mention_fact(spark, posts, items, str(tmp_path / "fact2"), "2024-12-08") == {}


def test_mention_fact_whole_tokens(spark, tmp_path):
    posts, items = write_inputs(tmp_path)
    df = jobs.mention_fact(spark, posts, items, "2024-12-08", whole_tokens=True)
    want = [e for e in EXPECTED if e[0] != 4] + [(4, 0, None, 0)]  # 'here' is not a token of "Where"
    assert rows(df, "item_id", "text_count", "channel", "mention_count") == sorted(
        want, key=lambda t: tuple((x is not None, x) for x in t))


def _sf_of(spark, root, folders, **tables):
    """A folder of tables; those named in ``folders`` are folders of two files, the others single files."""
    import os
    import shutil
    os.makedirs(root, exist_ok=True)
    for name, df in tables.items():
        if name in folders:
            df.repartition(2).write.parquet(f"{root}/{name}.parquet")
        else:
            df.coalesce(1).write.parquet(f"{root}/{name}_parts")
            part = next(f for f in os.listdir(f"{root}/{name}_parts") if f.startswith("part-"))
            shutil.copy(f"{root}/{name}_parts/{part}", f"{root}/{name}.parquet")
    return str(root)


def test_streams_read_tables_that_are_files_or_folders(spark, tmp_path):
    from trendspark.plans import catalogue
    docs = spark.createDataFrame([(1, "The Quick brown fox", "a"), (2, "nothing", "b"), (3, "a quick, BROWN dog", "c")],
                                 "doc_id long, text string, source string")
    events = spark.range(3).selectExpr("id AS event_id", "timestamp_ntz '2024-01-01 10:00:00' + make_dt_interval(0, id) AS ts",
                                       "id AS user_id", "'x' AS event_type", "1.0D AS value")
    bench = spark.createDataFrame([(7, "quick brown")], "item_id long, text string")
    for i, folders in enumerate(((), ("documents", "events"))):
        sf = _sf_of(spark, tmp_path / str(i), folders, documents=docs, events=events, benchmark=bench)
        assert rows(catalogue.q_stream_phrase_filter(spark, sf)) == [(1, "a"), (3, "c")]
        assert rows(catalogue.q_stream_new_only(spark, sf), "event_id") == [(0,), (1,), (2,)]
        assert rows(catalogue.q_stream_hourly(spark, sf), "n") == [(1,), (1,), (1,)]


def test_land_metrics_query_covers_every_part(spark, tmp_path):
    from trendspark.plans import catalogue
    part = spark.createDataFrame([(i, f"n{i} m", "b", "t", 5, 1.0) for i in (1, 2, 3)],
                                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    bench = spark.createDataFrame([(1,), (2,), (3,), (4,)], "item_id long")
    sf = _sf_of(spark, tmp_path / "sf", (), part=part, benchmark=bench)
    assert rows(catalogue.q_job_land_metrics(spark, sf), "total", "covered", "missing") == [(4, 3, 1)]
