"""End to end: land posts hourly (K4) → mention fact (E1) → land metric
snapshots (E5) → metric fact (E2) → dimensions (E3) → trend view, ranking
and slicing (E6); plus counters (A9) and ascending order (L1)."""

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import rows
from trendspark import schemas
from trendspark.operators import quality, trends
from trendspark.plans import jobs
from trendspark.sources import readers, sinks

ITEMS_CSV = "id,title,title_simple\n1,Wicked,wicked\n2,Moana,moana\n3,Gladiator II,gladiatorii\n"
D8, D9 = 1733659200.0, 1733745600.0  # 2024-12-08 12:00 and 2024-12-09 12:00 UTC


def posts(spark):
    data = [("p1", "r/movies", "Wicked!", "", D8), ("p2", "r/TrueFilm", "Moana and wicked", None, D8 + 60),
            ("p3", "r/movies", "wicked again", None, D9), ("p4", "r/movies", "moana", None, D9 + 7200)]
    df = spark.createDataFrame(data, "id string, subreddit_name_prefixed string, title string, "
                                     "selftext string, created_utc double")
    return df.withColumn("event_time", F.timestamp_seconds("created_utc"))


def snapshot(spark, stamp, pops):
    rows_ = [(i, name, name, "en", pop, 7.0, 10, stamp, [(18, "Drama")], [(5, "Studio", "US")])
             for i, name, pop in pops]
    fields = [f for f in schemas.METRICS.fields if f.name != "_corrupt_record"]
    return spark.createDataFrame(rows_, schemas.METRICS.__class__(fields))


def test_pipeline(spark, tmp_path):
    root = str(tmp_path)
    (tmp_path / "items.csv").write_text(ITEMS_CSV)
    items_path = f"{root}/items.csv"
    sinks.land_hourly(posts(spark), f"{root}/posts_raw", "event_time")
    for day in ("2024-12-08", "2024-12-09"):
        jobs.run_mention_fact(spark, f"{root}/posts_raw", items_path, f"{root}/posts_clean", day,
                              day_folders=True)
    items = readers.read_items(spark, items_path)
    cov = jobs.land_metrics(spark, snapshot(spark, "2024-12-08 01:00:00", [(1, "Wicked", 50.0), (2, "Moana", 20.0)]),
                            f"{root}/metrics_raw", items).first()
    assert (cov.total, cov.covered, cov.missing) == (3, 2, 1)
    jobs.land_metrics(spark, snapshot(spark, "2024-12-09 01:00:00",
                                      [(1, "Wicked", 60.0), (2, "Moana", 25.0), (3, "Gladiator II", 5.0)]),
                      f"{root}/metrics_raw", items)
    for day in ("2024-12-08", "2024-12-09"):
        jobs.run_metric_fact(spark, f"{root}/metrics_raw", f"{root}/metrics_clean", day)
    jobs.run_build_dims(spark, f"{root}/metrics_raw", f"{root}/dims", "20241209", "2024-12-09")

    fact = readers.read_fact_range(spark, f"{root}/posts_clean", "2024-12-08", "2024-12-09")
    got = rows(fact, "item_id", "date", "channel", "mention_count", "text_count")
    assert (1, dt.date(2024, 12, 8), "movies", 1, 2) in got
    assert (1, dt.date(2024, 12, 8), "truefilm", 1, 2) in got
    assert (3, dt.date(2024, 12, 9), None, 0, 0) in got

    view = jobs.build_trends(spark, f"{root}/posts_clean", f"{root}/metrics_clean", f"{root}/dims",
                             "2024-12-08", "2024-12-09")
    v = rows(view, "id", "date", "channel", "mention_count", "popularity", "weekday")
    assert (1, dt.date(2024, 12, 9), "movies", 1, 60.0, 1) in v
    assert (2, dt.date(2024, 12, 8), "truefilm", 1, 20.0, 7) in v
    # one row per fact row: the item dimension holds two snapshots of each item,
    # so it is read for the latest load only (one row per id)
    assert view.count() == fact.where("item_id in (1, 2) or date = '2024-12-09'").count()
    totals = trends.name_totals(view, "name", "mention_count", "total")
    assert rows(totals) == [("Gladiator II", 0), ("Moana", 2), ("Wicked", 3)]
    assert jobs.rank_totals(view, k=1).count() == 2
    assert [r.name for r in jobs.rank_totals(view, k=1, n=1).collect()] == ["Moana"]
    assert [r.name for r in trends.ascending(totals).collect()] == ["Gladiator II", "Moana", "Wicked"]
    one = trends.slice_trends(view, "Moana", "2024-12-09", "2024-12-09")
    assert rows(one, "id", "mention_count") == [(2, 1)]


def test_counters(spark):
    df = spark.range(10).withColumn("odd", F.col("id") % 2)
    out, obs = quality.with_counters(df, "c", odd=F.sum("odd"))
    out.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows": 10, "odd": 5}


def test_cli_top_after_pipeline(spark, tmp_path, capsys):
    from trendspark.plans import cli
    root = str(tmp_path)
    (tmp_path / "items.csv").write_text(ITEMS_CSV)
    sinks.land_hourly(posts(spark), f"{root}/posts_raw", "event_time")
    items = readers.read_items(spark, f"{root}/items.csv")
    jobs.land_metrics(spark, snapshot(spark, "2024-12-09 01:00:00",
                                      [(1, "Wicked", 60.0), (2, "Moana", 25.0), (3, "Gladiator II", 5.0)]),
                      f"{root}/metrics_raw", items)
    assert cli.main(["mention-fact", "--posts", f"{root}/posts_raw", "--items", f"{root}/items.csv",
                     "--out", f"{root}/facts", "--date", "2024-12-09", "--day-folders"]) == 0
    assert cli.main(["metric-fact", "--metrics", f"{root}/metrics_raw", "--out", f"{root}/metrics",
                     "--date", "2024-12-09"]) == 0
    assert cli.main(["build-dims", "--metrics", f"{root}/metrics_raw", "--out", f"{root}/dims",
                     "--load", "20241209", "--as-of", "2024-12-09"]) == 0
    assert cli.main(["view", "--facts", f"{root}/facts", "--metrics", f"{root}/metrics", "--dims", f"{root}/dims",
                     "--start", "2024-12-09", "--end", "2024-12-09", "--name", "Moana", "--out", f"{root}/view"]) == 0
    v = spark.read.parquet(f"{root}/view")
    assert rows(v, "id", "mention_count", "popularity") == [(2, 1, 25.0)]
    capsys.readouterr()
    assert cli.main(["top", "--facts", f"{root}/facts", "--metrics", f"{root}/metrics", "--dims", f"{root}/dims",
                     "--start", "2024-12-09", "--end", "2024-12-09", "--k", "1", "--n", "5"]) == 0
    out = capsys.readouterr().out.strip().splitlines()
    # day 9 totals: Wicked 1, Moana 1, Gladiator II 0; trim the largest (Wicked wins the name tie-break)
    assert out == ["Moana\t1", "Gladiator II\t0"]
