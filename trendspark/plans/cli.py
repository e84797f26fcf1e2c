"""Command-line entry points for the batch jobs and the ingest session.

    python -m trendspark.plans.cli mention-fact --posts P --items I --out O --date 2024-12-08
    python -m trendspark.plans.cli metric-fact  --metrics M --out O --date 2024-12-08
    python -m trendspark.plans.cli build-dims   --metrics M --out O --load 20241218 --as-of 2024-12-18
    python -m trendspark.plans.cli ingest       --landing L --archive A --checkpoint C [--items I]
    python -m trendspark.plans.cli view         --facts F --metrics M --dims D --start S --end E [--name N] --out V
    python -m trendspark.plans.cli top          --facts F --metrics M --dims D --start S --end E [--k 3 --n 20]

On a cluster, submit with spark-submit; the active session is used.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from trendspark import schemas
from trendspark.functions.text import json_field, portable_variant, simple_text, token_end_mask, token_start_mask
from trendspark.operators import trends
from trendspark.plans import jobs
from trendspark.session import get_session
from trendspark.sources import readers, sinks
from trendspark.streaming import ingest


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="trendspark")
    sub = p.add_subparsers(dest="cmd", required=True)
    m = sub.add_parser("mention-fact", help="E1: posts + items → mention fact")
    m.add_argument("--posts", required=True)
    m.add_argument("--items", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--date")
    m.add_argument("--start")
    m.add_argument("--end")
    m.add_argument("--num-partitions", type=int)
    m.add_argument("--day-folders", action="store_true", help="the default; see --all-folders")
    m.add_argument("--all-folders", action="store_true", help="list the whole root, not only the days' folders")
    m.add_argument("--posts-format", default="json", choices=["json", "parquet"], help="parquet: an ingest archive")
    m.add_argument("--counters", action="store_true", help="print lines read / malformed lines (A9)")
    m.add_argument("--whole-tokens", action="store_true",
                   help="match keywords on whole tokens of the post text (default: substring)")
    t = sub.add_parser("metric-fact", help="E2: metric snapshot → metric fact")
    t.add_argument("--metrics", required=True)
    t.add_argument("--out", required=True)
    t.add_argument("--date", required=True)
    d = sub.add_parser("build-dims", help="E3: snapshot → genre/company/item/calendar dimensions")
    d.add_argument("--metrics", required=True)
    d.add_argument("--out", required=True)
    d.add_argument("--load", required=True)
    d.add_argument("--as-of", required=True)
    d.add_argument("--num-years", type=int, default=1)
    d.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    i = sub.add_parser("ingest", help="E4: one bounded ingest session (availableNow)")
    i.add_argument("--landing", required=True)
    i.add_argument("--archive", required=True)
    i.add_argument("--checkpoint", required=True)
    i.add_argument("--items", help="keep only posts whose title names an item")
    i.add_argument("--max-files-per-trigger", type=int, default=100)
    i.add_argument("--whole-tokens", action="store_true",
                   help="match item keywords on whole title tokens (default: substring)")
    h = sub.add_parser("land-hours", help="K4/W5: hours [start, end) of an archive as JSON, an hour landed again is replaced")
    h.add_argument("--archive", required=True)
    h.add_argument("--out", required=True)
    h.add_argument("--start", required=True)
    h.add_argument("--end", required=True)
    q = sub.add_parser("land-metrics", help="E5: one day of metric snapshots landed; prints the coverage")
    q.add_argument("--incoming", required=True)
    q.add_argument("--items", required=True)
    q.add_argument("--out", required=True)
    q.add_argument("--as-of", required=True)
    v = sub.add_parser("view", help="E6/W2: the star view sliced by date range and name, written as Parquet")
    v.add_argument("--facts", required=True)
    v.add_argument("--metrics", required=True)
    v.add_argument("--dims", required=True)
    v.add_argument("--start", required=True)
    v.add_argument("--end", required=True)
    v.add_argument("--name", default="All")
    v.add_argument("--dims-format", default="parquet", choices=["parquet", "csv"])
    v.add_argument("--out", required=True)
    r = sub.add_parser("top", help="E6: trimmed ranking of total mentions")
    r.add_argument("--facts", required=True)
    r.add_argument("--metrics", required=True)
    r.add_argument("--dims", required=True)
    r.add_argument("--start", required=True)
    r.add_argument("--end", required=True)
    r.add_argument("--k", type=int, default=3)
    r.add_argument("--n", type=int, default=20)
    r.add_argument("--last-days", type=int)
    r.add_argument("--dims-format", default="parquet", choices=["parquet", "csv"])
    return p


def main(argv=None) -> int:
    a = _parser().parse_args(argv)
    spark = get_session()
    if a.cmd == "mention-fact":
        c = jobs.run_mention_fact(spark, a.posts, a.items, a.out, a.date, start=a.start, end=a.end,
                                  num_partitions=a.num_partitions, day_folders=not a.all_folders,
                                  counters=a.counters, whole_tokens=a.whole_tokens, posts_format=a.posts_format)
        if a.counters:
            print(json.dumps(c))
    elif a.cmd == "metric-fact":
        jobs.run_metric_fact(spark, a.metrics, a.out, a.date)
    elif a.cmd == "build-dims":
        jobs.run_build_dims(spark, a.metrics, a.out, a.load, a.as_of, fmt=a.format, num_years=a.num_years)
    elif a.cmd == "ingest":
        lines = ingest.file_stream(spark, a.landing, schemas.RAW_LINES, "text", a.max_files_per_trigger)
        s = ingest.with_arrival(lines).select("*", json_field("value", schemas.POSTS.simpleString()).alias("p")) \
            .select("p.*", F.coalesce(F.to_json(portable_variant("value", ingest.NON_PORTABLE_FIELDS)), "value").alias("raw"),
                    *ingest.ARRIVAL_COLS).drop("_corrupt_record")  # the whole object without the non-portable fields; a malformed line as it is
        s = s.withColumn("event_time", F.timestamp_seconds("created_utc")) \
             .withColumn("title_simple", simple_text("title"))
        masks = None
        if a.whole_tokens:
            s = s.withColumn("title_sm", token_start_mask("title")).withColumn("title_em", token_end_mask("title"))
            masks = ("title_sm", "title_em")
        kws = readers.read_items(spark, a.items) if a.items else None
        q = ingest.start_ingest(spark, s, a.archive, a.checkpoint, keys=("id",), keywords=kws,
                                text_col="title_simple", token_masks=masks, counts=(counts := {}),
                                order=[*ingest.ARRIVAL_COLS, "event_time"])  # first landed copy of a post wins
        q.awaitTermination()
        print(json.dumps(counts))
    elif a.cmd == "land-hours":
        posts = spark.read.parquet(a.archive).drop("year", "month", "day", "hour")
        sinks.backfill_hours(posts, a.out, "event_time", a.start, a.end)
    elif a.cmd == "land-metrics":
        tally = jobs.land_metrics(spark, readers.read_metrics(spark, a.incoming).drop("_corrupt_record"), a.out,
                                  readers.read_items(spark, a.items), a.as_of)
        print(json.dumps(tally.first().asDict()))
    elif a.cmd == "view":
        view = jobs.build_trends(spark, a.facts, a.metrics, a.dims, a.start, a.end, dims_format=a.dims_format)
        sliced = trends.slice_trends(view, a.name, a.start, a.end)
        sliced.write.mode("overwrite").parquet(a.out)
    elif a.cmd == "top":
        view = jobs.build_trends(spark, a.facts, a.metrics, a.dims, a.start, a.end, dims_format=a.dims_format)
        for row in jobs.rank_totals(view, a.k, a.n, a.last_days).collect():  # bounded: n rows (top-k report)
            print(f"{row['name']}\t{row['total']}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
