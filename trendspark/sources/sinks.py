"""Writers (K1–K5): partitioned Parquet facts, dimensions, raw landings.

Every writer sets dynamic partition overwrite on the writer itself, so a
rerun of one day replaces exactly that day and leaves all others intact
(the reference's metric job used static overwrite and deleted other days).
Rows are clustered by the partition columns before writing with the
REBALANCE hint: each output partition is written by few tasks (few files),
and AQE splits a partition that holds a large share of the rows instead of
sending it to one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from trendspark.functions.timeutil import date_parts, path_parts

FACT_PARTS = ("year", "month", "day")

# Text landings keep full microsecond precision (Spark's JSON/CSV default
# writes milliseconds only, which would silently change stamps).
TEXT_TIME_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                     "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _text_options(writer, fmt: str):
    if fmt in ("json", "csv"):
        for k, v in TEXT_TIME_OPTIONS.items():
            writer = writer.option(k, v)
    return writer


def write_partitioned(df: DataFrame, out: str, parts=FACT_PARTS, fmt: str = "parquet",
                      cluster: bool = True, **options) -> None:
    """Overwrite only the partitions present in ``df`` (dynamic overwrite)."""
    data = df.hint("rebalance", *parts) if cluster else df
    w = _text_options(data.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                      .partitionBy(*parts).format(fmt), fmt)
    for k, v in options.items():
        w = w.option(k, v)
    w.save(out)


def write_fact(df: DataFrame, out: str, date_col: str = "date", cluster: bool = True) -> None:
    """K1/K2: add year/month/day from ``date_col`` if absent, then write."""
    if not set(FACT_PARTS) <= set(df.columns):
        df = df.select("*", *date_parts(F.col(date_col)))
    write_partitioned(df, out, FACT_PARTS, cluster=cluster)


def write_dimension(df: DataFrame, out: str, load: str, fmt: str = "parquet") -> None:
    """K3: dimension under ``dataload=<load>``; CSV serialises arrays as JSON text."""
    if fmt == "csv":
        cols = [F.to_json(F.col(f.name)).alias(f.name) if f.dataType.typeName() in ("array", "map", "struct")
                else F.col(f.name) for f in df.schema.fields]
        df = df.select(*cols)
    data = df.withColumn("dataload", F.lit(str(load)))
    w = data.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("dataload").format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(out)


def write_load(tables: dict[str, DataFrame], root: str, load: str, fmt: str = "parquet") -> None:
    """All dimensions of one load, each under ``<root>/<name>/dataload=<load>``.

    ``<root>/loads`` gets a row per table (load, table, rows), in one append
    behind all tables: a load that stopped half-way has none, and readers
    (:func:`trendspark.sources.readers.read_load`) never take it.  Rows are
    counted while they are written.
    """
    root, counts = root.rstrip("/"), {}
    for name, df in tables.items():
        counts[name] = Observation(f"load {name}")
        write_dimension(df.observe(counts[name], F.count(F.lit(1)).alias("rows")), f"{root}/{name}", load, fmt)
    spark = next(iter(tables.values())).sparkSession
    marks = [(str(load), name, int(obs.get["rows"])) for name, obs in counts.items()]
    (spark.createDataFrame(marks, "load string, table string, rows long").coalesce(1).withColumn("written", F.current_timestamp())
     .write.mode("append").parquet(f"{root}/loads"))


def land_hourly(df: DataFrame, out: str, ts_col: str, fmt: str = "json",
                strict: bool = False, cluster: bool = True, append: bool = False) -> None:
    """K4: raw rows landed per event hour (zero-padded year/month/day/hour).

    Rows are partitioned by their own event hour.  An hour that is landed
    again is replaced, so a rerun changes nothing; other hours stay.
    ``append`` adds to the hours instead (rows that come late).  ``strict``
    raises when there is nothing to land (the reference treated an empty
    hour as an error).  ``cluster=False`` skips the REBALANCE shuffle (no
    exchange; each task then writes one file per hour it holds).
    """
    if strict and df.isEmpty():
        raise ValueError("no rows to land")
    data = df.select("*", *path_parts(F.col(ts_col)))
    if cluster:
        data = data.hint("rebalance", "year", "month", "day", "hour")
    w = data.write.mode("append" if append else "overwrite").partitionBy("year", "month", "day", "hour").format(fmt)
    if not append:
        w = w.option("partitionOverwriteMode", "dynamic")
    _text_options(w, fmt).save(out)


def land_daily(df: DataFrame, out: str, ts_col: str, fmt: str = "json") -> None:
    """K5: one day of snapshots per day folder; a same-day rerun replaces it."""
    data = df.select("*", *path_parts(F.col(ts_col))[:3])
    write_partitioned(data, out, FACT_PARTS, fmt=fmt)


def backfill_hours(df: DataFrame, out: str, ts_col: str, start, end, fmt: str = "json",
                   cluster: bool = True) -> None:
    """Land every hour of [start, end) in one pass (no per-hour loop).

    Rows are filtered to the half-open range and partitioned by their own
    hour; the reference looped over consecutive hour pairs instead.
    """
    from trendspark.functions.timeutil import in_interval
    land_hourly(df.where(in_interval(ts_col, start, end)), out, ts_col, fmt, cluster=cluster)


def write_slices(running: DataFrame, out: str, buckets: int = 64, name: str = "name") -> None:
    """Running totals in folders by a hash of the name, sorted in each file, so
    a selected name reads one folder (:func:`trendspark.sources.readers.read_slice`)."""
    from trendspark.operators.trends import name_bucket
    data = running.withColumn("bucket", name_bucket(name, buckets)).hint("rebalance", "bucket").sortWithinPartitions("bucket", name, "date")
    data.write.mode("overwrite").partitionBy("bucket").parquet(out)
