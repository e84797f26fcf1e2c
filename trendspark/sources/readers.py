"""Scans (S1–S7, S9): explicit schemas, partition pruning, no path strings.

Raw landings use nested ``Y/M/D[/H]`` folders without ``key=value`` names,
which Spark does not descend into by default; readers glob the requested
days (cheap listing) or use ``recursiveFileLookup`` for a whole root.
Curated facts use ``year=/month=/day=`` folders and are read through
partition discovery with predicates on the partition columns, so only the
requested days are listed and read.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark import schemas
from trendspark.functions.text import channel_name, final_text, simple_text, unify_keyword
from trendspark.functions.timeutil import epoch_to_date


def _days(start, end) -> list[_dt.date]:
    s, e = _dt.date.fromisoformat(str(start)), _dt.date.fromisoformat(str(end))
    return [s + _dt.timedelta(days=i) for i in range((e - s).days + 1)]


def day_globs(root: str, start, end, hourly: bool = True) -> list[str]:
    """Glob patterns of the raw landing for a closed day range.

    One pattern per month and layout, the month's days as a brace set
    (``YYYY/MM/{08,09}/…``), so listing cost grows with months, not days.
    Both layouts are covered: the plain ``Y/M/D[/H]`` folders and the
    ``year=/month=/day=[/hour=]`` folders our landing writers produce;
    :func:`_existing` keeps the patterns that match files.
    """
    r = root.rstrip("/")
    plain = "/*/*.json*" if hourly else "/*.json*"  # compressed landings too
    hive = "/hour=*/*.json*" if hourly else "/*.json*"
    months: dict[tuple[int, int], list[str]] = {}
    for d in _days(start, end):
        months.setdefault((d.year, d.month), []).append(f"{d.day:02d}")
    out = []
    for (y, m), days in months.items():
        dd = days[0] if len(days) == 1 else "{" + ",".join(days) + "}"
        out.append(f"{r}/{y:04d}/{m:02d}/{dd}{plain}")
        out.append(f"{r}/year={y:04d}/month={m:02d}/day={dd}{hive}")
    return out


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Item list CSV → (item_id, title, keyword); keyword per F1."""
    raw = (spark.read.schema(schemas.ITEMS).option("header", True).option("mode", "PERMISSIVE")
           .option("quote", '"').option("escape", '"')  # RFC 4180: "" inside a quoted field
           .csv(path))
    return raw.select(F.col("id").alias("item_id"), "title",
                      unify_keyword("title_simple").alias("keyword"))


def item_ids(items: DataFrame, key: str = "item_id") -> DataFrame:
    """The item ids to query, as a DataFrame (never a driver list)."""
    return items.select(key).where(F.col(key).isNotNull()).distinct()


def track_phrases(items: DataFrame, keyword: str = "keyword") -> DataFrame:
    """Distinct non-empty keywords (the phrases a collector tracks)."""
    return items.select(keyword).where(F.col(keyword).isNotNull() & (F.col(keyword) != "")).distinct()


def read_posts(spark: SparkSession, path, start=None, end=None, fmt: str = "json", days: list[str] | None = None) -> DataFrame:
    """Raw posts JSON lines with the declared schema, or an ingest archive
    (``fmt="parquet"``, of which only the day folders from start to end, or
    of the listed ``days``, are listed and read).

    ``path`` is a landing root; with ``start``/``end`` only those days'
    folders are listed (a day missing from the landing is skipped).
    Malformed lines are kept in ``_corrupt_record`` (count them, do not fail).
    """
    if fmt != "json":
        if start is not None:
            wanted = None if days is None else set(days)
            folders = [p for d, p in day_folders(spark, path, start, end or start) if wanted is None or str(d) in wanted]
            if not folders:
                return spark.createDataFrame([], schemas.POSTS)
            df = read_days(spark, path, folders, fmt)
        else:
            df = spark.read.format(fmt).load(path)
        have = set(df.columns)
        return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in schemas.POSTS.fields])
    r = spark.read.schema(schemas.POSTS).option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", "_corrupt_record")
    if start is not None:
        paths = _existing(spark, day_globs(path, start, end or start, hourly=True))
        return r.json(paths) if paths else spark.createDataFrame([], schemas.POSTS)
    return r.option("recursiveFileLookup", True).json(path)


def read_metrics(spark: SparkSession, path, start=None, end=None) -> DataFrame:
    """S3: raw metric snapshots JSON lines with the declared schema."""
    r = spark.read.schema(schemas.METRICS).option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", "_corrupt_record")
    if start is not None:
        paths = _existing(spark, day_globs(path, start, end or start, hourly=False))
        return r.json(paths) if paths else spark.createDataFrame([], schemas.METRICS)
    return r.option("recursiveFileLookup", True).json(path)


def _existing(spark: SparkSession, globs: list[str]) -> list[str]:
    """Keep the globs that match at least one file (a missing day is skipped).

    Uses the Hadoop file system of the path, so it works on any store.
    """
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # no JVM access (Spark Connect): let the reader resolve globs
        return globs
    out = []
    for g in globs:
        p = jvm.org.apache.hadoop.fs.Path(g)
        st = p.getFileSystem(conf).globStatus(p)
        if st is not None and len(st) > 0:
            out.append(g)
    return out or globs[:0]


def normalise_posts(raw: DataFrame, *, id_col: str = "id", title: str = "title",
                    body: str = "selftext", channel: str = "subreddit_name_prefixed",
                    created: str = "created_utc", missing_title: str | None = "None") -> DataFrame:
    """F3–F6 on raw posts → (post_id, channel, final_text, simple_text, date)."""
    ft = final_text(title, body, missing_title)
    return raw.select(F.col(id_col).alias("post_id"), channel_name(channel).alias("channel"),
                      ft.alias("final_text"), simple_text(ft).alias("simple_text"),
                      epoch_to_date(created).alias("date"))


def partition_date_filter(start, end) -> Column:
    """Predicate on partition columns year/month/day for a closed date range.

    It references partition columns only, so Spark evaluates it against the
    partition values and lists only matching folders.
    """
    d = F.make_date(F.col("year"), F.col("month"), F.col("day"))
    return d.between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))


def read_fact_range(spark: SparkSession, root: str, start, end,
                    schema: T.StructType | None = None) -> DataFrame:
    """Date-range scan of a year/month/day partitioned fact.

    Missing days are simply absent; a range with no data returns zero rows
    with the full schema (``schema`` is required when the root may not exist).
    """
    try:
        spark.sparkContext
    except Exception:  # no JVM access (Spark Connect): Spark lists the root and prunes the folders
        pass
    else:
        folders = [path for _, path in day_folders(spark, root, start, end)]
        if folders:
            return read_days(spark, root, folders, schema=schema).where(partition_date_filter(start, end))
    try:
        r = spark.read
        if schema is not None:
            r = r.schema(schema)
        df = r.parquet(root)
    except Exception as err:  # missing root: empty, typed result
        if schema is None or "PATH_NOT_FOUND" not in str(err):
            raise
        return spark.createDataFrame([], schema)
    return df.where(partition_date_filter(start, end))


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none if it is missing."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()] if fs.exists(p) else []


def _numbered(spark: SparkSession, path: str, name: str, low: int, high: int) -> list[tuple[int, str]]:
    out = []
    for child in _children(spark, path):
        key, _, value = child.partition("=")
        if key == name and value.isdigit() and low <= int(value) <= high:
            out.append((int(value), f"{path}/{child}"))
    return out


def day_folders(spark: SparkSession, root: str, start, end) -> list[tuple[_dt.date, str]]:
    """(day, folder) of the ``year=/month=/day=`` folders of a closed range, by
    listing the root, the years and the months of the range; no other day's files are listed."""
    s, e = _dt.date.fromisoformat(str(start)), _dt.date.fromisoformat(str(end))
    out = []
    for year, y in _numbered(spark, root.rstrip("/"), "year", s.year, e.year):
        months = (s.month if year == s.year else 1, e.month if year == e.year else 12)
        for month, m in _numbered(spark, y, "month", *months):
            days = (s.day if (year, month) == (s.year, s.month) else 1, e.day if (year, month) == (e.year, e.month) else 31)
            out += [(_dt.date(year, month, day), d) for day, d in _numbered(spark, m, "day", *days)]
    return sorted(out)


def read_days(spark: SparkSession, root: str, folders: list[str], fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """A partitioned table, of which only the given folders are listed and read."""
    r = spark.read if schema is None else spark.read.schema(schema)
    return r.option("basePath", root).format(fmt).load(folders)


def read_fact_day(spark: SparkSession, root: str, day, schema=None) -> DataFrame:
    """One partition (one day) of a partitioned fact."""
    return read_fact_range(spark, root, day, day, schema)


def read_dimension(spark: SparkSession, root: str, load: str | None = None,
                   fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """Dimension of one load (``dataload=YYYYMMDD`` folder); latest if None.

    'Latest' is a scalar subquery on the partition column, so it prunes at
    run time (dynamic partition pruning) without a driver round trip.  A CSV
    dimension needs ``schema``: its columns are text, arrays as JSON.
    """
    r = spark.read
    if fmt == "csv":
        df = r.option("header", True).csv(root)
        if schema is not None:
            df = df.select(*[(F.from_json(f.name, f.dataType) if f.dataType.typeName() == "array"
                              else F.col(f.name).cast(f.dataType)).alias(f.name) for f in schema.fields], "dataload")
    else:
        df = (r if schema is None else r.schema(schema)).format(fmt).load(root)
    if load is not None:
        return df.where(F.col("dataload") == F.lit(str(load)).cast(df.schema["dataload"].dataType))
    return df.where(F.col("dataload") == df.agg(F.max("dataload")).scalar())


def complete_load(spark: SparkSession, root: str, names, load: str | None = None) -> str:
    """The newest load that has all of ``names`` (or ``load``, if it has); from
    the marks that :func:`trendspark.sources.sinks.write_load` adds last."""
    marks = spark.read.parquet(f"{root.rstrip('/')}/loads").where(F.col("table").isin(*names))
    if load is not None:
        marks = marks.where(F.col("load") == str(load))
    whole = marks.groupBy("load").agg(F.countDistinct("table").alias("n")).where(F.col("n") == len(set(names)))
    found = whole.agg(F.max("load")).first()[0]
    if found is None:
        raise ValueError(f"no complete load of {sorted(names)} under {root}")
    return found


def read_load(spark: SparkSession, root: str, names, load: str | None = None, fmt: str = "parquet",
              schema: dict[str, T.StructType] | None = None) -> dict[str, DataFrame]:
    """The dimensions of one consistent load; no other load's folder is listed."""
    root, schema = root.rstrip("/"), schema or {}
    found = complete_load(spark, root, names, load)
    out = {}
    for name in names:
        path, kind = f"{root}/{name}/dataload={found}", schema.get(name)
        if fmt == "csv":
            df = spark.read.option("header", True).csv(path)
            if kind is not None:
                df = df.select(*[(F.from_json(f.name, f.dataType) if f.dataType.typeName() == "array"
                                  else F.col(f.name).cast(f.dataType)).alias(f.name) for f in kind.fields])
        else:
            df = (spark.read if kind is None else spark.read.schema(kind)).format(fmt).load(path)
        out[name] = df
    return out


def read_slice(spark: SparkSession, out: str, name_value: str | None = None, buckets: int = 64, name: str = "name") -> DataFrame:
    """The running totals that :func:`trendspark.sources.sinks.write_slices` wrote, of all names or of one (one folder)."""
    from trendspark.operators.trends import name_bucket
    df = spark.read.parquet(out)
    if name_value is not None:
        df = df.where((F.col("bucket") == name_bucket(F.lit(name_value), buckets)) & (F.col(name) == F.lit(name_value)))
    return df.drop("bucket")
