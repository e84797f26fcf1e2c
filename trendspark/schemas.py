"""Explicit schemas for every input and output table (no inference).

Ids are BIGINT everywhere.  Reading with a declared schema avoids the
inference pass over raw JSON (a full extra job) and keeps types stable
when a day is empty.
"""

from pyspark.sql import types as T

# Raw posts, one JSON object per line; other fields are ignored.  The field
# names are fixed values of the post format and must match it exactly.
POSTS = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("selftext", T.StringType()),
    T.StructField("subreddit_name_prefixed", T.StringType()),
    T.StructField("upvote_ratio", T.DoubleType()),
    T.StructField("created_utc", T.DoubleType()),
    T.StructField("_corrupt_record", T.StringType()),
])

GENRE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
])
COMPANY = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("origin_country", T.StringType()),
])

# Daily metric snapshot, one JSON object per item per day.
METRICS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("original_title", T.StringType()),
    T.StructField("original_language", T.StringType()),
    T.StructField("popularity", T.DoubleType()),
    T.StructField("vote_average", T.DoubleType()),
    T.StructField("vote_count", T.LongType()),
    T.StructField("query_datetime", T.StringType()),
    T.StructField("genres", T.ArrayType(GENRE)),
    T.StructField("production_companies", T.ArrayType(COMPANY)),
    T.StructField("_corrupt_record", T.StringType()),
])

# Item / keyword list (CSV with header).
ITEMS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("title_simple", T.StringType()),
])

# Lines of a landing as they are.
RAW_LINES = T.StructType([T.StructField("value", T.StringType())])

# Staged posts (collector output): key, event time text, raw JSON payload.
STAGED_POSTS = T.StructType([
    T.StructField("id_str", T.StringType()),
    T.StructField("post_datetime", T.StringType()),
    T.StructField("raw", T.StringType()),
])

MENTION_FACT = T.StructType([
    T.StructField("item_id", T.LongType()),
    T.StructField("text_count", T.LongType()),
    T.StructField("channel", T.StringType()),
    T.StructField("mention_count", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
])

METRIC_FACT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("popularity", T.DoubleType()),
    T.StructField("vote_average", T.DoubleType()),
    T.StructField("vote_count", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
])

CALENDAR = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("weekday", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
])

ITEM_DIM = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("original_name", T.StringType()),
    T.StructField("original_language", T.StringType()),
    T.StructField("genres_id", T.ArrayType(T.IntegerType())),
    T.StructField("production_companies_id", T.ArrayType(T.IntegerType())),
])
