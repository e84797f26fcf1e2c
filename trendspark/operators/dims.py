"""Dimensions built from nested snapshots.

The reference loops over items in Python, checks each (id, name) against a
growing pandas frame and appends.  Here the same tables come from explode +
aggregate: distinct (id, name) for categories, and for attributes where the
first seen value wins, ``min_by`` over an explicit (item order, array
position) key — deterministic, and partially aggregated before the shuffle,
so a hot key costs one row per task rather than one task for the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_array(arr, field: str = "id", cast: str = "int") -> Column:
    """Ids of an array of structs in source order; absent list → []."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.coalesce(F.transform(a, lambda x: x[field].cast(cast)),
                      F.array().cast(f"array<{cast}>"))


def field_array(arr, field: str) -> Column:
    """Field of each struct of an array, source order kept; absent → []."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.coalesce(F.transform(a, lambda x: x[field]), F.array().cast("array<string>"))


def explode_with_position(df: DataFrame, arr: str, keep=(), pos: str = "pos",
                          elem: str = "elem") -> DataFrame:
    """One row per array element with its 0-based position in the array."""
    return df.select(*keep, F.posexplode(arr).alias(pos, elem))


def distinct_pairs(df: DataFrame, cols=("id", "name")) -> DataFrame:
    """Distinct (id, name) rows."""
    return df.select(*cols).dropDuplicates(list(cols))


def first_seen(df: DataFrame, keys, values, order) -> DataFrame:
    """One row per ``keys`` with the ``values`` of the row smallest in ``order``.

    ``order`` must make rows unique within a key (e.g. item order + array
    position) for the result to be deterministic.
    """
    keys, values, order = list(keys), list(values), list(order)
    pick = F.min_by(F.struct(*values), F.struct(*order)).alias("_v")
    return df.groupBy(*keys).agg(pick).select(*keys, *[F.col(f"_v.{v}").alias(v) for v in values])


def genre_dim(snapshot: DataFrame, arr: str = "genres") -> DataFrame:
    """Genre dimension: distinct (id INT, name) over all items' genre lists."""
    g = snapshot.select(F.explode(arr).alias("g"))
    return distinct_pairs(g.select(F.col("g.id").cast("int").alias("id"), F.col("g.name").alias("name")))


def company_dim(snapshot: DataFrame, arr: str = "production_companies",
                item_order: str = "id") -> DataFrame:
    """Company dimension: distinct (id, name), the first seen origin_country.

    'First' = smallest (``item_order``, position in the item's list).
    """
    e = snapshot.select(F.col(item_order).alias("_item"), F.posexplode(arr).alias("_pos", "c"))
    rows = e.select(F.col("c.id").cast("int").alias("id"), F.col("c.name").alias("name"),
                    F.col("c.origin_country").alias("origin_country"), "_item", "_pos")
    return first_seen(rows, ["id", "name"], ["origin_country"], ["_item", "_pos"])


def merge_companies(stored: DataFrame | None, snapshot: DataFrame, day: str, arr: str = "production_companies",
                    item_order: str = "id") -> DataFrame:
    """A8 across loads: the company dimension with one more landed day.

    Columns id, name, origin_country and where that was first seen (first_day,
    first_item, first_pos).  'First' is by day, item and place in its list over
    all days merged so far, in whatever order they come and however often, so
    merging day by day equals one pass over all days.
    """
    e = snapshot.select(F.lit(day).cast("date").alias("first_day"), F.col(item_order).cast("long").alias("first_item"), F.posexplode(arr).alias("first_pos", "c"))
    rows = e.select(F.col("c.id").cast("int").alias("id"), F.col("c.name").alias("name"), F.col("c.origin_country").alias("origin_country"),
                    "first_day", "first_item", "first_pos")
    rows = rows if stored is None else rows.unionByName(stored)
    return first_seen(rows, ["id", "name"], ["origin_country", "first_day", "first_item", "first_pos"], ["first_day", "first_item", "first_pos"])


def merge_pairs(stored: DataFrame | None, pairs: DataFrame) -> DataFrame:
    """A7/P8 across loads: distinct (id, name) rows of the stored dimension and one more day."""
    return distinct_pairs(pairs if stored is None else pairs.unionByName(stored.select("id", "name")))


def item_dim(snapshot: DataFrame) -> DataFrame:
    """Item dimension rows (not de-duplicated, like the reference)."""
    return snapshot.select(
        F.col("id").cast("bigint").alias("id"), F.col("title").alias("name"),
        F.col("original_title").alias("original_name"), "original_language",
        id_array("genres").alias("genres_id"),
        id_array("production_companies").alias("production_companies_id"))


def build_dims(snapshot: DataFrame, item_order: str = "id") -> dict[str, DataFrame]:
    """The three snapshot dimensions from one metric snapshot."""
    return {"genres": genre_dim(snapshot), "production_companies": company_dim(snapshot, item_order=item_order),
            "mov": item_dim(snapshot)}


def category_rollup(facts: DataFrame, item_dim_df: DataFrame, categories: DataFrame | None, *,
                    item_key: str = "id", ids_col: str = "genres_id", cat_key: str = "id",
                    cat_name: str = "name", measures=None) -> DataFrame:
    """Roll a per-item fact up to categories through an array-key join.

    The fact is aggregated per item first (so the explode multiplies item
    totals, not fact rows), then joined to the exploded item→category pairs
    and the category dimension, then aggregated per category.  Without a
    category dimension the array element itself is the category.  A mean is
    carried as sum and count; measures are sum, count, min, max or avg.
    """
    measures = measures or {"mention_count": "sum"}
    if unknown := set(measures.values()) - {"sum", "count", "min", "max", "avg"}:
        raise ValueError(f"can't be rolled up from item totals: {sorted(unknown)}")
    parts = [e for c, fn in measures.items() for e in (
        [F.sum(c).alias(f"{c}_sum"), F.count(c).alias(f"{c}_n")] if fn == "avg" else [getattr(F, fn)(c).alias(c)])]
    per_item = facts.groupBy(item_key).agg(*parts)
    links = item_dim_df.select(F.col(item_key), F.explode(F.array_distinct(ids_col)).alias("_cat"))
    j = per_item.join(links, item_key)
    if categories is None:
        j = j.withColumnRenamed("_cat", "category")
    else:
        cats = categories.select(F.col(cat_key).alias("_cat"), F.col(cat_name).alias("category"))
        j = j.join(cats, "_cat")
    total = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    return j.groupBy("category").agg(*[
        (F.sum(f"{c}_sum") / F.sum(f"{c}_n")).alias(c) if fn == "avg" else total[fn](c).alias(c)
        for c, fn in measures.items()])
