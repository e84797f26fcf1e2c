"""Labelled rows for the classifiers, and the rows held out from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendspark.llm.scratch import written


def held_out(id_col: str, parts: int, part: int) -> Column:
    """Whether crc32(id as text) mod ``parts`` is ``part``; false for a null id."""
    rest = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts))
    return F.coalesce(rest == part, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, *, id_col: str, text_col: str, parts: int, part: int,
                  sample: int) -> DataFrame:
    """(text, label 0/1) of labelled rows that are not held out, written to the
    shared folder.

    About ``sample`` labels at most are taken, by a hash of the id; that bound
    is what lets them be broadcast, so the texts are not shuffled.  Labels that
    are null or not 0 or 1, null ids and null texts are left out; an id with
    several labels gives a row for each.
    """
    known = (labels.select(F.col(id_col).alias("__id"), F.col(label).cast("int").alias("label"))
             .where("__id is not null and label in (0, 1)").where(~held_out("__id", parts, part)))
    n = known.count()
    if n > sample:
        known = known.where(F.pmod(F.xxhash64("__id"), F.lit(1 << 20)) < int(sample / n * (1 << 20)))
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    return written(rows.join(F.broadcast(known), "__id").select("text", "label"), "labelled")
