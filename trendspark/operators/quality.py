"""Counts, coverage and counters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """A4: (table_name, n_rows) for every table — one count job per table,
    combined with a union (each count is a partial aggregate per task)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def uncovered(expected: DataFrame, observed: DataFrame, key: str,
              observed_key: str | None = None) -> DataFrame:
    """Rows of ``expected`` with no match in ``observed`` (anti-join).

    Observed keys are de-duplicated first (partial aggregate, map-side), so a
    key that holds a large share of the observations is one row when it
    reaches the join, not a buffer in one task.
    """
    ok = observed_key or key
    obs = observed.select(F.col(ok).alias(key)).where(F.col(key).isNotNull()).distinct()
    return expected.join(obs, key, "left_anti")


def coverage_summary(expected: DataFrame, observed: DataFrame, key: str,
                     observed_key: str | None = None) -> DataFrame:
    """One row: total, covered and missing counts (success / total tally)."""
    ok = observed_key or key
    hits = observed.select(F.col(ok).alias(key)).where(F.col(key).isNotNull()).distinct() \
        .withColumn("_hit", F.lit(1))
    j = expected.select(key).join(hits, key, "left")
    return j.agg(F.count("*").alias("total"), F.count("_hit").alias("covered"),
                 (F.count("*") - F.count("_hit")).alias("missing"))


#: Observations of a task that finds the distinct ones.
ROWS_A_TASK = 1_000_000


def coverage_by_day(expected: DataFrame, observed: DataFrame, key: str, observed_key: str, day: str) -> DataFrame:
    """(day, total, covered, missing) of every day with an observation; only
    expected keys count, and each once a day.

    The distinct (key, day) pairs are hardly fewer than the rows, and their
    compressed shuffle says little about their size in memory, so partitions
    merged by bytes hold millions: the rows are counted first and dealt to as
    many tasks as they need.  (An inner join, as keys are distinct: a
    semi-join would be moved below the distinct, and by key alone.)
    """
    keys = expected.select(F.col(key).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    total = expected.agg(F.count(F.lit(1))).scalar()
    pairs = observed.select(F.col(observed_key).alias("_k"), day).where(F.col("_k").isNotNull())
    tasks = 1 + pairs.count() // ROWS_A_TASK
    seen = (pairs.repartition(tasks, "_k", day).distinct().join(keys, "_k")
            .groupBy(day).agg(F.count(F.lit(1)).alias("covered")))
    return seen.select(day, total.alias("total"), "covered", (total - F.col("covered")).alias("missing"))


def with_counters(df: DataFrame, name: str, **exprs) -> tuple[DataFrame, Observation]:
    """Attach named counters computed while the job runs (no extra pass).

    ``exprs`` maps counter names to aggregate Columns; the row count is always
    included.  Read ``observation.get`` after an action on the returned frame.
    """
    obs = Observation(name)
    aggs = [F.count(F.lit(1)).alias("rows")] + [e.alias(k) for k, e in exprs.items()]
    return df.observe(obs, *aggs), obs
