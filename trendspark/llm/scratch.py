"""Intermediate tables in the shared folder that the cluster names.

A table written there cuts the lineage: a job whose executors are lost reads
the table again instead of recomputing what led to it.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from trendspark.session import checkpoint_root

#: A side is broadcast only if it was counted and holds at most so many bytes.
BROADCAST_BYTES = 32 << 20
#: Shuffle files of a query go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; Spark's writers make it."""
    return f"{checkpoint_root(spark)}/trendspark-llm/{name}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written as Parquet (with the writer's ``options``) to the shared
    folder and read back.

    The shuffles that led to it are removed with the end of the write: nothing
    reads them again, and they would stay until the driver's heap is collected.
    """
    spark, path = df.sparkSession, folder(df.sparkSession, name)
    with _set(spark, CLEANUP, "true"):
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt and sorted by ``key`` and checkpointed in the shared folder:
    what groups it by the key need not shuffle it again.

    Only a plan that is not adaptive tells a checkpoint how its rows are dealt.
    """
    spark = df.sparkSession
    checkpoint_root(spark)  # names the folder where none is set
    with _set(spark, "spark.sql.adaptive.enabled", "false"):
        rows = df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), key).sortWithinPartitions(key)
        kept = rows.checkpoint()
        rows._jdf.queryExecution().toRdd().cleanShuffleDependencies(True)
    return kept


def fits(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` (a written table: counting it is cheap) is at most
    ``limit`` bytes at ``row_bytes`` a row, so that it may be broadcast."""
    return df.count() * row_bytes <= limit
