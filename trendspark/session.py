"""Session set-up shared by jobs, tests and the bench.

Dates in the data model are UTC (a post's date is the UTC day of its epoch
stamp), so the session time zone is pinned.  Streaming state lives in
RocksDB rather than on the JVM heap.  AQE stays on: it coalesces
small shuffle partitions, converts joins to broadcast when a side turns out
small at run time, and splits skewed join partitions.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows that go to a Python worker at a time: texts may be long, and a batch
    # is held by the JVM and the worker at once.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # Streaming dedup/window state off the JVM heap (it grows with the key
    # count); the provider is recorded in each query's checkpoint.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every job relies on (idempotent)."""
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)
    return spark


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "trendspark") -> SparkSession:
    """Return the active session, or build one (local mode for tests/bench).

    On a cluster the session normally exists already; we only apply the
    runtime settings.  ``master`` is used only when a new session is built.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        spark = active
    else:
        b = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false"))
        if master:
            b = b.master(master)
            if master.startswith("local"):
                # local mode: the driver JVM is the executor, its heap is the
                # only memory knob (default 1 GB is too small for text work)
                b = b.config("spark.driver.memory", os.environ.get("TRENDSPARK_DRIVER_MEMORY", "8g"))
        for k, v in SESSION_CONF.items():
            b = b.config(k, v)
        if shuffle_partitions:
            b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        spark = b.getOrCreate()
        try:
            spark.sparkContext.setLogLevel("ERROR")
        except Exception:
            pass
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session.  Only when it is unset in local mode (tests) do we
    pick a folder ourselves and register it, so ``DataFrame.checkpoint()``
    works too; on a cluster an unset value is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = spark.conf.get("spark.master", "") or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (HDFS or an "
                               "object store); a machine-local folder is not safe on a cluster")
        root = tempfile.mkdtemp(prefix="trendspark-ckpt-")  # local mode only (tests)
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the checkpoint root for job output."""
    root = checkpoint_root(spark)
    path = f"{root}/trendspark/{name}-{uuid.uuid4().hex[:12]}"
    if "://" not in path:
        os.makedirs(path, exist_ok=True)
    return path
