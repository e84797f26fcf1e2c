"""Counters of running streams.

``DataFrame.observe`` names aggregates that Spark works out while a batch runs; a
:class:`Counters` listener adds them up over the batches of every query that
runs in the session and gives them as a table.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener


class Counters(StreamingQueryListener):
    """``with Counters(spark) as c: ...`` then ``c.table()``."""

    def __init__(self, spark: SparkSession):
        super().__init__()
        self.spark, self.totals = spark, {}
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._lock:
            for name, row in event.progress.observedMetrics.items():
                for counter, value in row.asDict().items():
                    self.totals[name, counter] = self.totals.get((name, counter), 0) + (value or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def wait(self, seconds: int = 60) -> None:
        """Until the events of the batches so far have arrived (they come later than the batches)."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(seconds * 1000)

    def table(self) -> DataFrame:
        """(name, counter, value), one row per observed counter."""
        rows = [(n, c, int(v)) for (n, c), v in sorted(self.totals.items())]
        return self.spark.createDataFrame(rows, "name string, counter string, value long")

    def __enter__(self) -> Counters:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        self.wait()
        self.spark.streams.removeListener(self)
