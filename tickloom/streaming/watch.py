"""Watching queries: jobs that stand together, counts that a stream reports, and the state it keeps."""

from __future__ import annotations

import json
import threading
import time
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


class Job(StreamingQueryListener):
    """Queries that belong together: when one fails the others are stopped, and the job names it.

    Use it in a `with` block, or call `close`, so that the listener goes with the job.
    """

    def __init__(self, spark: SparkSession, queries: list[StreamingQuery]):
        self.spark, self.queries = spark, list(queries)
        self.failure: tuple[str, str] | None = None  # name or id of the query, and what Spark says
        self._names = {str(q.id): q.name or str(q.id) for q in self.queries}
        self._ended = {str(q.id): threading.Event() for q in self.queries}
        spark.streams.addListener(self)
        for q in self.queries:  # one may have ended before anyone listened
            if not q.isActive:
                self._over(str(q.id), q.exception() and str(q.exception()))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.id) in self._ended:
            self._over(str(event.id), event.exception)

    def _over(self, query: str, exception: str | None) -> None:
        if exception and self.failure is None:
            self.failure = (self._names[query], exception)
            # Stopping waits for queries to end, which the thread that tells of it must not.
            threading.Thread(target=self.stop, daemon=True).start()
        self._ended[query].set()

    def wait(self, seconds: float | None = None) -> bool:
        """Until each query has ended: True, or False when the time is over. Raises if one failed."""
        until = None if seconds is None else time.monotonic() + seconds
        for ended in self._ended.values():
            if not ended.wait(None if until is None else max(0.0, until - time.monotonic())):
                return False
        return self._checked()

    def wait_any(self, seconds: float | None = None) -> bool:
        """Until one of the queries has ended: True, or False when the time is over. Raises if it failed."""
        until = None if seconds is None else time.monotonic() + seconds
        while not any(e.is_set() for e in self._ended.values()):
            if until is not None and time.monotonic() >= until:
                return False
            time.sleep(0.05)
        return self._checked()

    def _checked(self) -> bool:
        if self.failure:
            raise RuntimeError("query {} failed: {}".format(*self.failure))
        return True

    def stop(self) -> None:
        for q in self.queries:
            if q.isActive:
                q.stop()

    def close(self) -> None:
        self.stop()
        self.spark.streams.removeListener(self)

    def __enter__(self) -> Job:
        return self

    def __exit__(self, *_) -> None:
        self.close()


class Observed(StreamingQueryListener):
    """Adds up the numbers that queries report under one name by `DataFrame.observe`."""

    def __init__(self, name: str):
        self.name, self.total, self.batches = name, Counter(), 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            self.batches += 1
            self.total.update({k: v or 0 for k, v in row.asDict().items()})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def watermark_of_batch(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The watermark, in milliseconds, that a query holds its batch against, from its offset log."""
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/offsets/{batch_id}")
    return json.loads(lines.filter(F.col("value").contains("batchWatermarkMs")).first()[0])["batchWatermarkMs"]


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What operators of a query keep state, by Spark's reader of the checkpoint's metadata."""
    return spark.read.format("state-metadata").load(checkpoint)


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0, **options) -> DataFrame:
    """(key, value, partition_id) as the last committed batch left them; `options` as of Spark's reader, such as joinSide."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    return reader.options(**options).load(checkpoint)


def state_by_partition(spark: SparkSession, checkpoint: str, operator: int = 0, **options) -> DataFrame:
    """(partition_id, rows): how evenly an operator's state lies."""
    rows = state_rows(spark, checkpoint, operator, **options)
    return rows.groupBy("partition_id").agg(F.count("key").alias("rows"))


def largest_keys(spark: SparkSession, checkpoint: str, columns: list[str], operator: int = 0, most: int = 10, **options) -> DataFrame:
    """(*columns, rows): the values of key columns with most rows of state, the largest first."""
    rows = state_rows(spark, checkpoint, operator, **options)
    keys = rows.select(*[F.col("key")[c].alias(c) for c in columns])
    return keys.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), *columns).limit(most)
