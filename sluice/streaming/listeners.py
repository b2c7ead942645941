"""What runs beside a stream: commits at a cadence (A4) and a stop on too many failures (A5, U4).

Both are query listeners, called by Spark after every micro-batch, and hold a few numbers; the work they start is a
Spark job over tables that the stream wrote, or a stop.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyarrow.fs import FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from sluice.functions.scalars import saved_offset_json
from sluice.operators.offsets import DEFAULT_COMMIT_INTERVAL_MS, commit_changes
from sluice.sources import files


class SavedOffsets:
    """Saved-offset documents (P14) as versions of a table: (partition, saved_offset, document).

    A commit writes the next version, and only if it is not there: who finds it reads again and goes on from what the
    other one saved.  Looking and writing are two steps, so a stream has one committer; this guards it from a stale one."""

    def __init__(self, spark: SparkSession, folder: str, topology_id: str, topology_name: str, broker_host: str, broker_port: int, topic: str):
        self.spark, self.folder = spark, folder
        self.document = lambda p, o: saved_offset_json(F.lit(topology_id), F.lit(topology_name), o, p, F.lit(broker_host), F.lit(broker_port), F.lit(topic))
        store, root = files.opened(folder)
        self.version = max((int(f.rsplit("=", 1)[1]) for f in files.names(store, root, FileType.Directory) if "version=" in f), default=0)

    def read(self, version: int | None = None) -> DataFrame:
        at = self.version if version is None else version
        if at == 0:
            return self.spark.createDataFrame([], "partition int, saved_offset long, document string")
        return self.spark.read.parquet(f"{self.folder}/version={at}")

    def commit(self, points: DataFrame) -> bool:
        """Write the points (partition, commit_offset) that differ from what is saved; False if none does."""
        while True:
            saved = self.read()
            changed = commit_changes(points, saved.select("partition", "saved_offset")).select("partition", F.col("commit_offset").alias("saved_offset"))
            if changed.isEmpty():
                return False
            changed = changed.withColumn("document", self.document(F.col("partition"), F.col("saved_offset")))
            after = saved.join(changed, "partition", "left_anti").unionByName(changed)
            try:
                after.write.mode("errorifexists").parquet(f"{self.folder}/version={self.version + 1}")
            except Exception as e:
                if "PATH_ALREADY_EXISTS" not in str(e):
                    raise
                self.version += 1  # somebody else's commit
                continue
            self.version += 1
            return True


class CommitCadence(StreamingQueryListener):
    """A4: commits the points that a query has reached, at most every ``interval_ms`` and when it ends.

    It follows the first query that starts after it was added.  ``points`` gives (partition, commit_offset) after a
    micro-batch.  ``committed`` lists the batches whose points were written; an error is kept as ``failure``."""

    def __init__(self, saved: SavedOffsets, points: Callable[[int], DataFrame], interval_ms: int = DEFAULT_COMMIT_INTERVAL_MS,
                 clock: Callable[[], float] = time.monotonic):
        self.saved, self.points, self.interval_ms, self.clock = saved, points, interval_ms, clock
        self.last_ms, self.run, self.batch = 0.0, None, -1
        self.committed: list[int] = []
        self.failure: Exception | None = None

    def _commit(self) -> None:
        try:
            if self.batch >= 0 and self.saved.commit(self.points(self.batch)):
                self.committed.append(self.batch)
        except Exception as e:
            self.failure = e

    def onQueryStarted(self, event) -> None:
        if self.run is None:
            self.run, self.last_ms = event.runId, self.clock() * 1000

    def onQueryProgress(self, event) -> None:
        if event.progress.runId != self.run:
            return
        self.batch = event.progress.batchId
        now = self.clock() * 1000
        if now - self.last_ms >= self.interval_ms:
            self.last_ms = now
            self._commit()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.run:
            self._commit()


def heard(spark: SparkSession) -> None:
    """Wait until the listeners have been told all that has happened."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()


LEDGER_METRICS = "ledger_counts"


def observed(outcomes: DataFrame, acked: F.Column, failed: F.Column) -> DataFrame:
    """``outcomes`` with the numbers of acked and failed rows of every micro-batch as an observation (U4)."""
    return outcomes.observe(LEDGER_METRICS, F.count_if(acked).alias("acked"), F.count_if(failed).alias("failed"))


class FailureGuard(StreamingQueryListener):
    """A5: stops a query when more than ``most_failed`` messages have failed while none has been acked.

    Counts come from ``observed``, of the first query that starts after it was added; ``reason`` says why it was
    stopped."""

    def __init__(self, spark: SparkSession, most_failed: int):
        self.spark, self.most_failed = spark, most_failed
        self.run = None
        self.acked = self.failed = 0
        self.reason: str | None = None

    def onQueryStarted(self, event) -> None:
        if self.run is None:
            self.run = event.runId

    def onQueryProgress(self, event) -> None:
        counts = event.progress.observedMetrics.get(LEDGER_METRICS) if event.progress.runId == self.run else None
        if counts is not None and self.reason is None:
            self.acked += counts["acked"]
            self.failed += counts["failed"]
            if self.acked == 0 and self.failed > self.most_failed:
                self.reason = f"{self.failed} messages failed and none was acked"
                for q in self.spark.streams.active:
                    if str(q.runId) == str(self.run):
                        threading.Thread(target=q.stop).start()  # a stop waits for the listeners, so not from one

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
