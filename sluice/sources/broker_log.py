"""Landed deliveries as a stream with per-queue admission.

A push broker hands a consumer at most ``prefetch`` unacknowledged messages of a queue.  The file source can only bound
files, so deliveries are read by a Data Source of their own: its offset is the last delivery tag of every queue, and a
micro-batch takes at most ``prefetch`` deliveries of each.

``land`` writes deliveries below ``<path>/_queue=<queue>/``, sorted by tag, in several files for a large queue.  Files
and their row groups are of bounded size, so what a micro-batch reads does not grow with the queue.  Tags
rise within a queue; a delivery that lands later with a tag that has been passed is not read.  Deliveries of one tag
(a redelivery) are admitted together.

The driver reads file footers and, once, the tags of the next files of a queue, never bodies; tasks read the admitted range of
a file each.  Spark asks such a source for its latest offset without saying where it stands, so the reader keeps the end
of the last planned batch in ``progress``, a file next to the query's checkpoint, and goes on from there after a restart.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sluice.config import PipelineConfig
from sluice.sources import files
from sluice.sources.landed import RECORDS, TO_ENVELOPE

#: The queue and the rising number of a delivery, by protocol.
KEYS = {"amqp": ("queue", "delivery_tag"), "jms": ("destination", "seq"), "mqtt": ("topic", "seq"), "kestrel": ("queue", "id")}
#: Deliveries of a file and bytes of a row group at most: a micro-batch opens few files of a queue and reads few row groups.
FILE_ROWS = 1 << 17
ROW_GROUP_BYTES = 1 << 20
_NO_QUEUE = "__HIVE_DEFAULT_PARTITION__"


def land(records: DataFrame, path: str, protocol: str, parts: int | None = None) -> None:
    """Deliveries (``landed.RECORDS[protocol]``) at the end of a log.  Those without a queue name are a queue of their
    own; those without a tag are refused by the broker and do not land."""
    queue, tag = KEYS[protocol]
    n = parts or int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = records.where(F.col(tag).isNotNull()).withColumn("_queue", F.col(queue))
    bounds = {"maxRecordsPerFile": FILE_ROWS, "parquet.block.size": ROW_GROUP_BYTES}
    rows.repartitionByRange(n, "_queue", tag).sortWithinPartitions("_queue", tag).write.mode("append").options(**bounds).partitionBy("_queue").parquet(path)


def read_stream(spark: SparkSession, path: str, config: PipelineConfig, progress: str) -> DataFrame:
    """A landed log as a stream of ENVELOPE rows, admitted as ``config`` says."""
    spark.dataSource.register(LandedLog)
    reader = spark.readStream.format("landed_log").option("log", path).option("protocol", config.protocol).option("progress", progress)
    return TO_ENVELOPE[config.protocol](reader.options(**config.admission()).load())


class LandedLog(DataSource):
    """Options: ``log`` (the folder), ``protocol``, ``prefetch`` (deliveries of a queue in a micro-batch), ``progress``."""

    @classmethod
    def name(cls) -> str:
        return "landed_log"

    def schema(self) -> StructType:
        return RECORDS[self.options["protocol"]]

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return LandedReader(self.options["log"], self.options["protocol"], int(self.options["prefetch"]), self.options["progress"], schema)


class Slice(InputPartition):
    """The deliveries of a file with start < tag <= end."""

    def __init__(self, path: str, start: int | None, end: int):
        self.path, self.start, self.end = path, start, end


class LandedReader(DataSourceStreamReader):
    def __init__(self, log: str, protocol: str, prefetch: int, progress: str, schema: StructType):
        if prefetch < 1:
            raise ValueError("prefetch must be positive")
        self.log, self.prefetch, self.progress = log, prefetch, progress
        self.tag = KEYS[protocol][1]
        self.arrow = to_arrow_schema(schema)
        self.spans: dict[str, tuple[int, int]] = {}
        self.tags: dict[str, np.ndarray] = {}
        self.at: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """The end of the next micro-batch: for each queue the tag of its ``prefetch``-th delivery from here."""
        store, root = files.opened(self.log)
        if self.at is None:
            store2, place = files.opened(self.progress)
            self.at = json.loads(files.content(store2, place) or b"{}")
        end = dict(self.at)
        for folder in files.names(store, root, fs.FileType.Directory):
            if "/_queue=" in folder:
                queue = unquote(folder.rsplit("/_queue=", 1)[1])
                to = self._admitted(store, folder, self.at.get(queue))
                if to is not None:
                    end[queue] = to
        return dict(sorted(end.items()))

    def _span(self, store: fs.FileSystem, path: str) -> tuple[int, int]:
        """Least and largest tag of a file, from its footer."""
        if path not in self.spans:
            meta = pq.ParquetFile(path, filesystem=store).metadata
            column = meta.schema.names.index(self.tag)
            stats = [meta.row_group(i).column(column).statistics for i in range(meta.num_row_groups)]
            self.spans[path] = (min(s.min for s in stats), max(s.max for s in stats))
        return self.spans[path]

    def _next_tags(self, store: fs.FileSystem, path: str, start: int | None) -> np.ndarray:
        """The least tags above ``start`` of a file, one more than a micro-batch takes.  A file's tags are read once and
        kept until it has been passed."""
        if path not in self.tags:
            self.tags[path] = np.sort(pq.read_table(path, columns=[self.tag], filesystem=store, partitioning=None).column(0).to_numpy())
        own = self.tags[path]
        first = 0 if start is None else int(np.searchsorted(own, start, side="right"))
        return own[first:first + self.prefetch + 1]

    def _admitted(self, store: fs.FileSystem, folder: str, start: int | None) -> int | None:
        """The last tag of a queue's next ``prefetch`` deliveries; None if there are none."""
        after = []
        for f in files.names(store, folder):
            if f.endswith(".parquet"):
                span = self._span(store, f)
                if start is None or span[1] > start:
                    after.append((span, f))
                else:
                    self.tags.pop(f, None)
        tags = np.zeros(0, np.int64)
        for (low, _), path in sorted(after):
            if len(tags) > self.prefetch and np.partition(tags, self.prefetch)[self.prefetch] < low:
                break  # what follows lies beyond
            tags = np.concatenate((tags, self._next_tags(store, path, start)))
        tags.sort()
        if len(tags) <= self.prefetch:
            return int(tags[-1]) if len(tags) else None
        last = tags[self.prefetch - 1]
        if tags[self.prefetch] == last and tags[0] < last:  # deliveries of one tag stay together
            last = tags[np.searchsorted(tags, last) - 1]
        return int(last)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        store, root = files.opened(self.log)
        out: list[InputPartition] = []
        for folder in files.names(store, root, fs.FileType.Directory):
            queue = unquote(folder.rsplit("/_queue=", 1)[-1])
            low, high = start.get(queue), end.get(queue)
            if high is None or low is not None and low >= high:
                continue
            for f in files.names(store, folder):
                if f.endswith(".parquet"):
                    least, most = self._span(store, f)
                    if least <= high and (low is None or most > low):
                        out.append(Slice(f, low, high))
        self.at = dict(end)
        store, place = files.opened(self.progress)
        files.write_whole(store, place, json.dumps(self.at, sort_keys=True).encode())
        return out

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        store, _ = files.opened(self.log)
        wanted = [(self.tag, "<=", partition.end)] + ([(self.tag, ">", partition.start)] if partition.start is not None else [])
        rows = pq.read_table(partition.path, columns=self.arrow.names, filters=wanted, filesystem=store, partitioning=None)
        yield from rows.cast(self.arrow).to_batches(max_chunksize=10_000)
