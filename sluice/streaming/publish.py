"""Publish records written exactly once, by a Data Source writer with a staged commit.

Tasks write files of their own; what they wrote is told to the driver, which publishes a micro-batch by one small
manifest, ``<path>/_published/<writer>/<batch>.json``.  Readers take the files that manifests name, so a task that was
killed, a batch that was aborted, or a batch that is being written shows nothing.  A batch that Spark runs again after
it was published finds its manifest and leaves it.  ``writer`` names the stream, so several can publish into one folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from sluice.sources import files


class BrokerRecords(DataSource):
    """Options: ``folder``, ``writer``."""

    @classmethod
    def name(cls) -> str:
        return "broker_records"

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return StagedWriter(self.options["folder"], self.options["writer"])


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    rows: int


class StagedWriter(DataSourceStreamArrowWriter):
    def __init__(self, folder: str, writer: str):
        self.folder, self.writer = folder, writer

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root = files.opened(self.folder)
        name, out, rows = f"{uuid.uuid4().hex}.parquet", None, 0
        try:
            for batch in iterator:
                if batch.num_rows:
                    if out is None:
                        store.create_dir(f"{root}/records", recursive=True)
                        out = pq.ParquetWriter(f"{root}/records/{name}", batch.schema, filesystem=store)
                    out.write_batch(batch)
                    rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
        return Written(name if rows else None, rows)

    def _manifest(self, batch: int) -> tuple[fs.FileSystem, str, str]:
        store, root = files.opened(self.folder)
        return store, root, f"{root}/_published/{self.writer}/{batch}.json"

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        store, root, place = self._manifest(batchId)
        if files.content(store, place) is not None:  # published before the last stop
            self._discard(store, root, messages)
            return
        made = sorted(m.file for m in messages if m is not None and m.file)
        files.write_whole(store, place, json.dumps({"files": made, "rows": sum(m.rows for m in messages if m is not None)}).encode())

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        store, root, _ = self._manifest(batchId)
        self._discard(store, root, messages)

    @staticmethod
    def _discard(store: fs.FileSystem, root: str, messages: list[WriterCommitMessage | None]) -> None:
        for m in messages:
            if m is not None and m.file:
                store.delete_file(f"{root}/records/{m.file}")


def publish(records: DataFrame, folder: str, writer: str) -> DataStreamWriter:
    """A stream writer that publishes ``records`` in ``folder``; start it with a checkpoint location."""
    records.sparkSession.dataSource.register(BrokerRecords)
    return records.writeStream.format("broker_records").option("folder", folder).option("writer", writer).outputMode("append")


def published(spark: SparkSession, folder: str, schema: StructType, writer: str | None = None) -> DataFrame:
    """The published records of a folder, of one writer or of all."""
    store, root = files.opened(folder)
    writers = [f"{root}/_published/{writer}"] if writer else files.names(store, f"{root}/_published", fs.FileType.Directory)
    made = [f for w in writers for m in files.names(store, w) if m.endswith(".json") for f in json.loads(files.content(store, m))["files"]]
    base = folder.rstrip("/")
    return spark.read.schema(schema).parquet(*[f"{base}/records/{f}" for f in made]) if made else spark.createDataFrame([], schema)
