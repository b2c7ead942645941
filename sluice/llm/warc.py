"""WARC archives, index first (operator 13).

Writing: tasks append gzip members, one a record, to archives of bounded size in a shared folder, and return for each
record its archive, offset, length, URL and digest.  Spark writes these rows as the index, with its commit protocol.
The index is also the manifest: archives have names of their own for every attempt of a task, and those of an attempt
that was lost stand in no index row, so nobody reads them.

Equal payloads are found by their SHA-256 before anything is written: counts and least page ids are summed by map tasks,
and only digests that occur several times are kept.  They are measured; as a small table they go to the tasks and pages
stay where they are, beyond that pages and digests meet by hash.

Reading: the selected index rows are sorted by archive and offset, neighbours with small gaps are joined into byte
ranges of bounded size, and each range is one read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.common import text_slices, written

INDEX = "page_id long, url string, record_type string, refers_to long, archive string, offset long, length long, payload_bytes long, payload_digest string"
_INDEX = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("archive", pa.string()),
                    ("offset", pa.int64()), ("length", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
_READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                   ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = b"WARC/1.1"
_END = b"\r\n\r\n"


def write_warc(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = 100,
               archive_bytes: int = 256 << 20, date: str = "1970-01-01T00:00:00Z", broadcast_bytes: int = 16 << 20) -> DataFrame:
    """Archives of all rows below ``path``, a folder that all executors share; returns their index, read from there.

    A null payload is empty.  Of rows with equal payloads of at least ``least`` bytes those with the smallest page id are
    responses, the others revisits of it; all shorter ones are responses.  Repeated rows of the smallest id are all
    responses; a row without an id revisits one with an id, and where none has an id all are responses.  Every row has
    its own record; other columns are ignored, an empty table gives an empty index.  ``date`` is the records' WARC-Date.
    The folder is one that pyarrow opens (a local path, ``file:``, ``hdfs:``, ``s3:``, ``gs:``)."""
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), body.alias("payload"))
    rows = rows.withColumns({"payload_digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long")})
    several = rows.where(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    several = written(several.select("payload_digest", "first"), "equal-payloads")
    if several.count() * 160 <= broadcast_bytes:  # a digest and an id a row
        several = F.broadcast(several)
    revisit = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    told = rows.join(several, "payload_digest", "left").withColumn("refers_to", F.when(revisit, F.col("first")))
    told = told.select("page_id", "url", "refers_to", "payload_digest", "payload_bytes", F.when(~revisit | revisit.isNull(), F.col("payload")).alias("payload"))
    told.mapInArrow(_writer(path, archive_bytes, date), INDEX).write.option("compression", "zstd").parquet(f"{path}/index")
    return read_index(pages.sparkSession, path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row a record: page_id, url, record_type, refers_to, archive, offset, length, payload_bytes, payload_digest."""
    return spark.read.schema(INDEX).parquet(f"{path}/index")


def with_referred(selected: DataFrame, index: DataFrame) -> DataFrame:
    """The selected rows of an index and those of the responses that its revisits refer to, each once."""
    wanted = selected.where("record_type = 'revisit'").select(F.col("refers_to").alias("page_id"), "payload_digest").distinct()
    return selected.unionByName(index.where("record_type = 'response'").join(wanted, ["page_id", "payload_digest"], "left_semi")).dropDuplicates(["archive", "offset"])


def read_warc(selected: DataFrame, path: str, payload: bool = True, gap: int = 64 << 10, range_bytes: int = 8 << 20, task_bytes: int = 64 << 20) -> DataFrame:
    """The records of index rows: (page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload).

    Everything comes from the archives: the payload's length and digest are those of the bytes read (of a revisit, which
    holds no payload, those that its record states; its payload is null).  A record that does not have the digest it
    states is an error.  URLs are as the records hold them, with white space, control characters and non-ASCII
    characters percent-encoded.  Without ``payload`` that column is left out.

    Records less than ``gap`` bytes apart share a read of at most about ``range_bytes``; a task reads about
    ``task_bytes``.  An archive has a bounded size, so the sort of its rows is bounded too."""
    spark = selected.sparkSession
    by = Window.partitionBy("archive").orderBy("offset")
    before = F.lag(F.col("offset") + F.col("length")).over(by)
    at = selected.select("archive", "offset", "length")
    at = at.withColumn("cut", (before.isNull() | (F.col("offset") - before > gap)).cast("long"))
    at = at.withColumns({"run": F.sum("cut").over(by), "piece": F.floor(F.col("offset") / range_bytes)})
    ranges = at.groupBy("archive", "run", "piece").agg(F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("records"))
    total = selected.agg(F.sum("length")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // task_bytes))
    ranges = ranges.select("archive", "records").repartition(tasks).sortWithinPartitions("archive", F.col("records")[0]["offset"])
    schema = pa.schema([f for f in _READ if payload or f.name != "payload"])
    columns = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"
    return ranges.mapInArrow(_reader(path, schema), columns + ", payload binary" * payload)


def _folder(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub("^s3a:", "s3:", re.sub("^file:/+", "/", path)))


def record_id(page_id: int | None, digest: str) -> str:
    """The record of a page and payload."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}')}>"


def _safe(url: str) -> str:
    """A URL that fits a header line."""
    return re.sub(r"[^\x21-\x7e]+", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


def record(page_id: int | None, url: str | None, payload: bytes | None, digest: str, n_bytes: int, refers_to: int | None, date: str) -> bytes:
    """An uncompressed record: a response, or without payload a revisit of page ``refers_to``, whose block is the HTTP head."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = {"WARC-Type": "response" if payload is not None else "revisit", "WARC-Record-ID": record_id(page_id, digest), "WARC-Date": date,
            "WARC-Target-URI": None if url is None else _safe(url), "WARC-Payload-Digest": f"sha256:{digest}", "WARC-Page-ID": page_id}
    if payload is None:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers_to, digest), "WARC-Refers-To-Page-ID": refers_to}
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": len(block)}
    lines = [f"{k}: {v}".encode() for k, v in head.items() if v is not None]
    return b"\r\n".join([VERSION, *lines]) + _END + block + _END


def parsed(raw: bytes) -> dict:
    """What a record says; its payload's length and digest are those of its bytes."""
    head, _, rest = raw.partition(_END)
    version, *lines = head.split(b"\r\n")
    said = {k.lower(): v.strip() for k, _, v in (x.decode().partition(":") for x in lines)}
    block = rest[:int(said["content-length"])]
    if not version.startswith(b"WARC/") or len(block) != int(said["content-length"]) or rest[len(block):] != _END:
        raise ValueError("no whole WARC record at this place")
    http, _, payload = block.partition(_END)
    digest = said["warc-payload-digest"].removeprefix("sha256:")
    number = lambda k: int(said[k]) if k in said else None
    out = {"page_id": number("warc-page-id"), "url": said.get("warc-target-uri"), "record_type": said["warc-type"], "refers_to": number("warc-refers-to-page-id")}
    if out["record_type"] == "revisit":
        length = int(re.search(rb"(?i)\r\ncontent-length: *([0-9]+)", http)[1])
        return out | {"payload_bytes": length, "payload_digest": digest, "payload": None}
    own = hashlib.sha256(payload).hexdigest()
    if own != digest:
        raise ValueError(f"payload of record {said['warc-record-id']} does not have its digest")
    return out | {"payload_bytes": len(payload), "payload_digest": own, "payload": payload}


def _member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _writer(path: str, archive_bytes: int, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _folder(path)
        out, name, size = None, "", 0
        try:
            for batch in text_slices(batches, "payload"):
                rows: list[dict] = []
                for r in batch.to_pylist():
                    raw = _member(record(r["page_id"], r["url"], r["payload"], r["payload_digest"], r["payload_bytes"], r["refers_to"], date))
                    if out is None or size + len(raw) > archive_bytes:
                        if out is not None:
                            out.close()
                        store.create_dir(f"{root}/archives", recursive=True)
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        out = store.open_output_stream(f"{root}/archives/{name}", compression=None)
                        info = b"software: sluice\r\nformat: WARC File Format 1.1\r\n"
                        first = b"\r\n".join([VERSION, b"WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>".encode(), f"WARC-Date: {date}".encode(),
                                              f"WARC-Filename: {name}".encode(), b"Content-Type: application/warc-fields", f"Content-Length: {len(info)}".encode()])
                        start = _member(first + _END + info + _END)
                        out.write(start)
                        size = len(start)
                    out.write(raw)
                    kind = "response" if r["payload"] is not None else "revisit"
                    rows.append({c: r.get(c) for c in _INDEX.names} | {"record_type": kind, "archive": name, "offset": size, "length": len(raw)})
                    size += len(raw)
                yield pa.RecordBatch.from_pylist(rows, schema=_INDEX)
        finally:
            if out is not None:
                out.close()
    return write


def _reader(path: str, schema: pa.Schema, most: int = 4 << 20):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _folder(path)
        held, opened = None, ""
        try:
            for batch in batches:
                for i in range(batch.num_rows):
                    archive, records = batch.column("archive")[i].as_py(), batch.column("records")[i].as_py()
                    if archive != opened:
                        if held is not None:
                            held.close()
                        held, opened = store.open_input_file(f"{root}/archives/{archive}"), archive
                    start = records[0]["offset"]
                    data = held.read_at(records[-1]["offset"] + records[-1]["length"] - start, start)
                    rows, size = [], 0
                    for r in records:
                        at = r["offset"] - start
                        got = parsed(zlib.decompress(data[at:at + r["length"]], 31))
                        rows.append({c: got[c] for c in schema.names})
                        size += got["payload_bytes"]
                        if size > most:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
        finally:
            if held is not None:
                held.close()
    return read
