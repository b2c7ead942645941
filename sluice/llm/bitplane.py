"""Token files by bit-plane shuffling (operator 5).

A file holds segments of whole documents.  The ids of a segment are cut into blocks of a fixed number of
ids; a block is transposed into planes, by byte (plane j holds byte j of every id) or by bit, and each plane
is compressed with zstandard by itself.  High planes of a vocabulary are all zero and cost a few bytes.

The container is a Parquet table that Spark writes, one row a segment, so any store that Spark reaches holds
it and a lost task is written again.  A row carries its chunk index: the places of its documents and, for
each block, the number of ids and the sizes of the planes.  ``read_index`` reads that index alone.

Documents are range-partitioned by id, or by an order column, and sorted, so files are in that order.  No document crosses
a segment: files are read back in any split, without a shuffle.  The place of a segment among all ids is the
number of ids of earlier parts (a table of one row a part) plus its place in its part.
"""

from __future__ import annotations

import struct
import unicodedata
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.common import text_slices

BLOCK = 1 << 16
SEGMENT = 1 << 18
SCHEMA = ("part int, segment long, start_in_part long, n_ids long, planes string, doc_ids array<long>, "
          "doc_sizes array<long>, block_sizes array<int>, plane_bytes array<array<int>>, data binary")
#: Words of one generation that a worker remembers.
_MEMORY = 300_000
#: Rows of an Arrow batch of texts, and bytes of text that are encoded at once: a worker holds one of each.
_ROWS, _TEXT = 500, 2 << 20


def to_planes(ids: np.ndarray, planes: str = "byte") -> list[bytes]:
    """The planes of a block of ids below 2^32, lowest first."""
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        return [raw[:, j].tobytes() for j in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, j], bitorder="little").tobytes() for j in range(32)]


def from_planes(parts: list[bytes], n: int, planes: str = "byte") -> np.ndarray:
    if planes == "byte":
        raw = np.stack([np.frombuffer(p, np.uint8) for p in parts], axis=1) if n else np.zeros((0, 4), np.uint8)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), bitorder="little")[:n] for p in parts], axis=1)
        raw = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


def pack(ids: np.ndarray, planes: str, level: int) -> tuple[list[int], list[list[int]], bytes]:
    """(ids in each block, bytes of each plane of each block, all planes end to end)."""
    press, sizes, widths, out = zstandard.ZstdCompressor(level=level), [], [], []
    for i in range(0, len(ids), BLOCK):
        block = ids[i:i + BLOCK]
        pieces = [press.compress(p) for p in to_planes(block, planes)]
        sizes.append(len(block))
        widths.append([len(p) for p in pieces])
        out += pieces
    return sizes, widths, b"".join(out)


def unpack(sizes: list[int], widths: list[list[int]], data: bytes, planes: str) -> np.ndarray:
    press, at, out = zstandard.ZstdDecompressor(), 0, []
    for n, own in zip(sizes, widths, strict=True):
        parts = []
        for w in own:
            parts.append(press.decompress(data[at:at + w]))
            at += w
        out.append(from_planes(parts, n, planes))
    return np.concatenate(out) if out else np.zeros(0, dtype="<u4")


class _Known(dict):
    """Words to their ids as bytes; a missing word is encoded.  Two generations bound the memory: when one is full,
    words that are used again move from it to the next.  Most words of a corpus come once: a word is remembered when
    its mark, a byte by its hash, is there from before."""

    def __init__(self, encode, most: int):
        self.encode, self.most, self.old = encode, most, {}
        self.marks, self.marked = bytearray(1 << 20), 0

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.encode(word)
            at = hash(word) & 0xFFFFF
            if not self.marks[at]:
                self.marks[at] = 1
                self.marked += 1
                return ids
        self[word] = ids
        if len(self) > self.most:
            self.age()
        return ids

    def age(self) -> None:
        self.old = dict(self)
        self.clear()

    def fade(self) -> None:
        """Marks are taken back when they are so many that they tell little."""
        if self.marked > len(self.marks) // 3:
            self.marks, self.marked = bytearray(len(self.marks)), 0


class WordEncoder:
    """Ids of whole texts by a tokenizer that lowers its input, drops white space and lets no token cross it or the
    border of a letter and a mark: a text is cut there, and each different piece is encoded once and remembered.
    Pieces that hold ``<|`` are not lowered first: the tokenizer looks for its added tokens in the text as it is.
    A piece of lower-case letters alone goes to the tokenizer's model directly, as its steps before the model only
    spell its bytes as characters."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known = _Known(self.one, _MEMORY)

    def one(self, word: bytes) -> bytes:
        text = word.decode()
        if text.isalpha() and text == text.lower() and unicodedata.is_normalized("NFC", text):
            ids = [t.id for t in self.model.tokenize(text if text.isascii() else word.decode("latin-1").translate(_SPELLED))]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, given and returned as bytes."""
        if not texts:
            return []
        self.known.fade()
        raw = np.frombuffer(b"\n".join([t or b"" for t in texts]) + b"\n", np.uint8)
        data = _LOWERED[raw]
        _unlower(data, raw)
        # a mark between a letter and white space stands alone
        alone = np.flatnonzero(_MARK[data[1:-1]] & _LETTER[data[:-2]] & _SPACE[data[2:]]) + 1
        ends = np.cumsum([len(t or b"") + 1 for t in texts])
        ends += np.searchsorted(alone, ends)
        data = np.insert(data, alone, 32)
        inside = ~_SPACE[data]
        first = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        count = np.searchsorted(first, ends) + int(inside[0])
        words = data.tobytes().split()  # bytes split at ASCII white space
        look, at, out = self.known.__getitem__, 0, []
        for n in count.tolist():
            out.append(b"".join(map(look, words[at:n])))
            at = n
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """The encoder of this process: a worker that runs many tasks goes on with the words it knows."""
    return WordEncoder(path)


def _table(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


_SPACE, _MARK, _LETTER = _table(b" \t\n\v\f\r"), _table(b".,;:!?"), _table(bytes(range(97, 123)))
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32


def _unlower(data: np.ndarray, raw: np.ndarray) -> None:
    """Gives the words that hold ``<|`` their letters of ``raw`` back."""
    at = np.flatnonzero((raw[:-1] == 60) & (raw[1:] == 124))
    if len(at):
        space = np.flatnonzero(_SPACE[raw])  # the last byte is one
        for k in np.unique(np.searchsorted(space, at)).tolist():
            start, end = int(space[k - 1]) + 1 if k else 0, int(space[k])
            data[start:end] = raw[start:end]


def _spelled() -> dict[int, int]:
    """The characters by which byte-level tokenizers spell bytes: printable ones themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(others)}


_SPELLED = _spelled()


def write_tokens(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 2,
                 planes: str = "byte", level: int = 3, order: str | None = None) -> None:
    """Writes the ids of every text, each followed by ``end_id``, to token files in ascending order of document ids,
    or of the column ``order`` (a training time, say) and then of document ids.

    Nulls come first.  A null or empty text is its end id alone.  Rows that share an id follow each other in
    the order of their texts; repeated rows are written as often as they occur.  Other columns are ignored.  An
    empty table makes a table without segments.
    """
    if planes not in ("byte", "bit"):
        raise ValueError(f"unknown planes {planes!r}")
    first = [] if order is None else [F.col(order).alias("place")]
    by = ["place", "id"] if first else ["id"]
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), *first)
    rows = rows.repartitionByRange(*by).sortWithinPartitions(*by, "text").select("id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        coder, end = encoder(tokenizer), np.array([end_id], dtype="<u4").tobytes()
        ids, sizes, held, segment, start = [], [], [], 0, 0

        def flush():
            nonlocal ids, sizes, held, segment, start
            flat = np.frombuffer(b"".join(held), dtype="<u4")
            blocks, widths, data = pack(flat, planes, level)
            row = {"part": part, "segment": segment, "start_in_part": start, "n_ids": len(flat), "planes": planes, "doc_ids": ids,
                   "doc_sizes": sizes, "block_sizes": blocks, "plane_bytes": widths, "data": data}
            segment, start, ids, sizes, held = segment + 1, start + len(flat), [], [], []
            return pa.RecordBatch.from_pylist([row], schema=_ARROW)

        total = 0
        for batch in text_slices(batches, "text", _TEXT):
            for i, raw in zip(batch.column("id").to_pylist(), coder.encode(batch.column("text").cast(pa.binary()).to_pylist()), strict=True):
                ids.append(i)
                sizes.append(len(raw) // 4 + 1)
                held += (raw, end)
                total += sizes[-1]
                if total >= SEGMENT:
                    yield flush()
                    total = 0
        if ids:
            yield flush()

    with _batches_of(docs.sparkSession, _ROWS):
        rows.mapInArrow(encode, SCHEMA).write.mode("overwrite").option("compression", "uncompressed").parquet(path)


@contextmanager
def _batches_of(spark: SparkSession, most: int) -> Iterator[None]:
    """Jobs run within hand Python at most ``most`` rows at once: the default of 10,000 texts is some 50 MB, held by the
    JVM and by the worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if 0 < int(before) <= most:
        yield
        return
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.set(name, before)


_ARROW = pa.schema([("part", pa.int32()), ("segment", pa.int64()), ("start_in_part", pa.int64()), ("n_ids", pa.int64()), ("planes", pa.string()),
                    ("doc_ids", pa.list_(pa.int64())), ("doc_sizes", pa.list_(pa.int64())), ("block_sizes", pa.list_(pa.int32())),
                    ("plane_bytes", pa.list_(pa.list_(pa.int32()))), ("data", pa.binary())])


def _before(segments: DataFrame) -> DataFrame:
    """Ids of all earlier parts: a row for each part, two numbers, so as many rows as the writing job had tasks; that
    bound lets it go to the tasks, and segments stay where they are."""
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    return F.broadcast(parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The chunk index: a row for each segment, with its place among all ids."""
    index = spark.read.schema(SCHEMA).parquet(path).drop("data")
    return index.join(_before(index), "part").withColumn("start", F.col("before") + F.col("start_in_part")).drop("before", "start_in_part")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids as little-endian 32-bit integers) of every document, from the files."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    rows = rows.join(_before(rows), "part").withColumn("start_in_part", F.col("start_in_part") + F.col("before")).drop("before")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # a segment at a time
                r = batch.slice(i, 1).to_pylist()[0]
                raw = unpack(r["block_sizes"], r["plane_bytes"], r["data"], r["planes"]).tobytes()
                sizes = np.array(r["doc_sizes"], dtype=np.int64)
                ends = np.cumsum(sizes)
                pieces = [raw[4 * (e - n):4 * e] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(r["doc_ids"], pa.int64()),
                    "start": pa.array(r["start_in_part"] + ends - sizes), "n_tokens": pa.array(sizes), "ids": pa.array(pieces, pa.binary())})

    return rows.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")
