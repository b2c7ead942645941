"""Helpers shared by the operators of this subpackage.

``words_of`` cuts and hashes the words of an Arrow text column with numpy; it works on slices
of about a megabyte, so its memory does not follow the batch or the length of a text.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import scratch_path

#: A word: a run of anything but a space, tab, line feed, vertical tab, form feed or return.
WORD = r"[^\x20\x09-\x0D]+"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240611).integers(1, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SLICE = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder that the session names."""
    return scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")


#: Spark's setting that removes a query's shuffle files when it ends, not when the driver collects its garbage.
_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read again: later steps that use it twice neither
    compute it again nor depend on the executors that made it.  Shuffle files of the write go when it ends."""
    spark = df.sparkSession
    path, was = scratch(spark, name), spark.conf.get(_REMOVE_SHUFFLES, None)
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if was is None:
            spark.conf.unset(_REMOVE_SHUFFLES)
        else:
            spark.conf.set(_REMOVE_SHUFFLES, was)
    return spark.read.schema(df.schema).parquet(path)


def n_words(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(NamedTuple):
    """Words of a batch: ``hashes[ptr[i]:ptr[i+1]]`` are those of text i, ``data[start:end]`` the
    bytes of each."""

    hashes: np.ndarray
    ptr: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray


def words_of(texts: pa.Array, lower: bool = False, apart: np.ndarray = _SPACE) -> Words:
    """Words and their 64-bit hashes; nulls count as empty.  ``lower`` lowers A-Z; ``apart`` flags the bytes between words."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    at = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[at[0]:at[-1]] if raw is not None and len(texts) else np.zeros(0, np.uint8)
    at = at - at[0] if len(at) else np.zeros(1, np.int64)
    inside = ~apart[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = at[(at > 0) & (at < len(data))]
    first[edge] = inside[edge]  # a new text begins a new word
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = np.empty(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):  # by about a megabyte of whole words
        j = max(i + 1, int(np.searchsorted(start, start[i] + _SLICE)))
        part = data[start[i]:end[j - 1]]
        s, n = start[i:j] - start[i], end[i:j] - start[i:j]
        power = np.multiply.accumulate(np.full(int(n.max()) + 1, _BASE, dtype=np.uint64))
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        b = part[inner + np.repeat(s, n)]
        v = _BYTE[_LOWER[b] if lower else b] * power[inner]
        hashes[i:j] = np.add.reduceat(v, np.cumsum(n) - n)
        i = j
    return Words(mix64(hashes), np.searchsorted(start, at).astype(np.int64), start, end, data)


def text_slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that each has about ``most`` bytes of text, or a single row."""
    for batch in batches:
        n = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).cast(pa.int64()))
        total = np.cumsum(n)
        i = 0
        while i < len(n):
            j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + most, side="right")))
            yield batch.slice(i, j - i)
            i = j
