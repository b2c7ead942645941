"""Joins against dimension tables with a checked broadcast.

A side is broadcast only when the optimizer's size estimate times an expansion
factor (a Parquet scan's estimate is its compressed size) is below
``max_bytes`` (32 MiB, or ``spark.sluice.broadcast.maxBytes``).  Otherwise the join is left to the planner: a shuffle join,
which AQE still turns into a broadcast at run time when the materialised side
is small.  So nothing is broadcast whose size grows with the data unchecked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 32 MiB unless the session sets ``spark.sluice.broadcast.maxBytes``: a
# broadcast is sent to every executor, so on a 1000-executor cluster the
# bound is paid a thousand times.
DEFAULT_MAX_BROADCAST_BYTES = 32 << 20
# What a compressed file may grow to in memory, at worst for the dimension tables
# meant here (short strings, dictionary-encoded); beyond it AQE decides at run time.
EXPANSION = 8
MAX_BROADCAST_CONF = "spark.sluice.broadcast.maxBytes"


def max_broadcast_bytes(df: DataFrame) -> int:
    try:
        return int(df.sparkSession.conf.get(MAX_BROADCAST_CONF, str(DEFAULT_MAX_BROADCAST_BYTES)))
    except (TypeError, ValueError):
        return DEFAULT_MAX_BROADCAST_BYTES


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of ``df`` in bytes, or None if unavailable."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(size) if isinstance(size, int) else int(str(size.toString()))
    except Exception:  # pragma: no cover - e.g. Spark Connect
        return None


def checked_broadcast(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``broadcast(df)`` when its estimated size is proven below ``max_bytes``,
    else ``df`` unchanged (shuffle join / AQE decides)."""
    max_bytes = max_broadcast_bytes(df) if max_bytes is None else max_bytes
    size = estimated_bytes(df)
    if size is not None and size * EXPANSION <= max_bytes:
        return F.broadcast(df)
    return df


def dim_join(fact: DataFrame, dim: DataFrame, on: Column | list[str] | str, how: str = "left",
             max_bytes: int | None = None) -> DataFrame:
    """Join a fact frame with a dimension frame, broadcasting the dimension
    behind the size check."""
    return fact.join(checked_broadcast(dim, max_bytes), on, how)
