"""Skew-safe ordered prefix aggregation (the blocked scan).

Many operators in this library are "running" values per key in sequence
order: running byte totals of a fetch slice, the rank of an item in a queue,
the running latency mean of a task, the registry state a message sees.  The
obvious form, ``agg(x) over (partition by key order by seq)``, puts every row
of a key into one task: with a handful of keys (two latency tasks, four Kafka
partitions, five queues) or one hot key holding a third of all rows, that is
one task reading a third of the data.

The blocked scan splits each key into blocks of the sequence column:

1. ``block = floor(seq / block_size)``; a block holds at most ``block_size``
   rows of one key when ``seq`` is an integer unique within the key
   (``auto_block_size`` picks it from the plan's size estimate).
2. Per (key, block) totals by ``groupBy`` -- partial aggregation runs map
   side, so only one small row per (key, block, map task) is shuffled.
3. Exclusive prefix of the totals per key by a window over the small totals
   table (a hot key has ``rows / block_size`` entries there).
4. Join the offsets on (key, block) and run the window over (key, block)
   only; result = combine(offset, in-block running value).

The big input is shuffled once (by key and block); the offsets table is
broadcast by AQE when it turns out small, or shuffle-joined on the same keys
so that the window reuses that partitioning.  The input is read twice (the
totals branch is a narrow, pre-aggregated read); when the input is itself an
expensive chain, ``materialize`` it first.  Supported aggregates are
the associative ones: ``sum``, ``max`` and ``min``.  ``max`` of a
``struct(seq, value)`` gives "last value so far" (carry forward).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BLOCK = None            # None: size blocks from the plan's size estimate
MIN_BLOCK = 1 << 10
MAX_BLOCK = 1 << 16
BLOCK_COL = "_scan_blk"


def auto_block_size(df: DataFrame, blocks_per_core: int = 8) -> int:
    """Rows per block from the optimizer's size estimate (no job is run).

    Small inputs get small blocks so that (key, block) windows spread over all
    cores; large inputs get MAX_BLOCK so that the per-key offsets table stays
    small (a hot key with 1e12 rows has ~1.5e7 blocks).  The estimate is an
    upper bound, so big data always lands on MAX_BLOCK."""
    from sluice.operators.joins import estimated_bytes
    size = estimated_bytes(df)
    if size is None:
        return MAX_BLOCK
    est_rows = max(size // 16, 1)
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
    except Exception:  # pragma: no cover - Spark Connect
        cores = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    target = max(cores * blocks_per_core, 1)
    want = est_rows // target
    block = MIN_BLOCK
    while block < want and block < MAX_BLOCK:
        block <<= 1
    return block

_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def _combine(kind: str, off: Column, loc: Column) -> Column:
    if kind == "sum":
        return F.coalesce(off, F.lit(0)) + loc
    if kind == "max":
        return F.greatest(off, loc)
    return F.least(off, loc)


def _key_default(dtype: T.DataType) -> Column:
    """A placeholder for null keys (the null flag column keeps them apart)."""
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    return F.lit(0).cast(dtype)


def prefix_scan(df: DataFrame, keys: list[str], order: str | list[str],
                aggs: dict[str, tuple[str, Column]],
                block_size: int | None = DEFAULT_BLOCK, keep_block: bool = False,
                exclusive: bool = False, by_position: bool = False,
                keep_blocks: "Callable[[dict[str, Column]], Column] | None" = None) -> DataFrame:
    """Add one column per ``aggs`` entry: the inclusive (or with ``exclusive``,
    strictly-before) running aggregate of the given expression over rows with
    the same ``keys`` ordered by ``order``.

    ``order`` is an integer column (blocks are cut on it: it should be dense, a
    counter or an offset), optionally followed
    by tie-breaking columns; the whole order must be unique within a key
    (ties would make any running value ambiguous).  Keys may be null (a null key is its own
    group).  With ``keep_block`` the internal key/block columns stay in the
    output; a second scan over the same keys then reuses them -- and the
    partitioning the first scan left behind -- instead of shuffling again.
    With ``by_position`` the order may be of any sortable type and any density
    (a timestamp, say) and have many ties before its last column: rows are
    range-partitioned by (key, order) once and checkpointed, and a block is one of
    these partitions, so blocks have about equally many rows and a key has as many
    totals as it has partitions.
    ``keep_blocks`` gets the block offset columns (the aggregate of all
    earlier blocks, by name; null for a key's first block) and returns a
    predicate: blocks failing it are dropped before the per-row window -- for
    a monotone running value this bounds the work by the rows that can still
    qualify (e.g. a fetch slice of 1 MiB from a huge partition).
    """
    if block_size is None and not by_position:
        block_size = MAX_BLOCK if BLOCK_COL in df.columns else auto_block_size(df)
    if block_size is not None and block_size < 1:
        raise ValueError("block_size must be positive")
    for kind, _ in aggs.values():
        if kind not in _AGG:
            raise ValueError(f"unsupported prefix aggregate {kind!r}")

    order_cols = [order] if isinstance(order, str) else list(order)
    blk = BLOCK_COL
    skeys = [f"_scan_k{i}" for i in range(len(keys))] + [f"_scan_n{i}" for i in range(len(keys))]
    part = skeys + [blk]
    internal = set(part)
    base_cols = [c for c in df.columns if c not in internal]

    # Non-nullable key and block columns: plain equi-join keys (a null-safe
    # join would hash on rewritten keys and force the window to re-shuffle).
    d = df
    keyed = [*[F.coalesce(F.col(k), _key_default(df.schema[k].dataType)).alias(f"_scan_k{i}")
               for i, k in enumerate(keys)],
             *[F.isnull(F.col(k)).alias(f"_scan_n{i}") for i, k in enumerate(keys)]]
    if by_position and not internal <= set(df.columns):
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        d = df.select(*[F.col(c) for c in base_cols], *keyed).repartitionByRange(parts, *skeys, *order_cols)
        d = materialize(d.withColumn(blk, F.spark_partition_id().cast("long")))
    elif not internal <= set(df.columns):
        d = df.select(
            *[F.col(c) for c in base_cols],
            *keyed,
            F.coalesce(F.floor(F.col(order_cols[0]) / F.lit(block_size)).cast("long"),
                       F.lit(-1).cast("long")).alias(blk))
    inputs = {name: f"_scan_in_{name}" for name in aggs}
    d = d.select("*", *[expr.alias(inputs[name]) for name, (_, expr) in aggs.items()])

    # (1) block totals straight from the input: partial aggregation runs map
    # side, so only one small row per (key, block, map task) is shuffled.
    totals = d.groupBy(*part).agg(
        *[_AGG[kind](inputs[name]).alias(f"_scan_tot_{name}") for name, (kind, _) in aggs.items()])

    # (2) exclusive prefix over blocks, per key, on the small totals table.
    wb = Window.partitionBy(*skeys).orderBy(blk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *part, *[_AGG[kind](f"_scan_tot_{name}").over(wb).alias(f"_scan_off_{name}")
                 for name, (kind, _) in aggs.items()])

    # (3) offsets joined on (key, block): broadcast when AQE sees them small,
    # else a shuffle join on exactly the keys the window below needs, so the
    # rows are shuffled once either way.
    if keep_blocks is not None:
        offsets = offsets.where(keep_blocks({name: F.col(f"_scan_off_{name}") for name in aggs}))
    j = d.join(offsets, part, "inner")

    # (4) the in-block running value, combined with the block's offset.
    end = -1 if exclusive else Window.currentRow
    wl = Window.partitionBy(*part).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, end)

    def local(kind: str, name: str) -> Column:
        v = _AGG[kind](inputs[name]).over(wl)
        return F.coalesce(v, F.lit(0)) if kind == "sum" and exclusive else v

    keep = base_cols + (part if keep_block else [])
    return j.select(
        *[F.col(c) for c in keep],
        *[_combine(kind, F.col(f"_scan_off_{name}"), local(kind, name)).alias(name)
          for name, (kind, _) in aggs.items()])


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of an intermediate that a later step reads twice
    (a chained scan): a reliable checkpoint into the cluster's shared
    ``spark.checkpoint.dir`` -- it survives executor loss, unlike a local
    checkpoint, and the upstream is computed once instead of per branch."""
    from sluice.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def running_count(df: DataFrame, keys: list[str], order: str | list[str], name: str = "rank",
                  block_size: int | None = DEFAULT_BLOCK, by_position: bool = False) -> DataFrame:
    """1-based position of each row within its key in ``order`` (a skew-safe
    ``row_number``)."""
    return prefix_scan(df, keys, order, {name: ("sum", F.lit(1).cast("long"))}, block_size, by_position=by_position)
