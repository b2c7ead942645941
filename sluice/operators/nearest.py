"""Nearest qualifying point: per key, the closest position before (or after) a query whose value is large enough.

"The smallest pending offset above o at time t" and "the first later acknowledgement beyond a bound" are both of this
form.  Neither a window (the threshold differs by row) nor a range join (which would emit all qualifying points) fits.

Positions are cut into blocks of ``block_size``; one row a block keeps the block's largest value.

1. A query meets the points of its own block.
2. Queries that find nothing there look for the nearest block whose largest value is enough.  That is the same question
   one level up, over ``block_size`` times fewer points, until a key has one block.
3. They then meet the points of the block found, whole.

A block is one group, whatever the key; a block that many queries meet is dealt out to several groups, each with a copy
of its points (at most ``block_size``) and about ``block_size`` queries.  So no group has more than about twice that.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.scan import materialize

BLOCK = 1 << 16


def last_at_least(values: np.ndarray, ends: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For each query the largest i < ends with values[i] >= least, or -1.

    Maxima over aligned runs of 1, 2, 4, ... values; the run that qualifies is found from the query's end downwards and
    then halved.  Every step is one numpy expression over all queries."""
    tree = [values]
    while len(tree[-1]) > 1:
        v = tree[-1]
        tree.append(np.maximum(v[0::2], np.append(v[1::2], v[-1:] if len(v) % 2 else v[:0])))
    at = ends.astype(np.int64).copy()
    level = np.full(len(at), -1)
    run = np.zeros(len(at), np.int64)
    for up, v in enumerate(tree):
        ask = np.flatnonzero((level < 0) & ((at >> up) & 1 == 1))
        before = (at[ask] >> up) - 1
        good = v[before] >= least[ask]
        level[ask[good]], run[ask[good]] = up, before[good]
        at[ask[~good]] -= 1 << up
    for up in range(len(tree) - 1, 0, -1):
        ask = np.flatnonzero(level == up)
        right = run[ask] * 2 + 1
        held = np.minimum(right, len(tree[up - 1]) - 1)
        good = (held == right) & (tree[up - 1][held] >= least[ask])
        run[ask] = np.where(good, right, right - 1)
        level[ask] = up - 1
    return np.where(level < 0, -1, run)


def _in_block(points: pa.Table, queries: pa.Table) -> pa.Table:
    pos, val = (points.column(c).to_numpy() for c in ("_pos", "_val"))
    order = np.argsort(pos, kind="stable")
    pos, val = pos[order], val[order]
    at, least = (queries.column(c).to_numpy() for c in ("_at", "_least"))
    i = last_at_least(val, np.searchsorted(pos, at), least)
    found = pos[np.maximum(i, 0)] if len(pos) else np.zeros(len(i), np.int64)
    return queries.drop_columns(["_deal"]).append_column("_found", pa.array(found, pa.int64(), mask=i < 0))


def _meet(points: DataFrame, queries: DataFrame, block_size: int) -> DataFrame:
    """Queries (with _key, _blk, _at, _least) against the points of their block: ``_found`` or null.

    The number of groups of every block goes to all tasks, a row for ``block_size`` positions, so points and queries are
    shuffled once, to their groups."""
    met = F.broadcast(queries.groupBy("_key", "_blk").agg(F.ceil(F.count("*") / block_size).cast("int").alias("_deals")))
    deal = F.pmod(F.xxhash64(*queries.columns), F.col("_deals")).cast("int").alias("_deal")
    dealt = queries.join(met, ["_key", "_blk"]).select(*queries.columns, deal)
    copies = points.join(met, ["_key", "_blk"]).select("_key", "_blk", "_pos", "_val", F.explode(F.sequence(F.lit(0), F.col("_deals") - 1)).alias("_deal"))
    schema = T.StructType([f for f in queries.schema.fields] + [T.StructField("_found", T.LongType())])
    by = ["_key", "_blk", "_deal"]
    return copies.groupBy(*by).cogroup(dealt.groupBy(*by)).applyInArrow(_in_block, schema)


def nearest(points: DataFrame, queries: DataFrame, key: str, pos: str, val: str, at: str, least: str,
            out: str, ahead: bool = False, block_size: int = BLOCK) -> DataFrame:
    """``queries`` with ``out``: the largest position below ``at`` among the points of the same ``key`` whose value is
    ``least`` or more; with ``ahead`` the smallest position above ``at``.  Null where there is none.

    Key, positions, values and bounds are integers.  Positions are unique within a key; blocks are cut on them, so they
    should be dense (ranks, offsets).  Queries are dealt by the hash of their row, so they should differ.  Points with a
    null key, position or value take no part, and queries with a null key or bound find nothing.  Both inputs are read more than once: materialize what is expensive."""
    p = points.select(F.col(key).cast("long").alias("_key"), F.col(pos).cast("long").alias("_pos"), F.col(val).cast("long").alias("_val"))
    p = p.where("_key is not null and _pos is not null and _val is not null")
    low, high = p.agg(F.coalesce(F.min("_pos"), F.lit(0)), F.coalesce(F.max("_pos"), F.lit(0))).first()
    span = high - low
    low, high = F.lit(low).cast("long"), F.lit(high).cast("long")
    turned = (lambda c: high - c) if ahead else (lambda c: c - low)  # from 0 on, and always looking back
    p = p.withColumn("_pos", turned(F.col("_pos")))
    q = queries.withColumns({"_key": F.col(key).cast("long"), "_at": turned(F.col(at).cast("long")), "_least": F.col(least).cast("long")})
    asked = q.where("_key is not null and _at is not null and _least is not null")
    found = _search(p, asked.withColumn("_at", F.least("_at", F.lit(span + 1))), span, block_size)
    silent = q.where("_key is null or _at is null or _least is null").withColumn("_found", F.lit(None).cast("long"))
    both = found.select(*silent.columns).unionByName(silent)
    return both.select(*queries.columns, ((high - F.col("_found")) if ahead else (F.col("_found") + low)).alias(out))


def _search(points: DataFrame, queries: DataFrame, span: int, block_size: int, level: int = 0) -> DataFrame:
    """For positions from 0 to ``span``."""
    points = points.withColumn("_blk", F.floor(F.col("_pos") / block_size).cast("long"))
    # the points are below the query's position: it meets the block of the position before
    columns = queries.columns
    here = _meet(points, queries.withColumn("_blk", F.floor((F.col("_at") - 1) / block_size).cast("long")), block_size)
    if span < block_size:
        return here.select(*columns, "_found")
    here = materialize(here)
    own = f"_at{level}"
    tops = materialize(points.groupBy("_key", "_blk").agg(F.max("_val").alias("_val")).withColumnRenamed("_blk", "_pos"))
    up = here.where("_found is null").withColumns({own: F.col("_at"), "_at": F.col("_blk")}).drop("_blk", "_found")
    reached = _search(tops, up, span // block_size, block_size, level + 1).withColumn("_at", F.col(own)).drop(own)
    reached = materialize(reached.withColumnRenamed("_found", "_blk"))
    there = _meet(points, reached.where("_blk is not null").select(*columns, "_blk"), block_size)
    none = reached.where("_blk is null").select(*columns, F.lit(None).cast("long").alias("_found"))
    return here.where("_found is not null").select(*columns, "_found").unionByName(there.select(*columns, "_found")).unionByName(none)
