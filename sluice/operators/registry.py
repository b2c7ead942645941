"""Destination registry (J6) and the registry a message sees.

The registry is a change log ``(seq, op, name, path)`` with ops
``add_destination``, ``remove_destination``, ``add_path``, ``remove_path``.
Applying it in order: a later add replaces, a remove deletes, a path removal
ignores its name argument, and removing a destination leaves its paths (which
then route to *producer unknown*).

* ``current_*``: the state after the whole log -- one ``max_by`` per key, a
  hash aggregate with map-side partial aggregation (skew-safe).
* ``as_of``: the state each message saw on arrival, by a carry-forward over
  the union of changes and messages, computed with the blocked prefix scan
  (no per-key window, no range join).  A change at the same sequence number
  as a message is visible to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.scan import DEFAULT_BLOCK, prefix_scan

DEST_OPS = ("add_destination", "remove_destination")
PATH_OPS = ("add_path", "remove_path")


def current_destinations(changes: DataFrame) -> DataFrame:
    """Live destination names: last destination op per name is an add."""
    last = (changes.where(F.col("op").isin(*DEST_OPS))
            .groupBy("name")
            .agg(F.max_by(F.col("op"), F.col("seq")).alias("last_op"),
                 F.max("seq").alias("since_seq")))
    return last.where(F.col("last_op") == "add_destination").select("name", "since_seq")


def current_paths(changes: DataFrame) -> DataFrame:
    """Live path bindings path -> name: last path op per path is an add."""
    last = (changes.where(F.col("op").isin(*PATH_OPS))
            .groupBy("path")
            .agg(F.max_by(F.struct("op", "name"), F.col("seq")).alias("last"),
                 F.max("seq").alias("since_seq")))
    return (last.where(F.col("last.op") == "add_path")
            .select("path", F.col("last.name").alias("destination"), "since_seq"))


def last_ops(changes: DataFrame) -> DataFrame:
    """The registry snapshot: the last change per destination name and per
    path (adds and removes), as change-log rows.  Replaying a snapshot and
    then newer changes gives the same state as replaying the whole log, so a
    stream can carry the registry between micro-batches as this table."""
    dest = (changes.where(F.col("op").isin(*DEST_OPS)).groupBy("name")
            .agg(F.max_by(F.struct("seq", "op", "path"), F.col("seq")).alias("l"))
            .select(F.col("l.seq").alias("seq"), F.col("l.op").alias("op"), "name", F.col("l.path").alias("path")))
    paths = (changes.where(F.col("op").isin(*PATH_OPS)).groupBy("path")
             .agg(F.max_by(F.struct("seq", "op", "name"), F.col("seq")).alias("l"))
             .select(F.col("l.seq").alias("seq"), F.col("l.op").alias("op"), F.col("l.name").alias("name"), "path"))
    return dest.unionByName(paths)


def as_of(facts: DataFrame, fact_key: str, fact_seq: str,
          changes: DataFrame, change_key: str, change_seq: str, change_value: F.Column,
          out: str, block_size: int | None = DEFAULT_BLOCK) -> DataFrame:
    """For every fact row, the last change (``change_value``) with the same key
    and ``change_seq <= fact_seq``; null when there is none.

    A skew-safe as-of join: union, then a blocked running ``max`` of
    ``struct(order, value)`` per key.  Facts with a null key get null.
    """
    tag = "_asof_is_fact"
    order = "_asof_order"
    val = "_asof_val"
    fact_cols = facts.columns
    change_struct = F.struct((F.col(change_seq) * 2).alias("o"), change_value.alias("v"))
    c = changes.select(
        *[F.lit(None).cast(facts.schema[x].dataType).alias(x) for x in fact_cols],
        F.col(change_key).alias("_asof_key"),
        (F.col(change_seq) * 2).alias(order),
        F.lit(False).alias(tag),
        change_struct.alias(val))
    value_type = c.schema[val].dataType
    f = facts.select(
        *[F.col(x) for x in fact_cols],
        F.col(fact_key).alias("_asof_key"),
        (F.col(fact_seq) * 2 + 1).alias(order),
        F.lit(True).alias(tag),
        F.lit(None).cast(value_type).alias(val))
    # Facts with a null key form their own group, which holds no change (null
    # change keys are dropped), so they come out with a null value -- in the
    # same pass, without reading the facts again.
    both = f.unionByName(c.where(F.col("_asof_key").isNotNull()))
    scanned = prefix_scan(both, ["_asof_key"], order, {"_asof_last": ("max", F.col(val))}, block_size)
    return (scanned.where(F.col(tag))
            .select(*[F.col(x) for x in fact_cols], F.col("_asof_last.v").alias(out)))
