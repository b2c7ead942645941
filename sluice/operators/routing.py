"""Routing messages to destinations.

* J1 two hops (Kafka, AMQP sinks): selection -> path -> destination -> producer.
* J2 one hop (JMS, MQTT, Kestrel sinks): the selection names the destination.
* J3 every message gets a ``route_reason``: null when routed, else
  ``no selection`` / ``path unknown`` / ``producer unknown`` (checked in that
  order).  Unroutable messages are a side output, never silently lost.
* J4 the selector is any Column expression.
* J5 AMQP direct exchange: a published (exchange, routing key) reaches every
  queue bound with that key on that exchange.
* J7 the same two hops against the registry as it stood when the message
  arrived (``sluice.operators.registry.as_of``).
* J9 queue status gate.

Registry tables (paths, destinations) are dimensions: they are joined with a
size-checked broadcast, so the message side is never shuffled for routing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.joins import dim_join
from sluice.operators.registry import DEST_OPS, PATH_OPS, as_of
from sluice.operators.scan import DEFAULT_BLOCK, materialize

NO_SELECTION = "no selection"
PATH_UNKNOWN = "path unknown"
PRODUCER_UNKNOWN = "producer unknown"


def route_two_hop(msgs: DataFrame, selection: Column, paths: DataFrame, destinations: DataFrame,
                  path_col: str = "path", dest_col: str = "destination") -> DataFrame:
    """J1 + J3.  ``paths``: (path, destination), one row per path (J6
    ``current_paths``), or with a column ``seq`` a log of puts, of which the last
    one of a path counts; without ``seq``, rows of one path resolve to the
    largest destination, so messages are never multiplied.  ``destinations``:
    live destinations with a ``name`` column.  Adds path, destination,
    route_reason."""
    m = msgs.withColumn(path_col, selection)
    # One binding per path (a path maps to one destination), so a message is
    # never multiplied by the join: routed + unroutable = input.
    one = F.max_by("destination", "seq") if "seq" in paths.columns else F.max("destination")
    binding = (paths.groupBy("path").agg(one.alias("_r_dest"))
               .select(F.col("path").alias("_r_path"), F.col("_r_dest").alias(dest_col)))
    live = destinations.select(F.col("name").alias("_r_name")).distinct()
    j = dim_join(m, binding, F.col(path_col) == F.col("_r_path"), "left")
    j = dim_join(j, live.withColumn("_r_live", F.lit(True)), F.col(dest_col) == F.col("_r_name"), "left")
    reason = (F.when(F.col(path_col).isNull(), F.lit(NO_SELECTION))
              .when(F.col("_r_path").isNull(), F.lit(PATH_UNKNOWN))
              .when(F.col("_r_live").isNull(), F.lit(PRODUCER_UNKNOWN)))
    return j.withColumn("route_reason", reason).drop("_r_path", "_r_name", "_r_live")


def route_one_hop(msgs: DataFrame, selection: Column, destinations: DataFrame,
                  dest_col: str = "destination") -> DataFrame:
    """J2 + J3: the selector names the destination directly."""
    m = msgs.withColumn(dest_col, selection)
    live = destinations.select(F.col("name").alias("_r_name")).distinct().withColumn("_r_live", F.lit(True))
    j = dim_join(m, live, F.col(dest_col) == F.col("_r_name"), "left")
    reason = (F.when(F.col(dest_col).isNull(), F.lit(NO_SELECTION))
              .when(F.col("_r_live").isNull(), F.lit(PRODUCER_UNKNOWN)))
    return j.withColumn("route_reason", reason).drop("_r_name", "_r_live")


def routed(r: DataFrame) -> DataFrame:
    return r.where(F.col("route_reason").isNull()).drop("route_reason")


def unroutable(r: DataFrame) -> DataFrame:
    return r.where(F.col("route_reason").isNotNull())


def direct_exchange(published: DataFrame, bindings: DataFrame) -> DataFrame:
    """Deliver (exchange, routing_key) publications to every queue bound
    with an equal key on the same exchange.

    ``published``: rows with ``exchange`` and ``routing_key``;
    ``bindings``: (exchange, binding_key, queue).  Unbound publications are
    dropped by AMQP; they are kept here with a null queue."""
    b = bindings.select(F.col("exchange").alias("_b_exchange"), F.col("binding_key").alias("_b_key"),
                        F.col("queue").alias("bound_queue"))
    cond = (F.col("exchange") == F.col("_b_exchange")) & (F.col("routing_key") == F.col("_b_key"))
    return dim_join(published, b, cond, "left").drop("_b_exchange", "_b_key")


def route_as_of(msgs: DataFrame, selection: Column, seq_col: str, changes: DataFrame,
                path_col: str = "path", dest_col: str = "destination",
                block_size: int | None = DEFAULT_BLOCK, materialize_hops: bool = True) -> DataFrame:
    """Two-hop routing against the registry state at the message's
    sequence number.  ``changes``: (seq, op, name, path) change log.

    The first hop is checkpointed (``materialize_hops``) because the second
    hop's scan reads it twice; project ``msgs`` to the columns you need first
    so that only those are written."""
    m = msgs.withColumn(path_col, selection)
    path_changes = changes.where(F.col("op").isin(*PATH_OPS))
    hop1 = as_of(m, path_col, seq_col, path_changes, "path", "seq",
                 F.struct((F.col("op") == "add_path").alias("bound"), F.col("name").alias("name")),
                 "_r_path_state", block_size)
    hop1 = hop1.withColumn(dest_col, F.when(F.col("_r_path_state.bound"), F.col("_r_path_state.name")))
    if materialize_hops:
        hop1 = materialize(hop1)
    dest_changes = changes.where(F.col("op").isin(*DEST_OPS))
    hop2 = as_of(hop1, dest_col, seq_col, dest_changes, "name", "seq",
                 F.col("op") == "add_destination", "_r_live", block_size)
    reason = (F.when(F.col(path_col).isNull(), F.lit(NO_SELECTION))
              .when(F.col(dest_col).isNull(), F.lit(PATH_UNKNOWN))
              .when(~F.coalesce(F.col("_r_live"), F.lit(False)), F.lit(PRODUCER_UNKNOWN)))
    return hop2.withColumn("route_reason", reason).drop("_r_path_state", "_r_live")


# The queue server statuses (J9) and the operations each allows.
STATUS_ALLOWS = {
    "NOT_CONFIGURED": ("read", "write"),
    "UP": ("read", "write"),
    "READ_ONLY": ("read",),
    "QUIESCENT": (),
}


def status_allows(status: Column, op: Column) -> Column:
    """Is ``op`` ('read' / 'write') allowed under the server status?"""
    expr = F.lit(False)
    for st, ops in STATUS_ALLOWS.items():
        if ops:
            expr = F.when((status == st) & op.isin(*ops), F.lit(True)).otherwise(expr)
    return expr


def status_gate(ops: DataFrame, status: DataFrame, queue_col: str = "queue", op_col: str = "op") -> DataFrame:
    """Ops (queue, op) joined with the per-queue status -> ``allowed``.
    A queue with no status row counts as NOT_CONFIGURED."""
    s = status.select(F.col("queue").alias("_g_queue"), F.col("status"))
    j = dim_join(ops, s, F.col(queue_col) == F.col("_g_queue"), "left").drop("_g_queue")
    st = F.coalesce(F.col("status"), F.lit("NOT_CONFIGURED"))
    return j.withColumn("status", st).withColumn("allowed", status_allows(st, F.col(op_col)))
