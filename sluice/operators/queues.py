"""Queue operators on a queue table.

A queue table holds one row per item: queue, seq (FIFO order), value, put_at,
expiration_ms, state ('waiting' | 'open' | 'confirmed'), opened_at,
auto_abort_ms.  Every operator is evaluated at an explicit ``observed_at``
column/literal -- never the wall clock -- so batch reruns agree.

* D4 get: FIFO of unexpired waiting items, at most ``max_items`` per queue:
  positions by the blocked scan, which drops the blocks of a hot queue that start
  beyond the limit before it sorts any.  ``get_state`` is the queue after it.
* D5 expiry: an unfetched item older than its expiration vanishes; 0 = never.
* D6 auto-abort: an open item not confirmed within auto_abort_ms returns to
  the queue; 0 means confirmed at once.
* D7 confirm / abort a set of ids.
* D8 put with a capacity: as many as fit are accepted, the rest refused (rank
  by the blocked scan -- the limit differs per queue, so no group limit).
* D9 flush (queue stays, empty) / delete (queue removed).
* A2 peek: items, bytes, age of the head item, open transactions, head item.
* A6 counts of put / confirm / abort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.columns import epoch_ms
from sluice.operators.scan import DEFAULT_BLOCK, prefix_scan, running_count

# At most 1024 items per get, 30000 ms put expiry.
DEFAULT_MAX_ITEMS = 1024
DEFAULT_EXPIRATION_MS = 30_000


def age_ms(observed_at: Column, put_at: str = "put_at") -> Column:
    return epoch_ms(observed_at) - epoch_ms(put_at)


def not_expired(observed_at: Column) -> Column:
    """D5 predicate: expiration 0 never expires; age equal to it is kept."""
    return (F.col("expiration_ms") == 0) | (age_ms(observed_at) <= F.col("expiration_ms"))


def expire(items: DataFrame, observed_at: Column) -> DataFrame:
    """The waiting items still in the queue."""
    return items.where((F.col("state") == "waiting") & not_expired(observed_at))


def expired(items: DataFrame, observed_at: Column) -> DataFrame:
    """The waiting items that vanished."""
    return items.where((F.col("state") == "waiting") & ~not_expired(observed_at))


def get(items: DataFrame, observed_at: Column, max_items: int = DEFAULT_MAX_ITEMS,
        queue_col: str = "queue") -> DataFrame:
    """Per queue, the first ``max_items`` unexpired waiting items by seq, at
    any limit without a sort of the whole queue."""
    counted = prefix_scan(expire(items, observed_at), [queue_col], "seq", {"position": ("sum", F.lit(1).cast("long"))},
                          keep_blocks=lambda off: F.coalesce(off["position"], F.lit(0)) < F.lit(max_items))
    return counted.where(F.col("position") <= max_items)


def get_state(items: DataFrame, observed_at: Column, max_items: int = DEFAULT_MAX_ITEMS,
              queue_col: str = "queue") -> DataFrame:
    """The queue table after a get (D4): items got are 'open' since
    ``observed_at``, or 'confirmed' at once where auto_abort_ms is 0; expired ones
    are gone; all others are as they were.  ``txn_id`` is the id the getter
    confirms by: the item's seq, 0 for confirmed ones, null for items not got.
    Feeds ``auto_abort``, ``confirm`` and ``abort``."""
    got = get(items, observed_at, max_items, queue_col)
    now = F.when(F.col("auto_abort_ms") == 0, F.lit("confirmed")).otherwise(F.lit("open"))
    opened = got.select(*[F.col(c) for c in items.columns if c not in ("state", "opened_at")], now.alias("state"),
                        observed_at.cast(items.schema["opened_at"].dataType).alias("opened_at"),
                        F.when(F.col("auto_abort_ms") == 0, F.lit(0)).otherwise(F.col("seq")).cast("long").alias("txn_id"))
    left = items.where((F.col("state") != "waiting") | not_expired(observed_at))
    rest = left.join(got.select(F.col(queue_col).alias("_g_q"), F.col("seq").alias("_g_s")),
                     F.col(queue_col).eqNullSafe(F.col("_g_q")) & (F.col("seq") == F.col("_g_s")) & (F.col("state") == "waiting"),
                     "left_anti")
    return rest.withColumn("txn_id", F.lit(None).cast("long")).select(*opened.columns).unionByName(opened)


def auto_abort(items: DataFrame, observed_at: Column) -> DataFrame:
    """State of fetched ('open') items at observed_at:
    auto_abort_ms = 0 -> 'confirmed' (id 0); past the deadline -> 'waiting'
    (re-enqueued); else still 'open'.  Other items pass unchanged."""
    deadline_passed = (epoch_ms(observed_at) - epoch_ms("opened_at")) > F.col("auto_abort_ms")
    new_state = (F.when(F.col("state") != "open", F.col("state"))
                 .when(F.col("auto_abort_ms") == 0, F.lit("confirmed"))
                 .when(deadline_passed, F.lit("waiting"))
                 .otherwise(F.lit("open")))
    txn = F.when((F.col("state") == "open") & (F.col("auto_abort_ms") == 0), F.lit(0)).otherwise(F.col("seq"))
    return items.withColumn("new_state", new_state).withColumn("txn_id", txn.cast("long"))


def confirm(items: DataFrame, ids: DataFrame) -> DataFrame:
    """D7 confirm: open items whose id is in ``ids`` (queue, seq) leave the
    table (anti-join); returns the remaining items."""
    sel = ids.select("queue", "seq").distinct().withColumn("_hit", F.lit(True))
    j = items.join(sel, ["queue", "seq"], "left")
    return j.where(~((F.col("state") == "open") & F.col("_hit").isNotNull())).drop("_hit")


def abort(items: DataFrame, ids: DataFrame) -> DataFrame:
    """D7 abort: open items whose id is in ``ids`` return to 'waiting'."""
    sel = ids.select("queue", "seq").distinct().withColumn("_hit", F.lit(True))
    j = items.join(sel, ["queue", "seq"], "left")
    return (j.withColumn("state", F.when((F.col("state") == "open") & F.col("_hit").isNotNull(),
                                         F.lit("waiting")).otherwise(F.col("state")))
            .drop("_hit"))


def put_with_capacity(puts: DataFrame, waiting: DataFrame, limits: DataFrame,
                      block_size: int | None = DEFAULT_BLOCK) -> DataFrame:
    """Per queue, accept the first (capacity - waiting) puts by seq, refuse
    the rest.  ``limits``: (queue, capacity); a queue without a limit accepts all.
    Adds ``accepted``."""
    counts = waiting.groupBy("queue").agg(F.count(F.lit(1)).alias("_p_waiting"))
    free = (limits.join(counts, "queue", "left")
            .select(F.col("queue").alias("_p_queue"),
                    F.greatest(F.col("capacity") - F.coalesce(F.col("_p_waiting"), F.lit(0)), F.lit(0))
                    .alias("_p_free")))
    ranked = running_count(puts, ["queue"], "seq", "_p_rank", block_size)
    j = ranked.join(free, F.col("queue") == F.col("_p_queue"), "left")
    accepted = F.col("_p_free").isNull() | (F.col("_p_rank") <= F.col("_p_free"))
    return j.withColumn("accepted", accepted).drop("_p_queue", "_p_free", "_p_rank")


def flush(items: DataFrame, queues: list[str] | None = None) -> DataFrame:
    """D9 flush: unfetched (waiting) items of the named queues (all when None)
    are dropped; the queues stay (see ``queue_info(..., known_queues)``)."""
    hit = F.col("state") == "waiting"
    if queues is not None:
        hit = hit & F.col("queue").isin(*queues)
    return items.where(~hit)


def delete_queue(items: DataFrame, queues: list[str]) -> DataFrame:
    """D9 delete: the queue and all its items are removed."""
    return items.where(~F.col("queue").isin(*queues))


def queue_info(items: DataFrame, observed_at: Column, known_queues: DataFrame | None = None) -> DataFrame:
    """A2 peek: per queue, waiting unexpired ``items`` and their ``bytes``,
    ``age_ms`` and value of the head item (smallest seq), and
    ``open_transactions``.  ``known_queues`` (queue) keeps empty queues."""
    live = not_expired(observed_at) & (F.col("state") == "waiting")
    size = F.length(F.col("value")).cast("long")
    agg = items.groupBy("queue").agg(
        F.sum(F.when(live, 1).otherwise(0)).cast("long").alias("items"),
        F.sum(F.when(live, size).otherwise(0)).cast("long").alias("bytes"),
        F.min_by(F.when(live, F.struct("seq", "value", "put_at")), F.when(live, F.col("seq"))).alias("_head"),
        F.sum(F.when(F.col("state") == "open", 1).otherwise(0)).cast("long").alias("open_transactions"))
    out = agg.select(
        "queue", "items", "bytes",
        (epoch_ms(observed_at) - epoch_ms(F.col("_head.put_at"))).alias("age_ms"),
        "open_transactions",
        F.col("_head.value").alias("head_item"))
    if known_queues is not None:
        out = known_queues.select("queue").distinct().join(out, "queue", "left").select(
            "queue",
            *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("items", "bytes")],
            "age_ms",
            F.coalesce(F.col("open_transactions"), F.lit(0)).cast("long").alias("open_transactions"),
            "head_item")
    return out


def op_counts(puts: DataFrame, confirmed: DataFrame, aborted: DataFrame) -> DataFrame:
    """Per queue, how many items were put, confirmed and aborted."""
    tag = lambda df, name: df.select("queue", F.lit(name).alias("_op"))
    u = tag(puts, "put").unionByName(tag(confirmed, "confirm")).unionByName(tag(aborted, "abort"))
    return (u.groupBy("queue")
            .agg(*[F.sum(F.when(F.col("_op") == o, 1).otherwise(0)).cast("long").alias(f"{o}_count")
                   for o in ("put", "confirm", "abort")]))
