"""Acknowledgement ledger.

* T1 pending = emitted minus acked (anti-join); unknown = acks of ids that
  were never emitted (anti-join the other way).  Both are one shuffle on the
  message key.
* T2 what a failed message becomes, by protocol: AMQP requeue (or dead letter
  without requeue), Kestrel abort (returns to the queue), JMS and MQTT
  acknowledge and so drop it, Kafka replays it from the failed offset (J8).
* T3 pending prune: on ack(o), if the smallest pending offset is below
  ``o - max_offset_behind`` every pending offset below o is cleared, else only
  o.  Whether an ack clears depends on every earlier ack, but what it leaves
  does not (``pending_prune_bounded``), so the clears are a linked list that is
  followed by pointer jumping, and no partition is a task.  Streaming form:
  ``sluice.streaming.pipelines.prune_stream``.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.nearest import BLOCK, nearest
from sluice.operators.registry import as_of
from sluice.operators.scan import materialize, prefix_scan, running_count


def ack_pending(emitted: DataFrame, acks: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Emitted messages with no acknowledgement."""
    keys = keys or ["partition", "offset"]
    return emitted.join(acks.select(*keys), keys, "left_anti")


def ack_unknown(emitted: DataFrame, acks: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Acknowledgements of ids that were never emitted (the ledger warns)."""
    keys = keys or ["partition", "offset"]
    return acks.join(emitted.select(*keys), keys, "left_anti")


def fail_disposition(protocol: F.Column, requeue: F.Column) -> F.Column:
    """T2: 'requeue' | 'dead_letter' | 'abort' | 'drop' | 'replay'."""
    return (F.when(protocol == "amqp", F.when(requeue, F.lit("requeue")).otherwise(F.lit("dead_letter")))
            .when(protocol == "kestrel", F.lit("abort"))
            .when(protocol.isin("jms", "mqtt"), F.lit("drop"))
            .when(protocol == "kafka", F.lit("replay")))


PRUNE_COLUMNS = ["partition", "ack_seq", "offset", "action", "min_pending_before", "min_pending_after"]
#: Rank of an acknowledgement that never comes.
NEVER = 1 << 62


def pending_prune_unbounded(acks: DataFrame, emitted: DataFrame) -> DataFrame:
    """T3 without a bound (the reference's default ``maxOffsetBehind`` is
    Long.MAX_VALUE, so nothing is ever cleared): every ack just removes its
    offset, and the smallest pending offset after ack t has a parallel form.

    With acks ranked t = 1..n per partition by (ack_seq, offset), tau(p) the
    first rank acknowledging offset p (never: +inf) and A(p) the largest tau
    among lower offsets (0 for the lowest), offset p is the smallest pending
    one exactly while A(p) <= t < tau(p).  These intervals are disjoint and
    ordered, so each ack finds its offset with the blocked as-of lookup; the
    ranks and A(p) are blocked scans.  No step puts a partition in one task.
    Same output as ``pending_prune``."""
    # Each stage feeds scans that read it twice, so each is checkpointed.
    ranked = materialize(running_count(acks.select("partition", "offset", "ack_seq"), ["partition"],
                                       ["ack_seq", "offset"], "t"))
    tau = ranked.groupBy("partition", "offset").agg(F.min("t").alias("tau"))
    never = F.lit(1 << 62).cast("long")
    e = (emitted.select("partition", "offset").distinct()
         .join(tau, ["partition", "offset"], "left")
         .select("partition", "offset", F.coalesce(F.col("tau"), never).alias("tau")))
    a = prefix_scan(e, ["partition"], "offset", {"a": ("max", F.col("tau"))}, exclusive=True)
    intervals = materialize(
        a.select("partition", "offset", "tau", F.coalesce(F.col("a"), F.lit(0)).cast("long").alias("a"))
        .where(F.col("a") < F.col("tau")))
    value = F.struct(F.col("offset").alias("p"), F.col("tau").alias("tau"))
    facts = ranked.select("partition", "offset", "ack_seq", "t", (F.col("t") - 1).alias("t_before"))
    after = materialize(as_of(facts, "partition", "t", intervals, "partition", "a", value, "_after"))
    both = as_of(after, "partition", "t_before", intervals, "partition", "a", value, "_before")

    def pending_at(col: str, t: F.Column) -> F.Column:
        return F.when(F.col(f"{col}.tau") > t, F.col(f"{col}.p"))

    return both.select(
        "partition", "ack_seq", "offset", F.lit("remove").alias("action"),
        pending_at("_before", F.col("t_before")).cast("long").alias("min_pending_before"),
        pending_at("_after", F.col("t")).cast("long").alias("min_pending_after"))


def pending_prune_bounded(acks: DataFrame, emitted: DataFrame, max_offset_behind: int,
                          block_size: int = BLOCK, ranks: bool = False) -> DataFrame:
    """T3 with a bound B, in parallel.

    Acks are ranked t = 1..n per partition by (ack_seq, offset); tau(p) is the rank of the first ack of offset p.

    *What a clear leaves.*  A clear at (t, o) leaves the emitted offsets p > o with tau(p) > t, and o itself if this is
    its first ack (the clear spares its own offset): an earlier clear had a smaller offset, so every earlier ack of an
    offset above o was a removal.  That depends on (t, o) alone.

    *The next clear* after (t, o) is the first ack (s, q), s > t, below whose bound q - B something is pending: either
    an offset above o not acked before s -- the largest one below q - B, ``low(s)``, is above o -- or o itself, if it is
    pending and not acked again before s.  Both are "the first rank after t whose value is large enough" (``nearest``).
    So every ack has one successor, should it be a clear, and the first clear is the first ack with a ``low``.

    *Following the list.*  Within blocks of ranks every ack is linked to the last clear its list reaches there; between
    blocks the links are doubled, so the rounds grow with the logarithm of the number of blocks.

    *The smallest pending offset* after an ack is o while that is pending, else the first p > o with tau(p) > t.

    Acks of offsets that were never emitted can clear and remove nothing else; a repeated ack is a removal unless it
    clears.  Rows with a null partition or offset take no part.  No group holds more than about two blocks of rows.
    With ``ranks`` the result has the rank ``t`` as well."""
    known = F.col("partition").isNotNull() & F.col("offset").isNotNull()
    ranked = materialize(running_count(acks.where(known).select("partition", "offset", "ack_seq"), ["partition"],
                                       ["ack_seq", "offset"], "t", by_position=True))
    first = ranked.groupBy("partition", "offset").agg(F.min("t").alias("tau"), F.max("t").alias("last"), F.count("*").alias("times"))
    sent = emitted.where(known).select("partition", "offset").distinct()
    sent = materialize(sent.join(first, ["partition", "offset"], "left")
                       .select("partition", "offset", F.coalesce("tau", F.lit(NEVER)).alias("tau"), "last", "times"))
    own = sent.where(F.col("tau") < NEVER)  # of two acks the last is the second
    own = own.withColumn("tau2", F.when(F.col("times") == 1, F.lit(NEVER)).when(F.col("times") == 2, F.col("last")))
    more = own.where("times > 2").select("partition", "offset", "tau")
    if not more.isEmpty():
        again = ranked.join(more, ["partition", "offset"]).where("t > tau").groupBy("partition", "offset").agg(F.min("t").alias("second"))
        own = own.join(again, ["partition", "offset"], "left").withColumn("tau2", F.coalesce("tau2", "second"))
    bound = F.lit(max_offset_behind)
    ranked = ranked.join(own.select("partition", "offset", "tau", "tau2"), ["partition", "offset"], "left")
    ranked = ranked.select("partition", "offset", "ack_seq", "t", F.when(F.col("t") == F.col("tau"), F.col("tau2")).alias("spared_until"),
                           (F.col("offset") - bound).alias("below"))
    ranked = materialize(nearest(sent, ranked, "partition", "offset", "tau", "below", "t", "low", block_size=block_size))

    beyond = ranked.select("partition", "t", "spared_until", (F.col("offset") + 1).alias("over"),
                           F.when(F.col("spared_until").isNotNull(), F.col("offset") + bound + 1).alias("over_bound"))
    beyond = nearest(ranked, beyond, "partition", "t", "low", "t", "over", "by_low", ahead=True, block_size=block_size)
    beyond = nearest(ranked, materialize(beyond), "partition", "t", "offset", "t", "over_bound", "by_own", ahead=True, block_size=block_size)
    by_own = F.when(F.col("by_own") <= F.col("spared_until"), F.col("by_own"))
    links = materialize(beyond.select("partition", "t", F.least("by_low", by_own).alias("next")))
    roots = ranked.where("low is not null").groupBy("partition").agg(F.min("t").alias("t"))
    clears = follow(links, roots, block_size)

    # the regime of every ack: the last clear up to it
    marked = ranked.join(clears.withColumn("clear", F.lit(True)), ["partition", "t"], "left")
    last = F.when(F.col("clear"), F.struct("t", "offset", F.coalesce("spared_until", F.lit(0).cast("long")).alias("until")))
    marked = materialize(prefix_scan(marked.select("partition", "offset", "ack_seq", "t", "clear", last.alias("last")), ["partition"], "t", {"since": ("max", F.col("last"))}))
    ends = sent.agg(F.min("offset")).first()[0] or 0
    after = marked.select("partition", "offset", "ack_seq", "t", "clear", (F.col("since.until") > F.col("t")).alias("spared"),
                          F.coalesce("since.offset", F.lit(ends - 1)).alias("from"), (F.col("t") + 1).alias("later"))
    after = nearest(sent, after, "partition", "offset", "tau", "from", "later", "left", ahead=True, block_size=block_size)
    pending = F.when(F.col("spared"), F.col("from")).otherwise(F.col("left"))
    after = materialize(after.select("partition", "offset", "ack_seq", "t", "clear", pending.alias("min_pending_after")))
    # before an ack is after the one before it; before the first, all that was sent is pending
    held = F.struct("t", F.col("min_pending_after").alias("pending"))
    out = prefix_scan(after, ["partition"], "t", {"held": ("max", held)}, exclusive=True)
    start = sent.groupBy("partition").agg(F.min("offset").alias("pending"))  # a row a partition
    out = out.join(F.broadcast(start), "partition", "left")
    out = out.withColumn("min_pending_before", F.when(F.col("t") == 1, F.col("pending")).otherwise(F.col("held.pending")))
    out = out.withColumn("action", F.when(F.col("clear"), F.lit("clear")).otherwise(F.lit("remove")))
    return out.select("t", *PRUNE_COLUMNS) if ranks else out.select(*PRUNE_COLUMNS)


def _links_of(rows: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """A block's rows by rank, its ranks, and the next of each (-1 for none)."""
    rows = rows.sort_by("t")
    return rows, rows.column("t").to_numpy(), rows.column("next").combine_chunks().fill_null(-1).to_numpy()


def _to_exit(rows: pa.Table) -> pa.Table:
    """For every rank of a block, the first rank outside that its list leads to (null: it ends in the block)."""
    rows, t, nxt = _links_of(rows)
    inside = (nxt >= 0) & (nxt <= t[-1])
    to = np.where(inside, np.searchsorted(t, nxt), np.arange(len(t)))
    while True:
        further = to[to]
        if (further == to).all():
            break
        to = further
    return rows.select(["partition", "t"]).append_column("exit", pa.array(nxt[to], pa.int64(), mask=nxt[to] < 0))


def _on_list(rows: pa.Table) -> pa.Table:
    """The ranks of a block that its list, entered at ``entry``, goes through."""
    rows, t, nxt = _links_of(rows)
    on, at = [], rows.column("entry")[0].as_py()
    while t[0] <= at <= t[-1]:
        on.append(int(np.searchsorted(t, at)))
        at = int(nxt[on[-1]])
    return rows.select(["partition", "t"]).take(on)


def follow(links: DataFrame, roots: DataFrame, block_size: int = BLOCK) -> DataFrame:
    """(partition, t) of all nodes on the lists that begin at ``roots``, for links (partition, t, next) with t < next.

    Links are shortened within blocks of ranks, one group a block, and doubled between blocks: after k rounds a list is
    known 2^k blocks far.  Only nodes that some block's list enters take part in the doubling."""
    kind = links.schema["partition"].dataType.simpleString()
    blocks = links.withColumn("blk", F.floor(F.col("t") / block_size))
    exits = materialize(blocks.groupBy("partition", "blk").applyInArrow(_to_exit, f"partition {kind}, t long, exit long"))
    entered = exits.where("exit is not null").select("partition", F.col("exit").alias("t")).unionByName(roots.select("partition", "t")).distinct()
    jump = materialize(exits.join(entered, ["partition", "t"], "left_semi").where("exit is not null"))
    reached = materialize(roots.select("partition", "t"))
    while True:
        further = reached.join(jump, ["partition", "t"]).select("partition", F.col("exit").alias("t"))
        more = materialize(further.join(reached, ["partition", "t"], "left_anti"))
        if more.isEmpty():
            break
        reached = materialize(reached.unionByName(more))
        ahead = jump.select("partition", F.col("t").alias("exit"), F.col("exit").alias("far"))
        jump = materialize(jump.join(ahead, ["partition", "exit"]).select("partition", "t", F.col("far").alias("exit")))
    entry = reached.select("partition", F.floor(F.col("t") / block_size).alias("blk"), F.col("t").alias("entry"))
    on = blocks.join(entry, ["partition", "blk"])  # a list enters a block once
    return on.groupBy("partition", "blk").applyInArrow(_on_list, f"partition {kind}, t long")


def pending_prune(acks: DataFrame, emitted: DataFrame, max_offset_behind: int | None, block_size: int = BLOCK) -> DataFrame:
    """The decision taken for every ack, in ack order, with the smallest pending offset before and after it.
    ``acks``: (partition, offset, ack_seq); ``emitted``: (partition, offset).  ``max_offset_behind=None`` is no bound,
    so nothing is ever cleared."""
    if max_offset_behind is None:
        return pending_prune_unbounded(acks, emitted)
    return pending_prune_bounded(acks, emitted, max_offset_behind, block_size)


def prune_step(acks: DataFrame, bounds: DataFrame, low: DataFrame | None, removed: DataFrame | None,
               max_offset_behind: int, block_size: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """T3 on the next acks of a stream: (decisions, low, removed).

    ``bounds``: (partition, first_offset, next_offset) of what has been emitted, without gaps.  What earlier acks left
    is ``low`` (partition, low), the offset below which nothing is pending, and ``removed`` (partition, offset), the
    acked offsets above it; both None before the first.  Only offsets up to one beyond the largest acked are looked at, so
    a step grows with the acks and the out-of-order window, not with the partition."""
    known = F.col("partition").isNotNull() & F.col("offset").isNotNull()
    acks = materialize(acks.where(known).select("partition", "offset", "ack_seq"))
    at = bounds.select("partition", "first_offset", "next_offset")
    at = at.withColumn("low", F.col("first_offset")) if low is None else (
        at.join(low, "partition", "left").withColumn("low", F.coalesce("low", "first_offset")))
    at = materialize(at)
    acked = acks.select("partition", "offset") if removed is None else acks.select("partition", "offset").unionByName(removed)
    top = acked.groupBy("partition").agg(F.max("offset").alias("top"))
    reach = at.join(top, "partition").select("partition", "low", F.least(F.col("next_offset") - 1, F.greatest(F.col("top") + 1, "low")).alias("high"))
    runs = reach.where("low <= high").select("partition", "high", F.explode(F.sequence("low", "high", F.lit(BLOCK).cast("long"))).alias("start"))
    runs = runs.repartition("partition", "start")
    window = runs.select("partition", F.explode(F.sequence("start", F.least("high", F.col("start") + BLOCK - 1))).alias("offset"))
    if removed is not None:
        window = window.join(removed, ["partition", "offset"], "left_anti")
    decisions = materialize(pending_prune_bounded(acks, window, max_offset_behind, block_size, ranks=True))

    ends = decisions.groupBy("partition").agg(F.max_by(F.struct("min_pending_after"), "t").alias("end")).join(reach, "partition")
    ends = ends.select("partition", F.coalesce("end.min_pending_after", F.greatest("low", F.col("high") + 1)).alias("now"))
    moved = materialize(at.join(ends, "partition", "left").select("partition", F.coalesce("now", "low").alias("low"), "next_offset"))
    gone = decisions.where("action = 'remove'").select("partition", "offset")
    gone = gone if removed is None else gone.unionByName(removed)
    gone = gone.join(moved, "partition").where("offset > low and offset < next_offset").select("partition", "offset").distinct()
    return decisions.select(*PRUNE_COLUMNS), moved.select("partition", "low"), gone
