"""Keyed broker state with event-time timers: the ack ledger (T1) and auto-abort.

Both are ``transformWithState`` processors.  A broker partition or queue can hold a third of all messages, so the
grouping key is (partition or queue, shard) with the shard taken from the message: the state and the work of a hot
partition are spread over ``shards`` groups, and no group has to see another's messages.

A processor in Python pays a round trip for every call to its state, so a group's entries are one value of two arrays:
read once and written once for a micro-batch or a timer, however many messages it settles.  ``shards`` is to be chosen
so that what is pending of a group fits in a task.

Time is event time.  Timers fire when the watermark passes them, for groups without any input as well.  Due times are
rounded up to ``tick_ms``; a group has one timer, at its earliest, which settles all that the watermark has passed.
Rows later than the watermark are dropped by Spark, so its delay has to cover the disorder of the input.

The state lives in the RocksDB state store below the query's checkpoint, which is how it survives a restart; what is
pending right now is read from there (``pending_now``).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.stateful_processor import ValueState

STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TICK_MS = 600_000
SHARDS = 16


@contextmanager
def rocksdb_state(spark: SparkSession):
    """The state store that ``transformWithState`` needs, for queries started inside."""
    before = spark.conf.get(STORE_CONF, None)
    spark.conf.set(STORE_CONF, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STORE_CONF)
        else:
            spark.conf.set(STORE_CONF, before)


def _tick(ms: int, tick: int) -> int:
    return -(-ms // tick) * tick


class Entries:
    """A group's entries, id -> time, in memory between one read and one write of its value state."""

    def __init__(self, state: ValueState):
        self.state = state
        self.was = state.get()
        self.at = dict(zip(*self.was, strict=True)) if self.was is not None else {}

    def due(self, wait: int, tick: int, now: int) -> list[tuple]:
        """The entries whose wait is over, which leave."""
        last = now // tick * tick - wait  # of what is due by then
        over = [(i, at) for i, at in self.at.items() if at <= last]
        for i, _ in over:
            del self.at[i]
        return over

    def next(self, wait: int, tick: int) -> list[int]:
        """The due time of the earliest entry, if there is one."""
        return [_tick(min(self.at.values()) + wait, tick)] if self.at else []

    def write(self) -> None:
        if not self.at:
            if self.was is not None:
                self.state.clear()
            return
        now = (list(self.at), list(self.at.values()))
        if self.was is None or now != (list(self.was[0]), list(self.was[1])):
            self.state.update(now)


def _set_timer(handle: StatefulProcessorHandle, due: list[int]) -> None:
    """One timer for the group, at the earliest of the due times."""
    at = min(due, default=None)
    kept = False
    for t in list(handle.listTimers()):
        kept |= t == at
        if t != at:
            handle.deleteTimer(t)
    if at is not None and not kept:
        handle.registerTimer(at)


# ------------------------------------------------------------------ ack ledger

LEDGER_OUT = "origin string, partition int, message_id string, outcome string, at_ms long"


class AckLedger(StatefulProcessor):
    """State of a group: ``pending`` (message id -> emit time) and ``early`` (id -> time of an ack that came first)."""

    def __init__(self, wait_ms: int, ttl_ms: int, tick_ms: int):
        self.wait_ms, self.ttl_ms, self.tick_ms = wait_ms, ttl_ms, tick_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getValueState("pending", "message_id array<string>, at_ms array<long>")
        self.early = handle.getValueState("early", "message_id array<string>, at_ms array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        emits: dict[str, int] = {}
        acks: dict[str, list[int]] = {}
        for part in rows:
            for kind, mid, at in zip(part["kind"], part["message_id"], part["at_ms"].tolist(), strict=True):
                if kind == "emit":
                    emits[mid] = min(at, emits.get(mid, at))
                else:
                    acks.setdefault(mid, []).append(at)
        pending, early = Entries(self.pending), Entries(self.early)
        out = []
        for mid, times in acks.items():
            times.sort()
            if mid in emits:
                del emits[mid]
            elif mid in pending.at:
                del pending.at[mid]
            else:  # its message may still come
                if mid not in early.at:
                    early.at[mid] = times.pop(0)
                out += [(mid, "unknown", t) for t in times]
                continue
            out.append((mid, "acked", times[0]))
            out += [(mid, "unknown", t) for t in times[1:]]
        for mid, at in emits.items():
            if mid in early.at:
                out.append((mid, "acked", early.at.pop(mid)))
            else:
                pending.at[mid] = at
        self._keep(pending, early)
        yield self._frame(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        pending, early = Entries(self.pending), Entries(self.early)
        out = [(mid, "expired", at) for mid, at in pending.due(self.ttl_ms, self.tick_ms, now)]
        out += [(mid, "unknown", at) for mid, at in early.due(self.wait_ms, self.tick_ms, now)]
        self._keep(pending, early)
        yield self._frame(key, out)

    def _keep(self, pending: Entries, early: Entries) -> None:
        pending.write()
        early.write()
        _set_timer(self.handle, pending.next(self.ttl_ms, self.tick_ms) + early.next(self.wait_ms, self.tick_ms))

    @staticmethod
    def _frame(key, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame([(key[0], key[1], *r) for r in rows], columns=["origin", "partition", "message_id", "outcome", "at_ms"])

    def close(self) -> None:
        pass


def ack_ledger(log: DataFrame, delay: str = "10 minutes", wait_ms: int = 600_000, ttl_ms: int = 86_400_000,
               tick_ms: int = TICK_MS, shards: int = SHARDS) -> DataFrame:
    """T1 on a stream of (origin, partition, message_id, kind, at), kind 'emit' or 'ack': one row for each message that
    leaves the ledger and each ack that finds none, with ``outcome``

    * 'acked': an ack met its message, whichever came first;
    * 'unknown': an ack whose message had not come ``wait_ms`` after it (by the watermark).  A ledger forgets what is
      settled, so a second ack of a message is one too;
    * 'expired': a message that got no ack within ``ttl_ms``.

    A message that is emitted again while pending is the same entry.  Rows with a null id or time take no part."""
    log = log.where(F.col("message_id").isNotNull() & F.col("at").isNotNull()).withWatermark("at", delay)
    keyed = log.select("origin", "partition", "message_id", "kind", "at", F.unix_millis("at").alias("at_ms"), F.pmod(F.xxhash64("message_id"), F.lit(shards)).cast("int").alias("shard"))
    return keyed.groupBy("origin", "partition", "shard").transformWithStateInPandas(
        AckLedger(wait_ms, ttl_ms, tick_ms), LEDGER_OUT, "append", "eventTime")


def pending_now(spark: SparkSession, checkpoint: str, state: str = "pending") -> DataFrame:
    """(origin, partition, message_id, at_ms) of what a ledger's map state holds after its last batch: 'pending'
    messages, or 'early' acks whose message has not come yet."""
    with rocksdb_state(spark):
        held = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", state).load()
    return held.select("key.origin", "key.partition", F.inline(F.arrays_zip("value.message_id", "value.at_ms")))


# ------------------------------------------------------------------ auto-abort

ABORT_OUT = "queue string, seq long, new_state string, txn_id long, at_ms long"


class AutoAbort(StatefulProcessor):
    """State of a group: ``open`` (seq -> deadline) of fetched items, and ``early`` (seq -> time) of confirms that came
    before their item."""

    def __init__(self, wait_ms: int, tick_ms: int):
        self.wait_ms, self.tick_ms = wait_ms, tick_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "seq array<long>, deadline_ms array<long>")
        self.early = handle.getValueState("early", "seq array<long>, at_ms array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        opened: dict[int, tuple[int, int]] = {}
        confirmed: dict[int, int] = {}
        for part in rows:
            for kind, seq, at, abort in zip(part["kind"], part["seq"].tolist(), part["at_ms"].tolist(), part["auto_abort_ms"].tolist(), strict=True):
                if kind == "open":
                    opened[seq] = (at, abort)
                else:
                    confirmed[seq] = min(at, confirmed.get(seq, at))
        held, early = Entries(self.open), Entries(self.early)
        out = []
        for seq, (at, abort) in opened.items():
            if abort == 0:  # confirmed when it is fetched
                out.append((seq, "confirmed", 0, at))
                continue
            by = confirmed.pop(seq, None)
            if by is None:
                by = early.at.pop(seq, None)
            if by is not None and by < at + abort:
                out.append((seq, "confirmed", seq, by))
            else:
                held.at[seq] = at + abort
        for seq, at in confirmed.items():
            if seq not in held.at:
                early.at[seq] = at
            elif at < held.at[seq]:  # a later one comes after the abort
                del held.at[seq]
                out.append((seq, "confirmed", seq, at))
        self._keep(held, early)
        yield self._frame(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        held, early = Entries(self.open), Entries(self.early)
        out = [(seq, "waiting", seq, deadline) for seq, deadline in held.due(0, self.tick_ms, now)]
        early.due(self.wait_ms, self.tick_ms, now)
        self._keep(held, early)
        yield self._frame(key, out)

    def _keep(self, held: Entries, early: Entries) -> None:
        held.write()
        early.write()
        _set_timer(self.handle, held.next(0, self.tick_ms) + early.next(self.wait_ms, self.tick_ms))

    @staticmethod
    def _frame(key, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame([(key[0], *r) for r in rows], columns=["queue", "seq", "new_state", "txn_id", "at_ms"])

    def close(self) -> None:
        pass


def auto_abort_timers(log: DataFrame, delay: str = "0 seconds", wait_ms: int = 600_000, tick_ms: int = TICK_MS, shards: int = SHARDS) -> DataFrame:
    """D6 on a stream of (queue, seq, kind, at, auto_abort_ms), kind 'open' or 'confirm': one row for each item that is
    decided, with ``new_state`` 'confirmed' or 'waiting' and the time of the decision.

    An item with ``auto_abort_ms`` 0 is confirmed when it is fetched, with transaction id 0.  Another is confirmed by a
    confirm before its deadline (fetch time + ``auto_abort_ms``); one that has none returns to its queue when the
    watermark passes the deadline, whether or not anything happens in that queue.  A confirm that comes before its item
    is kept for ``wait_ms``.  Rows with a null seq or time take no part."""
    log = log.where(F.col("seq").isNotNull() & F.col("at").isNotNull()).withWatermark("at", delay)
    keyed = log.select("queue", F.col("seq").cast("long").alias("seq"), "kind", "at", F.unix_millis("at").alias("at_ms"), F.coalesce(F.col("auto_abort_ms").cast("long"), F.lit(0)).alias("auto_abort_ms"),
                       F.pmod(F.xxhash64("seq"), F.lit(shards)).cast("int").alias("shard"))
    return keyed.groupBy("queue", "shard").transformWithStateInPandas(AutoAbort(wait_ms, tick_ms), ABORT_OUT, "append", "eventTime")


def open_now(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(queue, seq, deadline_ms) of the items that are open after the query's last batch."""
    with rocksdb_state(spark):
        held = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "open").load()
    return held.select("key.queue", F.inline(F.arrays_zip("value.seq", "value.deadline_ms")))


def run_to_end(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append ``df``'s rows to Parquet files at ``out`` until its sources have no more, then stop."""
    with rocksdb_state(df.sparkSession):
        q = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
    return q
