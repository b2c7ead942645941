"""Keyed state with event-time timers: the ack ledger (T1) and auto-abort."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sluice.streaming import ledger
from sluice.streaming.pipelines import FILES_PER_BATCH, admission, fresh_dir

MINUTE = 60_000


def land(spark, path, rows, schema):
    """The rows as one micro-batch of a landed log; times are minutes from some day (a stream's watermark begins at the
    epoch, and what is not after it is late)."""
    df = spark.createDataFrame(rows, schema).withColumn("at", F.timestamp_millis(((F.col("minute") + 28_000_000) * MINUTE).cast("long"))).drop("minute")
    df.repartition(FILES_PER_BATCH).write.mode("append").parquet(path)


def stream(spark, path):
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).options(**admission(max_files=FILES_PER_BATCH)).parquet(path)


def test_ledger_survives_a_restart_between_emit_and_ack(spark):
    base = fresh_dir(spark, "test-ledger")
    schema = "origin string, partition int, message_id string, kind string, minute double"
    run = lambda: ledger.run_to_end(ledger.ack_ledger(stream(spark, f"{base}/log"), "1 minute", wait_ms=10 * MINUTE, ttl_ms=100 * MINUTE, tick_ms=MINUTE, shards=3),
                                    f"{base}/out", f"{base}/ckpt")
    out = lambda: sorted((r.message_id, r.outcome) for r in spark.read.schema(ledger.LEDGER_OUT).parquet(f"{base}/out").collect())
    land(spark, f"{base}/log", [("q", 0, "a", "emit", 0.0), ("q", 0, "b", "emit", 0.0), ("q", 0, "c", "emit", 1.0), ("q", 0, "c", "ack", 1.5), ("q", 1, "early", "ack", 2.0),
                                ("q", 1, "never", "ack", 2.0), ("q", None, "a", "emit", 2.0), ("q", 0, None, "emit", 2.0)], schema)
    run()
    assert out() == [("c", "acked")]
    assert sorted((r.partition is None, r.message_id) for r in ledger.pending_now(spark, f"{base}/ckpt").collect()) == [(False, "a"), (False, "b"), (True, "a")]
    assert sorted(r.message_id for r in ledger.pending_now(spark, f"{base}/ckpt", "early").collect()) == ["early", "never"]
    # the acks come after the restart; a message and its early ack meet; a repeated ack finds nothing
    land(spark, f"{base}/log", [("q", 0, "a", "ack", 5.0), ("q", 1, "early", "emit", 5.0), ("q", 0, "c", "ack", 6.0), ("q", 0, "a", "ack", 6.0), ("q", 0, "a", "ack", 6.5)], schema)
    run()
    assert out() == [("a", "acked"), ("a", "unknown"), ("a", "unknown"), ("c", "acked"), ("early", "acked")]
    # only another partition's clock moves on: waits and lifetimes end without a row of their group
    land(spark, f"{base}/log", [("other", 9, "z", "emit", 500.0)], schema)
    run()
    assert out() == [("a", "acked"), ("a", "expired"), ("a", "unknown"), ("a", "unknown"), ("b", "expired"), ("c", "acked"), ("c", "unknown"), ("early", "acked"), ("never", "unknown")]
    assert [r.message_id for r in ledger.pending_now(spark, f"{base}/ckpt").collect()] == ["z"]


def test_idle_queue_returns_its_items(spark):
    base = fresh_dir(spark, "test-timers")
    schema = "queue string, seq long, kind string, auto_abort_ms long, minute double"
    run = lambda: ledger.run_to_end(ledger.auto_abort_timers(stream(spark, f"{base}/log"), "1 minute", tick_ms=MINUTE, shards=2), f"{base}/out", f"{base}/ckpt")
    out = lambda: sorted((r.queue, r.seq, r.new_state, r.txn_id) for r in spark.read.schema(ledger.ABORT_OUT).parquet(f"{base}/out").collect())
    land(spark, f"{base}/log", [("idle", 1, "open", 10 * MINUTE, 0.0), ("idle", 2, "open", 0, 0.0), ("idle", 3, "open", 90 * MINUTE, 0.0), ("busy", 4, "confirm", None, 0.5),
                                ("busy", 5, "open", 10 * MINUTE, 1.0)], schema)
    run()
    assert out() == [("idle", 2, "confirmed", 0)]
    assert sorted(r.seq for r in ledger.open_now(spark, f"{base}/ckpt").collect()) == [1, 3, 5]
    land(spark, f"{base}/log", [("busy", 4, "open", 10 * MINUTE, 2.0), ("busy", 5, "confirm", None, 3.0), ("busy", 6, "open", 100 * MINUTE, 30.0)], schema)
    run()  # the watermark is at minute 29; nothing happened in the idle queue
    assert out() == [("busy", 4, "confirmed", 4), ("busy", 5, "confirmed", 5), ("idle", 1, "waiting", 1), ("idle", 2, "confirmed", 0)]
    assert sorted(r.seq for r in ledger.open_now(spark, f"{base}/ckpt").collect()) == [3, 6]


class Counted:
    """A state handle that keeps its states and timers in memory and counts the calls."""

    def __init__(self):
        self.calls, self.timers, self.states = 0, set(), {}

    def _state(self, name, *schema):
        handle, held = self, self.states.setdefault(name, {})

        class State:
            def __getattr__(self, call):
                def made(*args):
                    handle.calls += 1
                    return {"get": lambda: held.get("value"), "update": lambda v: held.update(value=v), "clear": held.clear, "containsKey": lambda k: k in held,
                            "getValue": lambda k: held[k], "updateValue": held.__setitem__, "removeKey": held.pop, "iterator": lambda: iter([*held.items()])}[call](*args)
                return made
        return State()

    getValueState = getMapState = _state

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.discard(at)

    def listTimers(self):
        self.calls += 1
        return iter([*self.timers])


class Watermark:
    def __init__(self, ms):
        self.getCurrentWatermarkInMs = self.getExpiryTimeInMs = lambda: ms


@pytest.mark.parametrize("made, column, key", [(lambda: ledger.AckLedger(MINUTE, MINUTE, MINUTE), "message_id", ("q", 0, 0)), (lambda: ledger.AutoAbort(MINUTE, MINUTE), "seq", ("q", 0))])
def test_state_calls_do_not_grow_with_the_messages(made, column, key):
    calls = []
    for n in (10, 3000):
        handle, processor = Counted(), made()
        processor.init(handle)
        ids = list(range(n)) if column == "seq" else [str(i) for i in range(n)]
        at = [1_000_000 + 50 * MINUTE * i // n for i in range(n)]  # due in some fifty ticks
        rows = pd.DataFrame({"kind": "open" if column == "seq" else "emit", column: ids, "at": pd.to_datetime(at, unit="ms"), "at_ms": at, "auto_abort_ms": MINUTE})
        [*processor.handleInputRows(key, iter([rows]), Watermark(0))]
        out = [f for t in sorted(handle.timers) for f in processor.handleExpiredTimer(key, Watermark(10 ** 9), Watermark(t))]
        assert sorted(x for f in out for x in f[column]) == sorted(ids)
        assert not any(handle.states.values())
        calls.append(handle.calls)
    assert calls[0] == calls[1] < 40


def test_timers_settle_what_is_due_and_keep_the_rest(spark):
    """A due time equal to the watermark, and of several due times the later ones."""
    base = fresh_dir(spark, "test-due")
    schema = "origin string, partition int, message_id string, kind string, minute double"
    run = lambda: ledger.run_to_end(ledger.ack_ledger(stream(spark, f"{base}/log"), "0 seconds", wait_ms=2 * MINUTE, ttl_ms=10 * MINUTE, tick_ms=MINUTE, shards=1),
                                    f"{base}/out", f"{base}/ckpt")
    out = lambda: sorted((r.message_id, r.outcome) for r in spark.read.schema(ledger.LEDGER_OUT).parquet(f"{base}/out").collect())
    held = lambda: sorted(r.message_id for r in ledger.pending_now(spark, f"{base}/ckpt").collect())
    land(spark, f"{base}/log", [("q", 0, f"m{i}", "emit", i / 2) for i in range(10)], schema)
    run()
    assert (out(), held()) == ([], [f"m{i}" for i in range(10)])
    land(spark, f"{base}/log", [("z", 0, "clock", "emit", 12.0)], schema)
    run()
    assert (out(), held()) == ([(f"m{i}", "expired") for i in range(5)], ["clock", *(f"m{i}" for i in range(5, 10))])
    land(spark, f"{base}/log", [("q", 0, "m7", "ack", 12.5), ("z", 0, "clock", "ack", 14.0)], schema)
    run()
    assert out() == sorted([*((f"m{i}", "expired") for i in (0, 1, 2, 3, 4, 5, 6, 8)), ("m7", "acked"), ("clock", "acked")])
    assert held() == ["m9"]
