"""Commits at a cadence (A4), replay of failures (J8), stop on failures (A5, U4), offsets for times."""

import datetime as dt
import random

from pyspark.sql import functions as F

from sluice.functions.scalars import read_saved_offset
from sluice.operators import decode, offsets
from sluice.streaming import listeners
from sluice.streaming import pipelines as sp


def saved_in(spark, base):
    return listeners.SavedOffsets(spark, f"{base}/saved", "A", "t", "h", 1, "topic")


def points(spark, rows):
    return spark.createDataFrame(rows, "partition int, commit_offset long")


def test_only_changed_points_are_written(spark):
    base = sp.fresh_dir(spark, "test-saved")
    saved = saved_in(spark, base)
    assert saved.commit(points(spark, [(0, 5), (1, 7)])) and not saved.commit(points(spark, [(0, 5), (1, 7)]))
    assert saved.version == 1
    stale = saved_in(spark, base)
    assert saved.commit(points(spark, [(0, 9), (1, 7)])) and stale.version == 1
    assert stale.commit(points(spark, [(1, 8)])) and stale.version == 3  # goes on from what the other one saved
    got = {r["partition"]: r for r in stale.read().select("*", read_saved_offset(F.col("document")).alias("d")).collect()}
    assert {p: r.saved_offset for p, r in got.items()} == {0: 9, 1: 8} == {p: r.d["offset"] for p, r in got.items()}


class Event:
    def __init__(self, run, batch=None, counts=None):
        self.runId = run
        self.progress = self
        self.batchId = batch
        self.observedMetrics = {listeners.LEDGER_METRICS: counts} if counts else {}


def test_at_most_one_commit_an_interval(spark):
    base = sp.fresh_dir(spark, "test-saved")
    now = [0.0]
    cadence = listeners.CommitCadence(saved_in(spark, base), lambda b: points(spark, [(0, b)]), clock=lambda: now[0])
    cadence.onQueryStarted(Event("a"))
    cadence.onQueryStarted(Event("other"))
    for i in range(12):  # a batch every 0.5 seconds
        now[0] += 0.5
        cadence.onQueryProgress(Event("a", i))
        cadence.onQueryProgress(Event("other", 100 + i))
    assert cadence.committed == [3, 7, 11]
    cadence.onQueryProgress(Event("a", 12))
    cadence.onQueryTerminated(Event("a"))
    assert cadence.committed == [3, 7, 11, 12] and cadence.failure is None
    cadence.onQueryTerminated(Event("a"))  # nothing new
    assert cadence.committed == [3, 7, 11, 12]


def test_stream_is_stopped_when_all_fails(spark):
    base = sp.fresh_dir(spark, "test-guard")
    for good in (False, True):
        rows = spark.range(40).select(F.when((F.col("id") == 0) & F.lit(good), F.encode(F.lit('{"k": 1}'), "UTF-8")).otherwise(F.encode(F.lit("bad"), "UTF-8")).alias("value"), F.lit("kafka").alias("protocol"))
        for _ in range(3):
            rows.coalesce(1).write.mode("append").parquet(f"{base}/{good}/in")
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/{good}/in")
        d = decode.decode(stream, sp.BODY)
        seen = listeners.observed(d, F.col("dead_reason").isNull(), F.col("dead_reason").isNotNull())
        guard = listeners.FailureGuard(spark, 50)
        spark.streams.addListener(guard)
        try:
            q = seen.writeStream.format("parquet").option("path", f"{base}/{good}/out").option("checkpointLocation", f"{base}/{good}/c").start()
            if good:
                q.processAllAvailable()
                listeners.heard(spark)
                assert guard.reason is None and guard.acked == 3 and guard.failed == 117
                q.stop()
                dead = spark.read.parquet(f"{base}/True/out").where("dead_reason is not null")
                assert guard.failed == dead.count()
            else:
                q.awaitTermination(60)
                assert not q.isActive and guard.reason == "80 messages failed and none was acked"
        finally:
            spark.streams.removeListener(guard)


def test_each_failure_is_replayed_once(spark):
    base = sp.fresh_dir(spark, "test-replay")
    messages = spark.createDataFrame([(p, o, f"{p}:{o}") for p in (0, 1) for o in range(10)], "partition int, offset long, value string")
    log = [("message", 0, o, 0) for o in range(5)] + [("fail", 0, 3, 0), ("fail", 0, 1, 0), ("fail", 0, 3, 0), ("fail", 1, 9, 0),
           ("message", 0, 5, 1), ("fail", 0, 3, 1), ("message", 0, 6, 2), ("fail", 0, 6, 2), ("message", 1, 0, 3)]
    path = sp.land_steps(spark.createDataFrame(log, "kind string, partition int, offset long, step int"), "step", 4, "replay", files=1)
    sp.replay_stream(sp.landed_stream(spark, path, files=1), messages, f"{base}/out", f"{base}/ckpt")
    got = sorted((r.batch, r.partition, r.offset, r.replay_from, r.value) for r in spark.read.parquet(f"{base}/out/replayed").collect())
    assert got == [(1, 0, 1, 1, "0:1"), (1, 0, 3, 1, "0:3"), (1, 1, 9, 9, "1:9"), (2, 0, 3, 3, "0:3"), (3, 0, 6, 6, "0:6")]
    assert spark.read.parquet(f"{base}/out/emitted").count() == 8


def test_offsets_for_any_time(spark):
    rnd = random.Random(4)
    t0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [(p, o, t0 + dt.timedelta(minutes=o + rnd.randint(-90, 90)) if o % 9 else None) for p in (0, 1) for o in range(3, 400)]
    msgs = spark.createDataFrame(rows, "partition int, offset long, ts timestamp")
    ms = lambda t: int(t.timestamp() * 1000)
    times = [-1, -2, 0, ms(t0), ms(t0 + dt.timedelta(days=9))] + [ms(t0) + rnd.randint(-10**7, 3 * 10**7) for _ in range(25)]
    asked = spark.createDataFrame([(p, t, "x") for p in (0, 1, 2) for t in times], "partition int, time_ms long, note string")
    for r in offsets.offsets_for_times(msgs, asked).collect():
        own = [(o, t) for p, o, t in rows if p == r.partition]
        if not own:
            want = -5
        elif r.time_ms == -2:
            want = 3
        else:
            want = min((o for o, t in own if t is not None and r.time_ms >= 0 and ms(t) >= r.time_ms), default=400)
        assert r.offset_at == want and r.note == "x"
