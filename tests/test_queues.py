"""Queue operators D4-D9, A2, A6 with edge rows."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from sluice.operators import queues

ITEM = ("queue string, seq long, value string, put_at timestamp, expiration_ms long, state string, "
        "opened_at timestamp, auto_abort_ms long")
T0 = datetime(2020, 1, 1, tzinfo=timezone.utc)


def obs():
    return F.lit("2020-01-02 00:00:00").cast("timestamp")   # session is UTC
DAY = 86_400_000


def items(spark):
    rows = [
        ("a", 1, "x1", T0, DAY, "waiting", None, 0),            # age exactly = expiration: kept
        ("a", 2, "x22", T0, DAY - 1, "waiting", None, 0),       # expired
        ("a", 3, "x333", T0, 0, "waiting", None, 0),            # expiration 0: never
        ("a", 4, "x4", T0 + timedelta(hours=1), DAY, "waiting", None, 0),
        ("a", 5, "o5", T0, 0, "open", T0, 0),                   # auto_abort 0: confirmed at once
        ("a", 6, "o6", T0, 0, "open", T0, DAY - 1),             # deadline passed: back to waiting
        ("a", 7, "o7", T0, 0, "open", T0, DAY),                 # exactly at the deadline: still open
        ("b", 1, "y1", T0, 0, "confirmed", None, 0),
    ]
    return spark.createDataFrame(rows, ITEM)


def test_expire_and_get(spark):
    it = items(spark)
    assert sorted(r.seq for r in queues.expire(it, obs()).where("queue = 'a'").collect()) == [1, 3, 4]
    assert [r.seq for r in queues.expired(it, obs()).collect()] == [2]
    got = [(r.seq, r.position) for r in queues.get(it, obs(), 2).orderBy("seq").collect()]
    assert got == [(1, 1), (3, 2)]


def test_auto_abort(spark):
    got = {r.seq: (r.new_state, r.txn_id) for r in queues.auto_abort(items(spark), obs()).where("queue='a'").collect()}
    assert got[5] == ("confirmed", 0) and got[6] == ("waiting", 6) and got[7] == ("open", 7)
    assert got[1] == ("waiting", 1)


def test_confirm_abort_counts(spark):
    it = items(spark)
    ids = spark.createDataFrame([("a", 5), ("a", 1), ("a", 99)], "queue string, seq long")
    left = sorted(r.seq for r in queues.confirm(it, ids).where("queue='a'").collect())
    assert left == [1, 2, 3, 4, 6, 7]                      # only the open item 5 is confirmed
    ab = {r.seq: r.state for r in queues.abort(it, ids).where("queue='a'").collect()}
    assert ab[5] == "waiting" and ab[1] == "waiting" and ab[6] == "open"
    cnt = queues.op_counts(it.where("seq < 3"), ids.where("seq = 5"), ids.where("seq = 1")).collect()
    assert {r.queue: (r.put_count, r.confirm_count, r.abort_count) for r in cnt} == {"a": (2, 1, 1), "b": (1, 0, 0)}


def test_put_with_capacity(spark):
    puts = spark.createDataFrame([("a", s, "v", 0) for s in (10, 11, 12)] + [("c", 1, "v", 0)],
                                 "queue string, seq long, value string, expiration_ms long")
    waiting = queues.expire(items(spark), obs())             # queue a: 3 waiting
    limits = spark.createDataFrame([("a", 5), ("b", 0)], "queue string, capacity long")
    got = {(r.queue, r.seq): r.accepted for r in queues.put_with_capacity(puts, waiting, limits, 2).collect()}
    assert got == {("a", 10): True, ("a", 11): True, ("a", 12): False, ("c", 1): True}


def test_info_flush_delete(spark):
    it = items(spark)
    info = {r.queue: r for r in queues.queue_info(it, obs()).collect()}
    a = info["a"]
    assert (a.items, a.bytes, a.open_transactions, a.head_item) == (3, 2 + 4 + 2, 3, "x1")
    assert a.age_ms == DAY
    fl = {r.queue: r.items for r in queues.queue_info(queues.flush(it, ["a"]), obs(), it.select("queue")).collect()}
    assert fl == {"a": 0, "b": 0}
    de = [r.queue for r in queues.queue_info(queues.delete_queue(it, ["a"]), obs()).collect()]
    assert de == ["b"]
