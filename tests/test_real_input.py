"""Inputs a broker really sends: odd bytes, header clashes, redeliveries, null measurements, several micro-batches."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators import decode, latency, offsets, queues, routing
from sluice.plans import catalogue
from sluice.session import checkpoint_dir
from sluice.sources import landed
from sluice.streaming import pipelines
from tests.conftest import SF_SMALL

BODY = T.StructType([T.StructField("k", T.LongType())])


def test_any_body_gets_a_label(spark):
    bodies = [b'{"k": 1}', b"\xff\xfe{", b'{"k":1}garbage', b'{"k":1}{"k":2}', b'{"k":1},{"k":2}', b"", None, b'{"x":1}', b"[]", b"]["]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, value binary")
    got = {r["i"]: (r["decoded"]["k"], r["dead_reason"]) for r in decode.decode(df, BODY).collect()}
    assert got[0] == (1, None) and got[7] == (None, "empty_tuple") and got[5][1] == got[6][1] == "empty"
    assert all(got[i] == (None, "undecodable") for i in (1, 2, 3, 4, 9)) and got[8][1] in ("undecodable", "empty_tuple")


@pytest.mark.parametrize("protocol", ["kafka", "amqp", "jms", "mqtt", "kestrel"])
def test_good_and_dead_add_up(spark, protocol):
    n = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    want = n.count() + n.where(F.col("event_id") % 29 == 0).count()
    out = catalogue.queries()[f"source_{protocol}"](spark, SF_SMALL).cache()
    good, dead = out.where("dead_reason is null").count(), out.where("dead_reason is not null").count()
    assert good and dead and good + dead == want


def test_repeated_kafka_headers(spark):
    row = [(b"k", b"v", "t", 0, 1, None, 0, [("a", b"1"), ("b", b"\xff"), ("a", b"2"), (None, b"3")])]
    h = landed.kafka_to_envelope(spark.createDataFrame(row, landed.KAFKA_SOURCE)).first()["headers"]
    assert h["a"] == "2" and h["b"] is None and set(h) == {"a", "b", "time"}


def test_null_latency_does_not_count(spark):
    rows = spark.createDataFrame([(0, 1, 0, 5), (0, 2, 10_000, 10), (0, 3, 20_000, None), (0, 4, 30_000, 20)], "task int, seq long, arrival_ms long, val long")
    assert [(r["seq"], r["mean_latency"]) for r in latency.running_latency(rows).orderBy("seq").collect()] == [(2, 10.0), (4, 15.0)]
    means, state = latency.running_latency_from(rows, None)
    assert [(r["seq"], r["mean_latency"]) for r in means.orderBy("seq").collect()] == [(2, 10.0), (4, 15.0)]
    assert state.first()["count"] == 2


def test_last_put_of_a_path_wins(spark):
    paths = spark.createDataFrame([("p", "z", 1), ("p", "a", 2)], "path string, destination string, seq long")
    msgs = spark.createDataFrame([("m",)], "id string")
    live = spark.createDataFrame([("a",), ("z",)], "name string")
    assert routing.route_two_hop(msgs, F.lit("p"), paths, live).first()["destination"] == "a"


def test_start_offsets_as_a_table(spark):
    msgs = spark.createDataFrame([(0, 1), (0, 5), (1, 2)], "partition int, offset long")
    plan = spark.createDataFrame([(0, 4)], "partition_id int, start_offset long")
    assert sorted(map(tuple, offsets.from_start_offsets(msgs, plan).collect())) == [(0, 5), (1, 2)]


def test_get_beyond_the_group_limit_and_its_state(spark):
    items = spark.range(3000).select(F.lit("q").alias("queue"), F.col("id").alias("seq"), F.lit("v").alias("value"), F.lit(0).cast("long").alias("expiration_ms"),
                                     F.timestamp_seconds(F.lit(0)).alias("put_at"), F.lit("waiting").alias("state"), F.lit(None).cast("timestamp").alias("opened_at"),
                                     (F.col("id") % 2 * 1000).alias("auto_abort_ms"))
    at = F.timestamp_seconds(F.lit(100))
    got = queues.get(items, at)
    assert got.count() == 1024 and got.agg(F.max("seq")).first()[0] == 1023
    after = queues.get_state(items, at).cache()
    assert {r["state"]: r["count"] for r in after.groupBy("state").count().collect()} == {"waiting": 1976, "open": 512, "confirmed": 512}
    again = queues.auto_abort(after.drop("txn_id"), F.timestamp_seconds(F.lit(102)))
    assert again.where("new_state = 'waiting'").count() == 1976 + 512


def test_redelivered_messages_are_published_as_often_as_delivered(spark):
    from sluice.sources import fixtures as fx
    m = fx.messages(spark, SF_SMALL)
    m = m.unionByName(m.where(F.col("event_id") % 29 == 0))
    dest = fx.destinations(spark, SF_SMALL)
    r = pipelines.labelled_routes(m, fx.paths(spark), dest, one_hop=True)
    good = r.where("output = 'good'")
    records = pipelines.sink_records("mqtt", good, dest)
    assert records.count() == good.count()


def test_abort_clock_never_falls(spark, tmp_path):
    day = 86_400
    src = str(tmp_path / "in")
    schema = "queue string, seq long, value string, opened_at timestamp, auto_abort_ms long"

    def land(rows, n):
        df = spark.createDataFrame(rows, "queue string, seq long, value string, s long, auto_abort_ms long")
        df = df.select("queue", "seq", "value", F.timestamp_seconds("s").alias("opened_at"), "auto_abort_ms")
        df.coalesce(1).write.mode("append").parquet(f"{src}/f{n}")

    land([("q", 1, "v", 100 * day, 0)], 1)
    stream = lambda: spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    pipelines.auto_abort_stream(spark, stream(), None, out, ckpt)
    land([("q", 2, "v", 50 * day, 30 * day * 1000)], 2)
    pipelines.auto_abort_stream(spark, stream(), None, out, ckpt)
    got = {r["seq"]: r["new_state"] for r in spark.read.parquet(f"{out}/decided").collect()}
    assert got == {1: "confirmed", 2: "waiting"}


def test_checkpoint_folder(spark):
    assert checkpoint_dir(spark)


def test_failures_count_against_the_acks_so_far(spark):
    emitted = spark.createDataFrame([(p, o) for p in (0, 1, 2) for o in range(40)], "partition int, offset long")
    fails = spark.createDataFrame([(p, o, o) for p in (0, 1, 2) for o in range(30, 40)], "partition int, offset long, fail_seq long")
    acks = spark.createDataFrame([(0, 1, 100), (1, 1, 33)], "partition int, offset long, ack_seq long")
    got = {r["partition"]: (r["acked"], r["failed"], r["error"]) for r in offsets.ack_counters(emitted, acks, fails, 6).collect()}
    assert got[0][0] == got[1][0] == 1 and got[0][1] == got[1][1] == got[2][1]
    assert (got[0][2], got[1][2], got[2][2]) == (got[0][1] > 6, False, got[2][1] > 6)
