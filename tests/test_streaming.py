"""Batch/stream parity, restart from a checkpoint, sinks and sources."""

from pyspark.sql import functions as F

from sluice.operators import acks
from sluice.operators.latency import running_latency
from sluice.sources import fixtures as fx
from sluice.sources import landed
from sluice.streaming import pipelines as sp
from sluice.streaming import sinks
from tests.conftest import SF_SMALL


def _split_events(spark, folder, parts):
    """Land events as several files, cut on event_id ranges aligned to 8."""
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    n = e.count()
    step = ((n // parts) // 8 + 1) * 8
    for i in range(parts):
        (e.where((F.col("event_id") >= i * step) & (F.col("event_id") < (i + 1) * step))
         .coalesce(1).write.mode("overwrite").parquet(f"{folder}/part{i}"))
    return step


def _stream_events(spark, folder):
    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true") \
        .parquet(folder)


def test_latency_stream_restart_equals_batch(spark):
    base = sp.fresh_dir(spark, "test-lat")
    land = f"{base}/land"
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    step = _split_events(spark, f"{base}/all", 3)
    # first run sees two files, second run (same checkpoint) the third one too
    for i in range(2):
        spark.read.parquet(f"{base}/all/part{i}").write.parquet(f"{land}/part{i}")
    sp.latency_stream(spark, _stream_events(spark, land), f"{base}/out", f"{base}/ckpt")
    first = spark.read.parquet(f"{base}/out/means").count()
    spark.read.parquet(f"{base}/all/part2").write.parquet(f"{land}/part2")
    sp.latency_stream(spark, _stream_events(spark, land), f"{base}/out", f"{base}/ckpt")
    got = spark.read.parquet(f"{base}/out/means")
    assert spark.read.parquet(f"{base}/out/state").select("batch").distinct().count() == 3
    # the stateful form gives the same means
    sp.latency_stream_stateful(spark, _stream_events(spark, land), f"{base}/out2", f"{base}/ckpt2")
    got2 = spark.read.schema(sp.LATENCY_OUT).parquet(f"{base}/out2")
    want = running_latency(fx.latencies_from(e))
    r = lambda df: sorted((x.task, x.seq, round(x.mean_latency, 6)) for x in df.collect())
    assert 0 < first < got.count()
    assert r(got) == r(want)
    assert r(got2) == r(want)
    assert step > 0


def test_route_stream_is_idempotent_and_complete(spark):
    base = sp.fresh_dir(spark, "test-route")
    ev = sp.table_stream(spark, SF_SMALL, "events")
    sp.route_stream(spark, ev, fx.paths(spark), fx.destinations(spark, SF_SMALL), f"{base}/out", f"{base}/ckpt")
    out = spark.read.parquet(f"{base}/out/routes")
    n = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert out.count() == n                                   # good + dead + unroutable = input
    assert out.select("message_id").distinct().count() == n
    counts = {r.output: r["count"] for r in out.groupBy("output").count().collect()}
    assert set(counts) == {"good", "dead", "unroutable"}
    # re-running a batch id overwrites its folder instead of appending
    sinks.write_batch({"routes": out.limit(3)}, f"{base}/again", 0)
    sinks.write_batch({"routes": out.limit(3)}, f"{base}/again", 0)
    assert spark.read.parquet(f"{base}/again/routes").count() == 3


def test_stream_prune_equals_batch(spark):
    got = {(r.ack_seq, r.offset, r.action, r.min_pending_after)
           for r in __import__("__spark_entry__").queries()["stream_pending_prune"](spark, SF_SMALL).collect()}
    want = {(r.ack_seq, r.offset, r.action, r.min_pending_after)
            for r in acks.pending_prune(fx.lagging_ack_log(spark, SF_SMALL), fx.emitted(spark, SF_SMALL), fx.PRUNE_BEHIND).collect()}
    assert got == want and sum(r[2] == "clear" for r in want) > 4


def test_landed_sources_and_sinks(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    amqp = spark.createDataFrame([("q1", "c", 7, "ex", "rk", {"p": "1"}, {"h": "x"}, b'{"k":1}', t)],
                                 landed.AMQP_RECORD)
    env = landed.amqp_to_envelope(amqp).first()
    assert env.message_id == "q1:0:7" and env.headers["time"] == "1704067200000" and env.headers["h"] == "x"
    jms = spark.createDataFrame([("d", "ID:1", 3, 1704067200000, 2, {}, b"b")], landed.JMS_RECORD)
    assert landed.jms_to_envelope(jms).first().message_id == "ID:1"
    mq = spark.createDataFrame([("t", 5, 1, b"b", t)], landed.MQTT_RECORD)
    assert landed.mqtt_to_envelope(mq).first().message_id == "t:0:5"
    ks = spark.createDataFrame([("q", 9, b"d", t)], landed.KESTREL_RECORD)
    k_env = landed.kestrel_to_envelope(ks)
    assert k_env.first().message_id == "q:0:9"
    kafka = spark.createDataFrame([(b"k", b"v", "top", 2, 11, t, 0, [("a", b"1")])], landed.KAFKA_SOURCE)
    ke = landed.kafka_to_envelope(kafka).first()
    assert ke.message_id == "top:2:11" and ke.headers["a"] == "1" and ke.key == bytearray(b"k")
    rec = landed.to_kafka_records(landed.kafka_to_envelope(kafka).withColumn("kafka_topic", F.lit("out"))).first()
    assert rec.topic == "out" and {h.key for h in rec.headers} == {"a", "time"}
    routed = k_env.withColumn("destination", F.lit("d1"))
    kr = sinks.kestrel_records(routed, 30000).first()
    assert kr.queue == "d1" and kr.expiration_ms == 30000
    secs = sinks.kestrel_records(routed, 30000).select(
        (F.unix_millis('expires_at') - F.unix_millis(F.lit(t))).alias('d')).first().d
    assert secs == 30000
    opts = landed.kafka_options("b:9092", "top", '{"top":{"0":5}}', 1000)
    assert opts["startingOffsets"] == '{"top":{"0":5}}' and opts["maxOffsetsPerTrigger"] == "1000"
    assert sp.admission(max_files=2) == {"maxFilesPerTrigger": "2"}


def test_route_asof_stream_over_several_batches_equals_batch(spark):
    from sluice.operators import routing
    from sluice.functions.columns import bytes_text
    base = sp.fresh_dir(spark, "test-asof")
    _split_events(spark, f"{base}/land", 3)
    sp.route_asof_stream(spark, _stream_events(spark, f"{base}/land"), f"{base}/out", f"{base}/ckpt")
    got = spark.read.parquet(f"{base}/out/routes")
    assert spark.read.parquet(f"{base}/out/registry").select("batch").distinct().count() == 3
    m = fx.messages(spark, SF_SMALL)
    sel = fx.selector_path(bytes_text("key"), F.col("origin"))
    want = routing.route_as_of(m, sel, "event_id", fx.registry_changes(spark, SF_SMALL))
    key = lambda df: sorted(tuple(r) for r in df.select("message_id", "path", "destination", "route_reason").collect())
    assert key(got) == key(want)


def test_read_landed_files_batch_and_stream(spark):
    import datetime as dt
    base = sp.fresh_dir(spark, "test-landed")
    t = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [("q1", i, f'{{"k": {i}}}'.encode(), t) for i in range(20)]
    spark.createDataFrame(rows, landed.KESTREL_RECORD).write.parquet(f"{base}/kestrel")
    batch = landed.read_landed(spark, f"{base}/kestrel", "kestrel")
    assert batch.count() == 20 and batch.columns[:2] == ["message_id", "origin"]
    stream = landed.read_landed(spark, f"{base}/kestrel", "kestrel", streaming=True,
                                options=sp.admission(max_files=1))
    q = stream.writeStream.format("parquet").option("checkpointLocation", f"{base}/ck") \
        .option("path", f"{base}/out").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.read.parquet(f"{base}/out").select("message_id").distinct().count() == 20


def test_route_stream_with_amqp_sink(spark):
    base = sp.fresh_dir(spark, "test-amqp")
    ev = sp.table_stream(spark, SF_SMALL, "events")
    dests = fx.destinations(spark, SF_SMALL)
    sp.route_stream(spark, ev, fx.paths(spark), dests, f"{base}/out", f"{base}/ckpt", protocol="amqp")
    routes = spark.read.parquet(f"{base}/out/routes")
    recs = spark.read.parquet(f"{base}/out/amqp")
    good = routes.where("output = 'good'")
    assert recs.count() == good.count() > 0
    assert recs.where("exchange is null or routing_key is null").count() == 0
    # destinations AMQP refuses (no queueName, or a null name part) route as producer unknown
    refused = {r.name for r in sp.publishable(dests, None).join(
        sp.publishable(dests, "amqp").select("name"), "name", "left_anti").collect()}
    assert refused
    assert good.where(F.col("destination").isin(*refused)).count() == 0
    full = good.join(fx.messages(spark, SF_SMALL).select("message_id", "key", "headers", "ts"), "message_id")
    for proto in ("kafka", "jms", "mqtt", "kestrel"):
        assert sp.sink_records(proto, full, dests).count() == good.count(), proto


def test_auto_abort_stream_decides_against_event_time(spark):
    import datetime as dt
    base = sp.fresh_dir(spark, "test-abort")
    t0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    day = dt.timedelta(days=1)
    schema = "queue string, seq long, value string, opened_at timestamp, auto_abort_ms long"
    first = [("q", 1, "a", t0, 0), ("q", 2, "b", t0, 86_400_000), ("q", 3, "c", t0, 86_400_000 * 10)]
    second = [("q", 4, "d", t0 + 2 * day, 86_400_000 * 10)]
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(f"{base}/land/p0")
    spark.createDataFrame(second, schema).coalesce(1).write.parquet(f"{base}/land/p1")
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(f"{base}/land"))
    confirms = spark.createDataFrame([("q", 3)], "queue string, seq long")
    sp.auto_abort_stream(spark, stream, confirms, f"{base}/out", f"{base}/ckpt")
    decided = {(r.seq, r.new_state) for r in spark.read.parquet(f"{base}/out/decided").collect()}
    # batch 0 (high-water t0): seq 1 has no deadline -> confirmed at once; seq 3 confirmed by id
    # batch 1 (high-water t0 + 2 days): seq 2's one-day deadline passed -> back to waiting
    assert decided == {(1, "confirmed"), (2, "waiting")}
    still_open = {r.seq for r in spark.read.parquet(f"{base}/out/open").where("batch = 1").collect()}
    assert still_open == {4}


def test_rows_without_an_order_land(spark):
    folder = sp.fresh_dir(spark, "test-null-order")
    rows = [(None, "a"), (None, "b"), *((i, "c") for i in range(20))]
    spark.createDataFrame(rows, "k long, v string").write.parquet(f"{folder}/t.parquet")
    landed_rows = spark.read.parquet(sp.land_in_order(spark.read.parquet(f"{folder}/t.parquet"), "k", 3, "t")).collect()
    assert sorted(map(tuple, landed_rows), key=str) == sorted(rows, key=str)


def test_late_changes_and_state_of_live_names(spark):
    """A change that comes after the message it concerns still routes it; removed names leave the state."""
    base = sp.fresh_dir(spark, "test-asof-late")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("arrival", F.col("event_id") + F.col("event_id") * 37 % 100)
    path = sp.land_in_order(events, "arrival", 3, "late")
    sp.route_asof_late_stream(sp.landed_stream(spark, path), 100, f"{base}/out", f"{base}/ckpt")
    got = {tuple(r) for r in spark.read.parquet(f"{base}/out/routes").select("message_id", "path", "destination", "route_reason").collect()}
    held = {tuple(r) for r in sp.route_waiting(spark, f"{base}/out").collect()}
    want = {tuple(r) for r in __import__("__spark_entry__").queries()["route_asof"](spark, SF_SMALL).select("message_id", "path", "destination", "route_reason").collect()}
    assert not got & held and got | held == want and held
    changes = spark.read.parquet(f"{base}/out/changes")
    mark = spark.read.parquet(f"{base}/out/mark").agg(F.max("mark")).first()[0]
    settled = changes.where((F.col("batch") == 2) & (F.col("seq") <= mark))
    assert settled.where("op like 'remove%'").count() == 0 and settled.count() <= 25 + 30
    assert changes.where((F.col("batch") == 2) & (F.col("seq") > mark)).count() <= 100
    assert spark.read.parquet(f"{base}/out/late").count() == 0
