"""Landed deliveries read with per-queue admission (S2-S5, S12), and records published exactly once."""

import json
import os
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sluice.config import PipelineConfig
from sluice.sources import broker_log, files, landed
from sluice.streaming import publish
from sluice.streaming.pipelines import fresh_dir, run_until_idle


def amqp(spark, rows):
    df = spark.createDataFrame([(q, t, b) for q, t, b in rows], "queue string, delivery_tag long, b string")
    return df.select("queue", F.lit("c").alias("consumer_tag"), "delivery_tag", F.lit("ex").alias("exchange"), F.lit("rk").alias("routing_key"),
                     F.create_map(F.lit("p"), F.lit("é")).alias("properties"), F.lit(None).cast("map<string,string>").alias("headers"),
                     F.col("b").cast("binary").alias("body"), F.timestamp_millis(F.col("delivery_tag")).alias("timestamp"))


def consumed(spark, base, prefetch):
    """[{queue: deliveries}] of each micro-batch of one run of the query."""
    batches = []
    config = PipelineConfig.from_options("amqp", {"prefetchCount": str(prefetch)})
    stream = broker_log.read_stream(spark, f"{base}/log", config, f"{base}/progress.json")

    def per_batch(batch, batch_id):
        rows = batch.select("origin", "offset", F.decode("value", "UTF-8").alias("v"), F.col("context")["p"].alias("p"), F.col("headers")["time"].alias("t")).collect()
        batches.append(rows)

    run_until_idle(stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", f"{base}/ckpt"))
    return batches


def test_at_most_prefetch_of_each_queue_and_restart_without_loss(spark):
    base = fresh_dir(spark, "test-log")
    first = [("hot/ü", t, f"h{t}") for t in range(100)] + [("cold", t, f"c{t}") for t in range(7)] + [("hot/ü", 40, "again")] + [(None, 1, "none"), ("cold", None, "refused")]
    broker_log.land(amqp(spark, first), f"{base}/log", "amqp", parts=5)
    batches = consumed(spark, base, 30)
    sizes = [Counter(r.origin for r in b) for b in batches]
    assert all(n <= 30 for c in sizes for n in c.values()) and len([c for c in sizes if c]) >= 4
    assert sizes[0]["cold"] == 7 and sizes[0]["hot/ü"] == 30
    seen = [r for b in batches for r in b]
    # the query goes on where it stopped; what landed in between comes once
    later = [("hot/ü", t, f"h{t}") for t in range(100, 135)] + [("new", 1, "n1")]
    broker_log.land(amqp(spark, later), f"{base}/log", "amqp", parts=2)
    more = consumed(spark, base, 30)
    assert all(n <= 30 for b in more for n in Counter(r.origin for r in b).values())
    seen += [r for b in more for r in b]
    want = Counter((q, t, b) for q, t, b in first + later if t is not None)
    got = Counter((r.origin if r.origin != "__none__" else None, r.offset, r.v) for r in seen)
    assert got == want
    assert {r.p for r in seen} == {"é"} and all(r.t == str(r.offset) for r in seen)
    by_queue = defaultdict(list)
    for r in seen:
        by_queue[r.origin].append(r.offset)
    assert [t for t in by_queue["cold"]] == sorted(by_queue["cold"])


def test_reader_admits_by_tags(spark):
    base = fresh_dir(spark, "test-log")
    broker_log.land(amqp(spark, [("q", t // 3, str(t)) for t in range(30)]), f"{base}/log", "amqp", parts=3)  # three deliveries a tag
    read = lambda n: broker_log.LandedReader(f"{base}/log", "amqp", n, f"{base}/p.json", landed.RECORDS["amqp"])
    assert read(7).latestOffset() == {"q": 1}      # the third tag would not fit
    assert read(6).latestOffset() == {"q": 1}
    assert read(1).latestOffset() == {"q": 0}      # a tag is not split
    assert read(100).latestOffset() == {"q": 9}
    r = read(9)
    parts = r.partitions({}, r.latestOffset())
    assert sum(b.num_rows for p in parts for b in r.read(p)) == 9
    assert read(9).latestOffset() == {"q": 5}      # another reader goes on from the planned end
    with pytest.raises(ValueError):
        read(0)


def test_landed_protocols_read_back(spark):
    for protocol in ("jms", "mqtt", "kestrel"):
        base = fresh_dir(spark, "test-log")
        queue, tag = broker_log.KEYS[protocol]
        rows = spark.range(50).withColumns({queue: F.concat(F.lit("q"), F.col("id") % 3), "n": F.col("id")})
        from sluice.operators.envelope import declare_fields
        rows = declare_fields(rows.withColumnRenamed("n", tag) if tag != "id" else rows, landed.RECORDS[protocol])
        broker_log.land(rows, f"{base}/log", protocol, parts=4)
        stream = broker_log.read_stream(spark, f"{base}/log", PipelineConfig.from_options(protocol, {"queueSize": "6"}), f"{base}/p.json")
        run_until_idle(stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt"))
        out = spark.read.schema(stream.schema).parquet(f"{base}/out")
        assert sorted(r.offset for r in out.collect()) == list(range(50))


# -- publishing

def rows_of(df):
    return sorted(r.id for r in df.collect())


def test_published_once_whatever_is_left_over(spark):
    base = fresh_dir(spark, "test-publish")
    schema = spark.range(1).schema
    spark.range(10).repartition(4).write.parquet(f"{base}/in")
    run = lambda writer, ckpt: run_until_idle(publish.publish(spark.readStream.schema(schema).parquet(f"{base}/in"), f"{base}/out", writer)
                                              .option("checkpointLocation", f"{base}/{ckpt}"))
    run("one", "c1")
    assert rows_of(publish.published(spark, f"{base}/out", schema)) == list(range(10))
    # the same micro-batch again (its commit was lost): the manifest stands, the new files go
    run("one", "c2")
    assert rows_of(publish.published(spark, f"{base}/out", schema)) == list(range(10))
    store, root = files.opened(f"{base}/out")
    named = {f for m in files.names(store, f"{root}/_published/one") for f in json.loads(files.content(store, m))["files"]}
    assert {os.path.basename(f) for f in files.names(store, f"{root}/records")} == named
    # another stream publishes into the same folder
    run("two", "c3")
    assert rows_of(publish.published(spark, f"{base}/out", schema)) == sorted([*range(10), *range(10)])
    assert rows_of(publish.published(spark, f"{base}/out", schema, "two")) == list(range(10))


def test_a_task_that_dies_shows_nothing(spark):
    base = fresh_dir(spark, "test-publish")
    schema = spark.range(1).schema
    spark.range(10).repartition(4).write.parquet(f"{base}/in")

    def fail(batches):
        for b in batches:
            yield b
            raise RuntimeError("executor lost")

    stream = spark.readStream.schema(schema).parquet(f"{base}/in").mapInArrow(fail, schema)
    with pytest.raises(Exception, match="executor lost"):
        run_until_idle(publish.publish(stream, f"{base}/out", "w").option("checkpointLocation", f"{base}/c"))
    assert publish.published(spark, f"{base}/out", schema).count() == 0
    again = spark.readStream.schema(schema).parquet(f"{base}/in")
    run_until_idle(publish.publish(again, f"{base}/out", "w").option("checkpointLocation", f"{base}/c2"))
    assert rows_of(publish.published(spark, f"{base}/out", schema)) == list(range(10))


def test_abort_removes_what_was_staged(spark):
    import pyarrow as pa
    base = fresh_dir(spark, "test-publish")
    w = publish.StagedWriter(f"{base}/out", "w")
    m = w.write(iter([pa.RecordBatch.from_pydict({"id": [1, 2]})]))
    empty = w.write(iter([]))
    assert empty.file is None
    w.abort([m, empty, None], 0)
    store, root = files.opened(f"{base}/out")
    assert files.names(store, f"{root}/records") == []


def test_a_micro_batch_reads_little_of_a_long_queue(spark, monkeypatch):
    """Files are bounded and in order of the tags; the tags of a file are read once, not for every micro-batch."""
    import glob
    base = fresh_dir(spark, "test-log")
    monkeypatch.setattr(broker_log, "FILE_ROWS", 100, raising=False)
    broker_log.land(amqp(spark, [(q, (t * 7919) % 1000, str(t)) for q in ("a", "b") for t in range(1000)]), f"{base}/log", "amqp", parts=2)
    found = [broker_log.pq.read_table(f, columns=["delivery_tag"], partitioning=None).column(0).to_pylist() for f in glob.glob(f"{base}/log/_queue=*/*.parquet")]
    assert len(found) >= 20 and all(len(tags) <= 100 and tags == sorted(tags) for tags in found)
    read, reads = broker_log.pq.read_table, Counter()
    monkeypatch.setattr(broker_log.pq, "read_table", lambda path, **k: reads.update([path]) or read(path, **k))
    r, at, ends = broker_log.LandedReader(f"{base}/log", "amqp", 30, f"{base}/p.json", landed.RECORDS["amqp"]), {}, []
    while (end := r.latestOffset()) != at:
        parts = r.partitions(at, end)
        assert len(parts) <= 4  # 30 deliveries of two queues lie in two files of each at most
        ends.append(end)
        at = end
    assert [e["a"] for e in ends] == [*range(29, 1000, 30), 999] and all(e["a"] == e["b"] for e in ends)
    assert set(reads.values()) == {1}
    assert len(r.tags) <= 2
