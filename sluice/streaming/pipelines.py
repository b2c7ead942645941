"""Structured Streaming pipelines (S2-S5 in, S6-S12 out, A1, T3, T5).

* ``route_stream``: messages -> decode split -> two-hop route, every micro-batch
  written once, partitioned by ``output`` (good / dead / unroutable) under
  ``batch=<id>`` (idempotent on retry).  Registry tables are static
  dimensions joined with a checked broadcast (stream-static join).
* ``latency_stream``: A1 per micro-batch with the blocked scan and the
  per-task state (first arrival, exact total and count since the last reset)
  carried as a table; ``latency_stream_stateful`` is the same fold with
  ``applyInPandasWithState``.  Batch and stream agree exactly.  Rows of a
  micro-batch are taken in seq order; rows arriving in a later batch count at
  arrival.
* ``route_asof_stream``: J7 in a stream, the registry snapshot carried from
  one micro-batch to the next as a table.
* ``bridge_stream``: S11 queue-to-queue bridge with expiry.
* ``prune_stream``: T3 pending prune, the out-of-order window carried as a table.
* ``auto_abort_stream``: D6 with the open items carried as a table and the
  deadlines evaluated at each micro-batch's event-time high-water mark.
* ``route_stream(protocol=...)``: also lands that broker's publish records
  (S6-S10); destinations the protocol refuses route as producer unknown.
* Progress (T5) is the query checkpoint; admission (S12) is
  ``maxFilesPerTrigger`` / ``maxBytesPerTrigger`` / ``maxOffsetsPerTrigger``;
  the commit cadence (A4) is ``processingTime='2 seconds'``.
"""

from __future__ import annotations

import uuid
from typing import Any, Iterator, Tuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sluice.functions.columns import bytes_text
from sluice.operators import decode, routing
from sluice.operators.latency import DEFAULT_WARMUP_MS
from sluice.session import scratch_path
from sluice.sources import fixtures as fx
from sluice.streaming.sinks import write_batch

COMMIT_INTERVAL = "2 seconds"          # offset commit cadence of the reference consumer
BODY = T.StructType([T.StructField("k", T.LongType())])


def admission(max_files: int | None = None, max_bytes: str | None = None,
              max_offsets: int | None = None) -> dict[str, str]:
    """Bounded admission per micro-batch, as source options."""
    o: dict[str, str] = {}
    if max_files:
        o["maxFilesPerTrigger"] = str(max_files)
    if max_bytes:
        o["maxBytesPerTrigger"] = max_bytes
    if max_offsets:
        o["maxOffsetsPerTrigger"] = str(max_offsets)
    return o


FILES_PER_BATCH = 4


def land_in_order(t: DataFrame, order: str, batches: int, name: str, path: str | None = None) -> str:
    """A table as a log that lands over time: ``batches`` ranges of ``order``
    written one after the other (file sources read by time), each as
    ``FILES_PER_BATCH`` files, in a new folder or at the end of ``path``.  Rows
    without an ``order`` land with the first."""
    cuts = t.stat.approxQuantile(order, [i / batches for i in range(1, batches)], 0.01)
    path = path or fresh_dir(t.sparkSession, f"landed-{name}")
    for low, high in zip([None, *cuts], [*cuts, None]):
        above = F.lit(True) if low is None else F.col(order) > low
        upto = F.lit(True) if high is None else F.col(order) <= high
        part = t.where((above & upto) | F.isnull(order) if low is None else above & upto)
        part.repartition(FILES_PER_BATCH).write.mode("append").parquet(path)
    return path


def landed_stream(spark: SparkSession, path: str, files: int = FILES_PER_BATCH) -> DataFrame:
    """A stream over what ``land_in_order`` wrote, one range of ``files`` files a micro-batch."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.format("parquet").schema(schema).options(**admission(max_files=files)).load(path)


def table_stream(spark: SparkSession, folder: str, name: str, options: dict[str, str] | None = None,
                 order: str | None = None, batches: int = 1) -> DataFrame:
    """A file stream over ``<folder>/<name>.parquet`` (the schema of the table);
    with ``order``, in that many micro-batches by that column, admitted one at a
    time (S12)."""
    schema = fx.table(spark, folder, name).schema
    if order is not None and batches > 1:
        opts = admission(max_files=FILES_PER_BATCH) | (options or {})
        return spark.readStream.format("parquet").schema(schema).options(**opts).load(land_in_order(fx.table(spark, folder, name), order, batches, name))
    r = spark.readStream.format("parquet").schema(schema).option("pathGlobFilter", f"{name}.parquet")
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(folder)


def run_available_now(df_writer) -> StreamingQuery:
    q = df_writer.trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def run_until_idle(df_writer) -> StreamingQuery:
    """Run until the sources have no more, then stop; for sources that admit little at a time by themselves."""
    q = df_writer.start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return q


def fresh_dir(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


# ------------------------------------------------------------------ routing

ONE_HOP = ("jms", "mqtt", "kestrel")      # sinks whose selector names the destination (J2)


def one_hop_selector(user_id_text: F.Column, origin: F.Column) -> F.Column:
    """The fixture's one-hop selector: destination d<user_id % 30>, none for errors."""
    return F.when(origin == "error", F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("d"), (user_id_text.cast("long") % 30).cast("string")))


def labelled_routes(msgs: DataFrame, paths: DataFrame, destinations: DataFrame,
                    one_hop: bool = False) -> DataFrame:
    """Decode + route (two hops, or one with ``one_hop``) of ENVELOPE rows,
    with an ``output`` label."""
    d = decode.decode(msgs, BODY)
    if one_hop:
        r = routing.route_one_hop(d, one_hop_selector(bytes_text("key"), F.col("origin")), destinations)
        r = r.withColumn("path", F.lit(None).cast("string"))
    else:
        sel = fx.selector_path(bytes_text("key"), F.col("origin"))
        r = routing.route_two_hop(d, sel, paths, destinations)
    out = (F.when(F.col("dead_reason").isNotNull(), F.lit("dead"))
           .when(F.col("route_reason").isNotNull(), F.lit("unroutable"))
           .otherwise(F.lit("good")))
    return r.select(*msgs.columns, "path", "destination",
                    "route_reason", "dead_reason", F.col("decoded.k").alias("k"), out.alias("output"))


ROUTE_COLUMNS = ["message_id", "origin", "protocol", "partition", "offset", "value", "path", "destination",
                 "route_reason", "dead_reason", "k", "output"]


def publishable(destinations: DataFrame, protocol: str | None) -> DataFrame:
    """The destinations a protocol's producer accepts (P4): the others never
    get a producer, so their messages route as *producer unknown*."""
    if protocol not in ("kafka", "amqp", "jms"):
        return destinations
    from sluice.operators.naming import destination_names
    cols = destinations.columns
    return destination_names(destinations).where(F.col(f"reject_{protocol}").isNull()).select(*cols)


def sink_records(protocol: str, good: DataFrame, destinations: DataFrame) -> DataFrame:
    """Publish records of routed good rows for ``protocol``."""
    from sluice.sources.landed import to_kafka_records
    from sluice.operators.naming import destination_names
    from sluice.streaming import sinks
    if protocol == "kafka":
        topics = destination_names(destinations).select(F.col("name").alias("_k_name"), "kafka_topic")
        from sluice.operators.joins import dim_join
        return to_kafka_records(dim_join(good, topics, F.col("destination") == F.col("_k_name"), "inner"))
    if protocol == "amqp":
        return sinks.amqp_records(good, destinations)
    if protocol == "jms":
        return sinks.jms_records(good, destinations)
    if protocol == "mqtt":
        return sinks.mqtt_records(good)
    if protocol == "kestrel":
        return sinks.kestrel_records(good)
    raise ValueError(f"unknown protocol {protocol!r}")


def route_stream(spark: SparkSession, events: DataFrame, paths: DataFrame, destinations: DataFrame,
                 base: str, checkpoint: str, protocol: str | None = None) -> StreamingQuery:
    """Route a message stream; with ``protocol`` also land that broker's
    publish records of the good rows (``<base>/<protocol>/batch=<id>``).
    JMS, MQTT and Kestrel route in one hop (J2), Kafka and AMQP in two (J1)."""
    msgs = fx.messages_from(events)
    live = publishable(destinations, protocol)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # one row a delivery: the good rows keep their envelope, so nothing is
        # joined back and a message delivered twice is published twice
        routes = labelled_routes(batch, paths, live, one_hop=protocol in ONE_HOP)
        if protocol is None:
            write_batch({"routes": routes.select(*ROUTE_COLUMNS)}, base, batch_id, {"routes": ["output"]})
            return
        routes = routes.persist()
        try:
            good = routes.where(F.col("output") == "good")
            write_batch({"routes": routes.select(*ROUTE_COLUMNS), protocol: sink_records(protocol, good, destinations)},
                        base, batch_id, {"routes": ["output"]})
        finally:
            routes.unpersist()

    w = msgs.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return run_available_now(w)


# ------------------------------------------------------------------ routing under a changing registry

def route_asof_stream(spark: SparkSession, events: DataFrame, base: str, checkpoint: str) -> StreamingQuery:
    """J7 in a stream: every event is both a message and a registry change.

    Per micro-batch: the registry snapshot left by the previous batch (last op
    per name and per path) plus this batch's changes are replayed against
    this batch's messages with the batch as-of route; the new snapshot is
    written under ``registry/batch=<id>``.  A retried batch reads the same
    previous snapshot and overwrites its own outputs, so it is idempotent.
    Messages must arrive in sequence order across batches (a file or Kafka
    log read in order)."""
    from sluice.operators.registry import last_ops

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        msgs = fx.messages_from(batch)
        changes = fx.registry_changes_from(batch)
        if batch_id > 0:
            prior = spark.read.parquet(f"{base}/registry/batch={batch_id - 1}")
            changes = prior.unionByName(changes)
        sel = fx.selector_path(bytes_text("key"), F.col("origin"))
        r = routing.route_as_of(msgs, sel, "event_id", changes, materialize_hops=False)
        write_batch({"routes": r.select("message_id", "path", "destination", "route_reason"),
                     "registry": last_ops(changes)}, base, batch_id)

    w = events.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return run_available_now(w)


def _asof_state(spark: SparkSession, out: str, batch_id: int) -> tuple[DataFrame, DataFrame, int]:
    """What a batch left: waiting messages, changes, and the sequence number up to which all is decided."""
    waiting, changes, mark = (spark.read.parquet(f"{out}/{x}/batch={batch_id}") for x in ("waiting", "changes", "mark"))
    return waiting, changes, mark.first()["mark"]


_ROUTED = ["message_id", "path", "destination", "route_reason"]


def route_asof_late_stream(events: DataFrame, horizon: int, out: str, checkpoint: str) -> StreamingQuery:
    """J7 in a stream whose events come up to ``horizon`` sequence numbers late.

    All up to (largest number seen - ``horizon``) has arrived; that is the mark.  A message is routed when the mark has
    passed it, against every change up to its number, however late the change came; until then it waits
    (``<out>/waiting/batch=<id>``).  Of the changes up to the mark only the last of each name and path is carried, and
    only if it is an add: a removed name is one that is not there (``<out>/changes/batch=<id>``).  So the state holds the
    live names, and the messages and changes of the horizon.  Events behind the mark when they arrive land under
    ``<out>/late/batch=<id>`` and count for nothing.  ``route_waiting`` routes what still waits at the end."""
    from sluice.operators.registry import last_ops
    from sluice.operators.scan import materialize
    spark = events.sparkSession

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        seen = batch.agg(F.max("event_id")).first()[0]
        before = None
        if batch_id > 0:
            waiting, known, before = _asof_state(spark, out, batch_id - 1)
        mark = max(x for x in ((seen - horizon) if seen is not None else None, before, -1) if x is not None)
        behind = F.col("event_id") <= (before if before is not None else -1)
        timely = batch.where(~behind)
        msgs = fx.messages_from(timely).withColumn("selected", fx.selector_path(bytes_text("key"), F.col("origin"))).select("message_id", "event_id", "selected")
        changes = fx.registry_changes_from(timely)
        if batch_id > 0:
            msgs, changes = waiting.unionByName(msgs), known.unionByName(changes)
        msgs, changes = materialize(msgs), materialize(changes)
        decided = changes.where(F.col("seq") <= mark)
        ready = routing.route_as_of(msgs.where(F.col("event_id") <= mark), F.col("selected"), "event_id", decided, materialize_hops=False)
        live = last_ops(decided).where(F.col("op").startswith("add"))
        write_batch({"routes": ready.select(*_ROUTED), "waiting": msgs.where(F.col("event_id") > mark),
                     "changes": live.unionByName(changes.where(F.col("seq") > mark)), "late": batch.where(behind),
                     "mark": spark.range(1).select(F.lit(mark).cast("long").alias("mark"))}, out, batch_id)

    return run_available_now(events.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint))


def route_waiting(spark: SparkSession, out: str) -> DataFrame:
    """The routes of the messages that ``route_asof_late_stream`` still holds, as if nothing more came."""
    last = spark.read.parquet(f"{out}/mark").agg(F.max("batch")).first()[0]
    waiting, changes, _ = _asof_state(spark, out, last)
    return routing.route_as_of(waiting, F.col("selected"), "event_id", changes).select(*_ROUTED)


# ------------------------------------------------------------------ latency (A1)

LATENCY_OUT = T.StructType([T.StructField("task", T.IntegerType()), T.StructField("seq", T.LongType()),
                            T.StructField("val", T.LongType()), T.StructField("mean_latency", T.DoubleType())])
LATENCY_STATE = T.StructType([T.StructField("first_ms", T.LongType()), T.StructField("total", T.LongType()),
                              T.StructField("count", T.LongType())])


def _latency_fold(warmup_ms: int):
    def fold(key: Tuple[Any, ...], pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, total, count = state.get if state.exists else (None, 0, 0)
        batch = pd.concat(list(pdfs)).sort_values("seq")
        out_seq, out_val, out_mean = [], [], []
        for seq, arrival, val in zip(batch["seq"], batch["arrival_ms"], batch["val"]):
            if first is None:
                first = int(arrival)
            if int(arrival) - first <= warmup_ms or pd.isna(val):
                continue
            if val < 0:
                total, count = 0, 0
            else:
                total += int(val)
                count += 1
                out_seq.append(int(seq))
                out_val.append(int(val))
                out_mean.append(total / count)
        state.update((first, total, count))
        yield pd.DataFrame({"task": [key[0]] * len(out_seq), "seq": out_seq, "val": out_val,
                            "mean_latency": out_mean})
    return fold


def latency_updates(rows: DataFrame, warmup_ms: int = DEFAULT_WARMUP_MS) -> DataFrame:
    """A1 on a stream of (task, seq, arrival_ms, val)."""
    return rows.groupBy("task").applyInPandasWithState(
        _latency_fold(warmup_ms), LATENCY_OUT, LATENCY_STATE, "append", GroupStateTimeout.NoTimeout)


def latency_stream_stateful(spark: SparkSession, events: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """A1 with ``applyInPandasWithState``: simple, but one task's rows of a
    micro-batch meet in one Python worker -- bound the batch (admission)."""
    w = (latency_updates(fx.latencies_from(events)).writeStream.format("parquet")
         .option("checkpointLocation", checkpoint).option("path", out).outputMode("append"))
    return run_available_now(w)


def latency_stream(spark: SparkSession, events: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """A1 per micro-batch with the blocked scan, the per-task state (first
    arrival, total and count since the last reset) carried as a table under
    ``<out>/state/batch=<id>``; means land under ``<out>/means/batch=<id>``.
    A retried batch reads the same prior state and overwrites its outputs."""
    from sluice.operators.latency import running_latency_from

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        prior = spark.read.parquet(f"{out}/state/batch={batch_id - 1}") if batch_id > 0 else None
        means, state = running_latency_from(fx.latencies_from(batch), prior)
        write_batch({"means": means, "state": state}, out, batch_id)

    w = events.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return run_available_now(w)


# ------------------------------------------------------------------ bridge

BRIDGE_EXPIRATION_MS = 30_000


def bridge(items: DataFrame, observed_at: F.Column, prefix: str = "recv:",
           expiration_ms: int = BRIDGE_EXPIRATION_MS) -> DataFrame:
    """Take the waiting, unexpired items of each queue and put them to
    ``prefix + queue`` with a new expiry."""
    from sluice.operators.queues import expire
    return expire(items, observed_at).select(
        F.concat(F.lit(prefix), F.col("queue")).alias("queue"), "seq", "value",
        F.lit(expiration_ms).cast("long").alias("expiration_ms"))


def bridge_stream(spark: SparkSession, orders: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    items = fx.queue_items_from(orders).where(F.col("put_at") <= fx.observed_at())
    w = (bridge(items, fx.observed_at()).writeStream.format("parquet")
         .option("checkpointLocation", checkpoint).option("path", out))
    return run_available_now(w)


# ------------------------------------------------------------------ pending prune

def prune_stream(acks: DataFrame, bounds: DataFrame, max_offset_behind: int, out: str, checkpoint: str) -> StreamingQuery:
    """T3 in a stream of acks (partition, offset, ack_seq): every micro-batch is decided by ``acks.prune_step``; the
    offset up to which nothing is pending and the acked offsets above it are carried as tables (``<out>/low/batch=<id>``,
    ``<out>/removed/batch=<id>``), decisions land under ``<out>/decisions/batch=<id>``.  ``bounds`` is what has been
    emitted: (partition, first_offset, next_offset).  Acks are taken in order of ack_seq within a micro-batch; one that
    comes in a later batch counts at arrival.  A retried batch reads the same prior state and overwrites its outputs."""
    from sluice.operators.acks import prune_step
    spark = acks.sparkSession

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        low, removed = (spark.read.parquet(f"{out}/{x}/batch={batch_id - 1}") if batch_id > 0 else None for x in ("low", "removed"))
        decisions, low, removed = prune_step(batch, bounds, low, removed, max_offset_behind)
        write_batch({"decisions": decisions, "low": low, "removed": removed}, out, batch_id)

    return run_available_now(acks.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint))


# ------------------------------------------------------------------ replay of failures

def land_steps(t: DataFrame, step: str, steps: int, name: str, files: int = FILES_PER_BATCH) -> str:
    """A table as a log that lands in the steps its column ``step`` names, 0 to ``steps`` - 1, each in ``files`` files."""
    path = fresh_dir(t.sparkSession, f"landed-{name}")
    for i in range(steps):
        t.where(F.col(step) == i).repartition(files).write.mode("append").parquet(path)
    return path


def replay_stream(log: DataFrame, messages: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """J8 in a stream of (kind, partition, offset): 'message' rows are new offsets, 'fail' rows are offsets whose
    processing failed.  Every micro-batch first replays what failed in the one before, read again from ``messages`` (the
    log, a table) from the smallest failed offset of each partition, then goes on with its new offsets
    (``<out>/replayed/batch=<id>``, ``<out>/emitted/batch=<id>``).  A failed offset is removed when it is replayed, and
    comes back if it fails again; several failures in one micro-batch are one.  What failed last is carried as
    ``<out>/failed/batch=<id>``; a retried batch reads the same failures and overwrites its outputs."""
    from sluice.operators.offsets import replay_failed
    spark = log.sparkSession

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.select("kind", "partition", "offset")
        failed = batch.where("kind = 'fail'").select("partition", "offset").distinct()
        before = spark.read.schema(failed.schema).parquet(f"{out}/failed/batch={batch_id - 1}") if batch_id > 0 else failed.where("false")
        write_batch({"replayed": replay_failed(messages, before), "emitted": batch.where("kind = 'message'").select("partition", "offset"), "failed": failed}, out, batch_id)

    return run_available_now(log.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint))


def commit_trigger() -> dict[str, str]:
    """A4: commit at most every 2000 ms -> ``writeStream.trigger(**commit_trigger())``."""
    return {"processingTime": COMMIT_INTERVAL}


# ------------------------------------------------------------------ auto-abort

OPEN_ITEM_COLUMNS = ["queue", "seq", "value", "opened_at", "auto_abort_ms"]


def auto_abort_stream(spark: SparkSession, opened: DataFrame, confirms: DataFrame | None,
                      out: str, checkpoint: str, time_col: str = "opened_at") -> StreamingQuery:
    """D6 in a stream.  ``opened``: a stream of fetched items (queue, seq,
    value, opened_at, auto_abort_ms); ``confirms``: a static table of confirmed
    (queue, seq) ids, or None.  The open items are carried between
    micro-batches as a table (``<out>/open/batch=<id>``); each batch evaluates
    the deadlines at its event-time high-water mark (the largest ``time_col``
    seen so far, never the wall clock) and lands the decided items under
    ``<out>/decided/batch=<id>`` ('confirmed' or back to 'waiting')."""
    from sluice.operators.queues import auto_abort, confirm

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        prior_path = f"{out}/open/batch={batch_id - 1}"
        items = batch.select(*OPEN_ITEM_COLUMNS).withColumn("state", F.lit("open"))
        if batch_id > 0:
            items = spark.read.parquet(prior_path).select(*OPEN_ITEM_COLUMNS, "state").unionByName(items)
        if confirms is not None:
            items = confirm(items, confirms)
        # One scalar per micro-batch: the event-time high-water mark.  It is kept
        # with the state, or it would fall when the item that set it leaves.
        marks = batch.select(F.col(time_col).cast("timestamp").alias("hw"))
        if batch_id > 0:
            marks = marks.unionByName(spark.read.parquet(f"{out}/mark/batch={batch_id - 1}"))
        mark = marks.agg(F.max("hw").alias("hw")).persist()
        hw = mark.first()["hw"]
        at = F.lit(hw).cast("timestamp")
        decided = auto_abort(items, at)
        write_batch({"mark": mark,
                     "open": decided.where(F.col("new_state") == "open").select(*OPEN_ITEM_COLUMNS, "state"),
                     "decided": decided.where(F.col("new_state") != "open")
                     .select("queue", "seq", "new_state", "txn_id")}, out, batch_id)
        mark.unpersist()

    w = opened.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return run_available_now(w)
