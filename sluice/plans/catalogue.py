"""Query catalogue: one Spark query per operator, each with a DuckDB twin.

Every query reads whole driver tables (through ``sluice.sources.fixtures``)
and returns a lazy DataFrame; ``oracle`` holds the equivalent SQL over the
same tables (fixture CTEs from ``sluice.plans.oracle``).  Column names and
types are the same on both sides.  Queries without SQL get a rows-only check.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions import scalars
from sluice.functions.columns import bytes_text, epoch_ms, ms_to_ts
from sluice.operators import (acks, decode, envelope, latency, naming, offsets, queues, registry,
                              routing)
from sluice.plans.oracle import OBSERVED_MS, fixtures_prefix, with_fixtures
from sluice.sources import fixtures as fx

QueryFn = Callable[[SparkSession, str], DataFrame]

MAX_BEHIND = fx.MAX_OFFSET_BEHIND
FETCH_BYTES = 2048           # small fetch size so the slice is cut at sf0.01
GET_MAX_ITEMS = 100          # items per queue get (the reference's batch of 100)
CONFIRM_PRICE = 250000.0     # open items priced above this are confirmed, the rest aborted
FLUSHED = ["5-LOW"]
DELETED = ["4-NOT SPECIFIED"]
BODY_SCHEMA = T.StructType([T.StructField("k", T.LongType())])


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    operators: str


CATALOGUE: dict[str, Query] = {}


def query(name: str, operators: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        CATALOGUE[name] = Query(name, fn, sql, operators)
        return fn
    return deco


# ---------------------------------------------------------------- helpers

def _routed_two_hop(spark: SparkSession, sf: str) -> DataFrame:
    m = fx.messages(spark, sf)
    sel = fx.selector_path(bytes_text("key"), F.col("origin"))
    return routing.route_two_hop(m, sel, fx.paths(spark), fx.destinations(spark, sf))


_ROUTE_SQL_BODY = """
  sel AS (SELECT message_id, CASE WHEN origin = 'error' THEN NULL
                                  ELSE 'p' || CAST(user_id % 30 AS VARCHAR) END AS path
          FROM messages),
  r AS (SELECT sel.message_id, sel.path, p.destination,
               CASE WHEN sel.path IS NULL THEN 'no selection'
                    WHEN p.path IS NULL THEN 'path unknown'
                    WHEN d.name IS NULL THEN 'producer unknown' END AS route_reason
        FROM sel LEFT JOIN paths p ON sel.path = p.path
                 LEFT JOIN destinations d ON p.destination = d.name)
"""


def _route_sql(select: str) -> str:
    base = fixtures_prefix(["messages", "paths", "destinations"])
    return base + ",\n" + _ROUTE_SQL_BODY.strip() + "\n" + select


def _observed() -> F.Column:
    return fx.observed_at()


# ---------------------------------------------------------------- envelope / decode

@query("envelope_events", "P5 P6 P12", with_fixtures(["messages"], """
SELECT message_id, origin, protocol, coalesce(stream, 'default') AS stream, key_text,
       CAST(strlen(value_text) AS BIGINT) AS value_len, sent_ms, "partition", "offset",
       CASE WHEN protocol IN ('kafka', 'amqp') THEN (['auto','manual','client'])[CAST(event_id % 3 AS INTEGER) + 1] = 'manual'
            WHEN protocol = 'jms' THEN (event_id % 3 + 1) <> 1 OR (CASE WHEN event_id % 3 = 2 THEN 2 ELSE 1 END) <> 1
            WHEN protocol = 'mqtt' THEN event_id % 3 <> 0
            WHEN protocol = 'kestrel' THEN event_id % 3 <> 0
            ELSE false END AS ack_required
FROM messages"""))
def q_envelope_events(spark, sf):
    m = envelope.with_default_stream(fx.messages(spark, sf))
    cfg = m.select("*", *fx.ack_config(F.col("event_id")))
    need = envelope.ack_required(F.col("protocol"), F.col("ack_mode"), F.col("jms_ack_mode"),
                                 F.col("delivery_mode"), F.col("qos"), F.col("kestrel_ack_mode"))
    return cfg.select("message_id", "origin", "protocol", "stream",
                      bytes_text("key").alias("key_text"),
                      F.length("value").cast("long").alias("value_len"),
                      F.col("headers")["time"].cast("long").alias("sent_ms"),
                      "partition", "offset", need.alias("ack_required"))


_DECODE_SQL = """
  d AS (SELECT *, CASE WHEN json_valid(value_text) THEN TRY_CAST(json_extract_string(value_text, '$.k') AS BIGINT) END AS k,
               CASE WHEN value_text IS NULL OR value_text = '' THEN 'empty'
                    WHEN NOT json_valid(value_text) THEN 'undecodable'
                    WHEN TRY_CAST(json_extract_string(value_text, '$.k') AS BIGINT) IS NULL THEN 'empty_tuple' END AS dead_reason
        FROM messages)
"""


def _decode_sql(select: str) -> str:
    base = fixtures_prefix(["messages"])
    return base + ",\n" + _DECODE_SQL.strip() + "\n" + select


def _decoded(spark, sf):
    return decode.decode(fx.messages(spark, sf), BODY_SCHEMA)


@query("decode_good", "P7 P9 U1", _decode_sql("""
SELECT message_id, origin, "partition", "offset", k, '{"k":' || CAST(k AS VARCHAR) || '}' AS reencoded
FROM d WHERE dead_reason IS NULL"""))
def q_decode_good(spark, sf):
    g = decode.good(_decoded(spark, sf))
    return g.select("message_id", "origin", "partition", "offset", "k",
                    bytes_text(decode.encode_json([F.col("k")])).alias("reencoded"))


@query("decode_dead", "P7 P8", _decode_sql("""
SELECT message_id, origin, protocol, dead_reason,
       CASE protocol WHEN 'amqp' THEN 'reject_no_requeue' WHEN 'kafka' THEN 'report_and_drop'
                     WHEN 'mqtt' THEN 'report_and_drop' ELSE 'drop' END AS disposition,
       value_text
FROM d WHERE dead_reason IS NOT NULL"""))
def q_decode_dead(spark, sf):
    dl = decode.dead_letters(_decoded(spark, sf))
    return dl.select("message_id", "origin", "protocol", "dead_reason", "disposition",
                     bytes_text("value").alias("value_text"))


# ---------------------------------------------------------------- scalar functions

@query("decode_binary", "U1 P8", with_fixtures(["messages"], """
, b AS (SELECT m.message_id, m.event_id, m.sent_ms, hex(e.props) AS props FROM messages m JOIN events e USING (event_id))
SELECT message_id, CASE WHEN dead_reason IS NULL THEN sent_ms END AS sent_ms,
       CASE WHEN dead_reason IS NULL THEN CASE WHEN event_id % 23 = 0 THEN 'FF000D0AFE' ELSE props END END AS body, dead_reason
FROM (SELECT *, CASE WHEN event_id % 17 = 0 THEN 'empty' WHEN event_id % 19 = 0 OR event_id % 13 = 0 THEN 'undecodable' END AS dead_reason FROM b)"""))
def q_decode_binary(spark, sf):
    """Bodies of a binary format through a decoder over Arrow arrays; what it cannot read is a dead letter."""
    d = decode.decode_arrow(fx.binary_payloads(spark, sf), decode.BINARY_PAYLOAD, decode.timestamp_body_decoder)
    return d.select("message_id", F.col("decoded.sent_ms").alias("sent_ms"), F.hex("decoded.body").alias("body"), "dead_reason")


@query("latency_millis", "P10", with_fixtures(["messages"], """
SELECT message_id, sent_ms, sent_ms + CAST(floor(num_value) AS BIGINT) AS observed_ms,
       CAST(floor(num_value) AS BIGINT) AS latency_ms
FROM messages"""))
def q_latency_millis(spark, sf):
    m = fx.messages(spark, sf, extra=[F.col("value").alias("num_value")])
    sent = F.col("headers")["time"].cast("long")
    observed = ms_to_ts(sent + F.floor("num_value").cast("long"))
    return m.select("message_id", sent.alias("sent_ms"), epoch_ms(observed).alias("observed_ms"),
                    scalars.latency_ms(observed, sent).alias("latency_ms"))


@query("error_names", "P11", """
SELECT CAST(event_id % 16 AS INTEGER) - 1 AS code,
       CASE WHEN CAST(event_id % 16 AS INTEGER) - 1 BETWEEN 0 AND 12
            THEN (['NO_ERROR','OFFSET_OUT_OF_RANGE','INVALID_MESSAGE','UNKNOWN_TOPIC_OR_PARTITION',
                   'INVALID_FETCH_SIZE','LEADER_NOT_AVAILABLE','NOT_LEADER_FOR_PARTITION',
                   'REQUEST_TIMED_OUT','BROKER_NOT_AVAILABLE','REPLICA_NOT_AVAILABLE',
                   'MESSAGE_SIZE_TOO_LARGE','STALE_CONTROLLER_EPOCH','OFFSET_METADATA_TOO_LARGE'])[CAST(event_id % 16 AS INTEGER)]
            ELSE 'UNKNOWN' END AS error_name,
       count(*) AS n
FROM events GROUP BY 1, 2""")
def q_error_names(spark, sf):
    e = fx.table(spark, sf, "events")
    code = ((F.col("event_id") % 16).cast("int") - 1)
    return (e.select(code.alias("code")).groupBy("code")
            .agg(F.count(F.lit(1)).alias("n"))
            .select("code", scalars.error_name("code").alias("error_name"), "n"))


_HOST_SPEC_SQL = """'broker' || CAST(partition_id % 3 AS VARCHAR) ||
       CASE partition_id % 4 WHEN 0 THEN '' WHEN 1 THEN ':9093' WHEN 2 THEN ':x' ELSE ':1:2' END"""


def _host_spec() -> F.Column:
    k = F.col("partition_id")
    suffix = (F.when(k % 4 == 0, F.lit("")).when(k % 4 == 1, F.lit(":9093"))
              .when(k % 4 == 2, F.lit(":x")).otherwise(F.lit(":1:2")))
    return F.concat(F.lit("broker"), (k % 3).cast("string"), suffix)


@query("saved_offset_json", "P13 P14", with_fixtures(["positions"], f"""
SELECT partition_id, CASE WHEN saved IS NOT NULL THEN saved_topology END AS topology_id,
       CASE WHEN saved IS NOT NULL THEN 'sensor' || CAST(partition_id % 10 AS VARCHAR) END AS topology_name,
       saved AS "offset", CASE WHEN saved IS NOT NULL THEN partition_id END AS "partition",
       CASE WHEN saved IS NOT NULL AND partition_id % 4 IN (0, 1) THEN 'broker' || CAST(partition_id % 3 AS VARCHAR) END AS host,
       CASE WHEN saved IS NOT NULL THEN CASE partition_id % 4 WHEN 0 THEN 9092 WHEN 1 THEN 9093 END END AS port,
       CASE partition_id % 4 WHEN 2 THEN 'invalid port' WHEN 3 THEN 'invalid host specification' END AS host_error,
       CASE WHEN saved IS NOT NULL THEN 'readings' END AS topic
FROM positions"""))
def q_saved_offset_json(spark, sf):
    """Partitions without a saved offset have no document."""
    p = fx.positions(spark, sf)
    h = p.withColumn("_h", scalars.parse_host(_host_spec()))
    doc = scalars.saved_offset_json(
        F.col("saved_topology"), F.concat(F.lit("sensor"), (F.col("partition_id") % 10).cast("string")),
        F.col("saved"), F.col("partition_id"), F.col("_h.host"), F.col("_h.port"), F.lit("readings"))
    doc = F.when(F.col("saved").isNotNull(), doc)
    back = h.select("partition_id", F.col("_h.error").alias("host_error"),
                    scalars.read_saved_offset(doc).alias("d"))
    return back.select("partition_id", F.col("d.topology.id").alias("topology_id"),
                       F.col("d.topology.name").alias("topology_name"),
                       F.col("d.offset").alias("offset"), F.col("d.partition").alias("partition"),
                       F.col("d.broker.host").alias("host"), F.col("d.broker.port").alias("port"),
                       "host_error", F.col("d.topic").alias("topic"))


@query("destination_name", "P1 P2 P3 P4", with_fixtures(["destinations"], """
SELECT name,
  CASE WHEN grouped THEN site || '.' || sensor || '.' || p_topic
       WHEN sensor_id IS NOT NULL THEN site || '.' || sensor || '.' || sensor_id || '.' || p_topic END AS kafka_topic,
  CASE WHEN p_queue_name IS NULL THEN NULL WHEN grouped THEN site || '.' || sensor || '.' || p_queue_name
       WHEN sensor_id IS NOT NULL THEN site || '.' || sensor || '.' || sensor_id || '.' || p_queue_name END AS amqp_queue,
  CASE WHEN grouped THEN site || '.' || sensor || '.' || p_routing_key
       WHEN sensor_id IS NOT NULL THEN site || '.' || sensor || '.' || sensor_id || '.' || p_routing_key END AS amqp_routing_key,
  p_exchange AS amqp_exchange,
  p_queue AS jms_queue,
  CASE WHEN NOT grouped AND sensor_id IS NULL THEN 'null sensor_id' END AS reject_kafka,
  CASE WHEN p_queue_name IS NULL THEN 'missing property queueName'
       WHEN NOT grouped AND sensor_id IS NULL THEN 'null sensor_id' END AS reject_amqp,
  CAST(NULL AS VARCHAR) AS reject_jms
FROM destinations"""))
def q_destination_name(spark, sf):
    n = naming.destination_names(fx.destinations(spark, sf))
    return n.select("name", "kafka_topic", "amqp_queue", "amqp_routing_key", "amqp_exchange", "jms_queue",
                    "reject_kafka", "reject_amqp", "reject_jms")


# ---------------------------------------------------------------- routing

@query("route_two_hop", "J1 J3 J4", _route_sql("SELECT message_id, path, destination, route_reason FROM r"))
def q_route_two_hop(spark, sf):
    return _routed_two_hop(spark, sf).select("message_id", "path", "destination", "route_reason")


@query("unroutable", "J3", _route_sql(
    "SELECT message_id, path, route_reason FROM r WHERE route_reason IS NOT NULL"))
def q_unroutable(spark, sf):
    return routing.unroutable(_routed_two_hop(spark, sf)).select("message_id", "path", "route_reason")


@query("route_one_hop", "J2 J3", with_fixtures(["messages", "destinations"], """
SELECT m.message_id, m.dest AS destination,
       CASE WHEN m.dest IS NULL THEN 'no selection' WHEN d.name IS NULL THEN 'producer unknown' END AS route_reason
FROM (SELECT message_id, CASE WHEN origin = 'error' THEN NULL
                              ELSE 'd' || CAST(user_id % 30 AS VARCHAR) END AS dest FROM messages) m
LEFT JOIN destinations d ON m.dest = d.name"""))
def q_route_one_hop(spark, sf):
    m = fx.messages(spark, sf)
    uid = bytes_text("key").cast("long")
    sel = F.when(F.col("origin") == "error", F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("d"), (uid % 30).cast("string")))
    r = routing.route_one_hop(m, sel, fx.destinations(spark, sf))
    return r.select("message_id", "destination", "route_reason")


@query("direct_exchange", "J5", _route_sql("""
, named AS (SELECT name,
     CASE WHEN p_queue_name IS NULL THEN NULL WHEN grouped THEN site || '.' || sensor || '.' || p_queue_name
          WHEN sensor_id IS NOT NULL THEN site || '.' || sensor || '.' || sensor_id || '.' || p_queue_name END AS amqp_queue,
     CASE WHEN grouped THEN site || '.' || sensor || '.' || p_routing_key
          WHEN sensor_id IS NOT NULL THEN site || '.' || sensor || '.' || sensor_id || '.' || p_routing_key END AS routing_key,
     p_exchange AS exchange FROM destinations)
SELECT r.message_id, r.destination, n.exchange, n.routing_key, b.amqp_queue AS bound_queue
FROM r JOIN named n ON r.destination = n.name
LEFT JOIN (SELECT * FROM named WHERE amqp_queue IS NOT NULL) b
  ON n.exchange = b.exchange AND n.routing_key = b.routing_key
WHERE r.route_reason IS NULL"""))
def q_direct_exchange(spark, sf):
    dest = naming.destination_names(fx.destinations(spark, sf))
    pub_names = dest.select(F.col("name").alias("_x_name"), F.col("amqp_exchange").alias("exchange"),
                            F.col("amqp_routing_key").alias("routing_key"))
    r = routing.routed(_routed_two_hop(spark, sf))
    from sluice.operators.joins import dim_join
    pub = dim_join(r, pub_names, F.col("destination") == F.col("_x_name"), "inner").drop("_x_name")
    bindings = (dest.where(F.col("amqp_queue").isNotNull())
                .select(F.col("amqp_exchange").alias("exchange"), F.col("amqp_routing_key").alias("binding_key"),
                        F.col("amqp_queue").alias("queue")))
    out = routing.direct_exchange(pub, bindings)
    return out.select("message_id", "destination", "exchange", "routing_key", "bound_queue")


@query("registry_state", "J6", with_fixtures(["registry_changes"], """
SELECT name, max(seq) AS since_seq FROM registry_changes
WHERE op IN ('add_destination', 'remove_destination')
GROUP BY name HAVING arg_max(op, seq) = 'add_destination'"""))
def q_registry_state(spark, sf):
    return registry.current_destinations(fx.registry_changes(spark, sf))


@query("path_state", "J6", with_fixtures(["registry_changes"], """
SELECT path, arg_max(name, seq) AS destination, max(seq) AS since_seq FROM registry_changes
WHERE op IN ('add_path', 'remove_path')
GROUP BY path HAVING arg_max(op, seq) = 'add_path'"""))
def q_path_state(spark, sf):
    return registry.current_paths(fx.registry_changes(spark, sf))


@query("route_asof", "J7", with_fixtures(["messages", "registry_changes"], """
, sel AS (SELECT message_id, event_id AS seq,
                 CASE WHEN origin = 'error' THEN NULL ELSE 'p' || CAST(user_id % 30 AS VARCHAR) END AS path
          FROM messages),
  pc AS (SELECT seq, path, op = 'add_path' AS bound, name FROM registry_changes WHERE op IN ('add_path', 'remove_path')),
  dc AS (SELECT seq, name, op = 'add_destination' AS live FROM registry_changes
         WHERE op IN ('add_destination', 'remove_destination')),
  h1 AS (SELECT s.message_id, s.seq, s.path, CASE WHEN pc.bound THEN pc.name END AS destination
         FROM sel s ASOF LEFT JOIN pc ON s.path = pc.path AND s.seq >= pc.seq),
  h2 AS (SELECT h1.*, dc.live FROM h1 ASOF LEFT JOIN dc ON h1.destination = dc.name AND h1.seq >= dc.seq)
SELECT message_id, path, destination,
       CASE WHEN path IS NULL THEN 'no selection' WHEN destination IS NULL THEN 'path unknown'
            WHEN NOT coalesce(live, false) THEN 'producer unknown' END AS route_reason
FROM h2"""))
def q_route_asof(spark, sf):
    # Only the columns the route needs go through the checkpointed first hop.
    m = fx.messages(spark, sf).select("message_id", "event_id", "origin", "key")
    sel = fx.selector_path(bytes_text("key"), F.col("origin"))
    r = routing.route_as_of(m, sel, "event_id", fx.registry_changes(spark, sf))
    return r.select("message_id", "path", "destination", "route_reason")


@query("replay_failed", "J8", with_fixtures(["messages", "fail_log"], """
SELECT m.message_id, m."partition", m."offset", s.replay_from
FROM messages m
JOIN (SELECT DISTINCT "partition", "offset" FROM fail_log) f ON m."partition" = f."partition" AND m."offset" = f."offset"
JOIN (SELECT "partition", min("offset") AS replay_from FROM fail_log GROUP BY 1) s ON m."partition" = s."partition" """))
def q_replay_failed(spark, sf):
    r = offsets.replay_failed(fx.messages(spark, sf), fx.fail_log(spark, sf))
    return r.select("message_id", "partition", "offset", "replay_from")


@query("status_gate", "J9", with_fixtures(["queue_state", "next_put", "queue_limits"], """
SELECT o.queue, o.seq, o.op, l.status,
       CASE l.status WHEN 'QUIESCENT' THEN false WHEN 'READ_ONLY' THEN o.op = 'read' ELSE true END AS allowed
FROM (SELECT queue, seq, 'read' AS op FROM queue_state WHERE state = 'waiting'
      UNION ALL SELECT queue, seq, 'write' FROM next_put) o
JOIN queue_limits l ON o.queue = l.queue"""))
def q_status_gate(spark, sf):
    reads = fx.queue_state(spark, sf).where(F.col("state") == "waiting").select("queue", "seq", F.lit("read").alias("op"))
    writes = fx.next_put(spark, sf).select("queue", "seq", F.lit("write").alias("op"))
    g = routing.status_gate(reads.unionByName(writes), fx.queue_limits(spark, sf))
    return g.select("queue", "seq", "op", "status", "allowed")


# ---------------------------------------------------------------- aggregates

@query("running_latency", "A1 P10", with_fixtures(["latencies"], """
, w AS (SELECT l.* FROM latencies l
        JOIN (SELECT task, arg_min(arrival_ms, seq) AS first_ms FROM latencies GROUP BY task) f ON l.task = f.task
        WHERE l.arrival_ms - f.first_ms > 5000),
  e AS (SELECT *, sum(CASE WHEN val < 0 THEN 1 ELSE 0 END) OVER (PARTITION BY task ORDER BY seq) AS epoch FROM w)
SELECT task, seq, val,
       round(avg(val) OVER (PARTITION BY task, epoch ORDER BY seq ROWS UNBOUNDED PRECEDING), 6) AS mean_latency
FROM e WHERE val >= 0
"""))
def q_running_latency(spark, sf):
    r = latency.running_latency(fx.latencies(spark, sf))
    return r.withColumn("mean_latency", F.round("mean_latency", 6))


@query("queue_info", "A2", with_fixtures(["queue_state"], f"""
SELECT queue,
       CAST(sum(CASE WHEN live THEN 1 ELSE 0 END) AS BIGINT) AS items,
       CAST(sum(CASE WHEN live THEN strlen(value) ELSE 0 END) AS BIGINT) AS bytes,
       {OBSERVED_MS} - epoch_ms(arg_min(put_at, seq) FILTER (WHERE live)) AS age_ms,
       CAST(sum(CASE WHEN state = 'open' THEN 1 ELSE 0 END) AS BIGINT) AS open_transactions,
       arg_min(value, seq) FILTER (WHERE live) AS head_item
FROM (SELECT *, state = 'waiting' AND (expiration_ms = 0
              OR {OBSERVED_MS} - epoch_ms(put_at) <= expiration_ms) AS live FROM queue_state)
GROUP BY queue"""))
def q_queue_info(spark, sf):
    return queues.queue_info(fx.queue_state(spark, sf), _observed())


_COMMIT_SQL = """
, st AS (SELECT e."partition", e."offset", a."offset" IS NOT NULL AS acked
         FROM emitted e LEFT JOIN (SELECT DISTINCT "partition", "offset" FROM ack_log) a
           ON e."partition" = a."partition" AND e."offset" = a."offset"),
  cp AS (SELECT "partition", min(CASE WHEN NOT acked THEN "offset" END) AS min_pending,
                max("offset") + 1 AS next_offset,
                CAST(sum(CASE WHEN NOT acked THEN 1 ELSE 0 END) AS BIGINT) AS pending
         FROM st GROUP BY 1)
"""


def _commit_sql(select: str, extra: list[str] | None = None) -> str:
    base = fixtures_prefix(["emitted", "ack_log"] + (extra or []))
    return base + _COMMIT_SQL.rstrip() + "\n" + select


@query("commit_point", "A3", _commit_sql(
    "SELECT *, coalesce(min_pending, next_offset) AS commit_offset FROM cp"))
def q_commit_point(spark, sf):
    return offsets.commit_point(fx.emitted(spark, sf), fx.ack_log(spark, sf))


@query("commit_changes", "A4", _commit_sql("""
SELECT cp."partition", coalesce(min_pending, next_offset) AS commit_offset, p.saved AS saved_offset
FROM cp LEFT JOIN positions p ON cp."partition" = p.partition_id
WHERE p.saved IS NULL OR p.saved <> coalesce(min_pending, next_offset)""", ["positions"]))
def q_commit_changes(spark, sf):
    pts = offsets.commit_point(fx.emitted(spark, sf), fx.ack_log(spark, sf))
    saved = fx.positions(spark, sf).select(F.col("partition_id").cast("int").alias("partition"),
                                           F.col("saved").alias("saved_offset"))
    return offsets.commit_changes(pts, saved).select("partition", "commit_offset", "saved_offset")


_ADMIT_SQL = f"""
, nx AS (SELECT "partition", max("offset") + 1 AS next_offset FROM emitted GROUP BY 1),
  fa AS (SELECT f."partition", f."offset", f.fail_seq, nx.next_offset,
                coalesce(f."offset" >= nx.next_offset - {MAX_BEHIND}, false) AS admitted
         FROM fail_log f LEFT JOIN nx ON f."partition" = nx."partition")
"""


@query("fail_admission", "T4", fixtures_prefix(["emitted", "fail_log"])
       + _ADMIT_SQL.rstrip() + "\nSELECT \"partition\", \"offset\", next_offset, admitted FROM fa")
def q_fail_admission(spark, sf):
    r = offsets.fail_admission(fx.fail_log(spark, sf), fx.emitted(spark, sf), MAX_BEHIND)
    return r.select("partition", "offset", "next_offset", "admitted")


@query("ack_counters", "A5", fixtures_prefix(["emitted", "ack_log", "fail_log"])
       + _COMMIT_SQL.rstrip() + _ADMIT_SQL.rstrip() + f"""
SELECT a."partition", a.acked, coalesce(f.failed, 0) AS failed,
       a.acked = 0 AND coalesce(f.failed, 0) > {MAX_BEHIND} AS error
FROM (SELECT "partition", CAST(sum(CASE WHEN acked THEN 1 ELSE 0 END) AS BIGINT) AS acked FROM st GROUP BY 1) a
LEFT JOIN (SELECT "partition", count(*) AS failed FROM fa WHERE admitted GROUP BY 1) f
  ON a."partition" = f."partition" """)
def q_ack_counters(spark, sf):
    return offsets.ack_counters(fx.emitted(spark, sf), fx.ack_log(spark, sf), fx.fail_log(spark, sf), MAX_BEHIND)


# ---------------------------------------------------------------- offsets

def _start_sql(force: bool) -> str:
    start = "earliest" if force else '"current"'
    other = "saved_topology <> 'A'" + (" AND true" if force else " AND false")
    return with_fixtures(["positions"], f"""
, b AS (SELECT partition_id, {start} AS start,
               CASE WHEN saved IS NULL THEN 'none_saved' WHEN {other} THEN 'topology_changed' ELSE 'saved' END AS branch,
               CASE WHEN saved IS NULL THEN {start} WHEN {other} THEN earliest ELSE saved END AS committed
        FROM positions)
SELECT partition_id, branch, committed,
       (start - committed > {MAX_BEHIND} OR committed <= 0) AS reset,
       CASE WHEN start - committed > {MAX_BEHIND} OR committed <= 0 THEN start ELSE committed END AS start_offset
FROM b""")


@query("start_offset_plan", "D1", _start_sql(False))
def q_start_offset_plan(spark, sf):
    return offsets.start_offset_plan(fx.positions(spark, sf), fx.RUNNING_TOPOLOGY, False, MAX_BEHIND)


@query("start_offset_plan_forced", "D1", _start_sql(True))
def q_start_offset_plan_forced(spark, sf):
    return offsets.start_offset_plan(fx.positions(spark, sf), fx.RUNNING_TOPOLOGY, True, MAX_BEHIND)


START_TIME_MS = 1_704_890_096_789        # 2024-01-10 12:34:56.789 UTC
_TIMES_SQL = """
, times AS (SELECT CAST(1704067200000 + i * 133200000 AS BIGINT) AS time_ms FROM range(26) t(i) UNION ALL SELECT CAST(v AS BIGINT) FROM (VALUES (-1), (-2)) x(v))"""


@query("offset_for_time", "D1", with_fixtures(["messages"], _TIMES_SQL + """
SELECT p."partition", t.time_ms,
       CASE t.time_ms WHEN -2 THEN (SELECT min("offset") FROM messages m WHERE m."partition" = p."partition")
            WHEN -1 THEN (SELECT max("offset") + 1 FROM messages m WHERE m."partition" = p."partition")
            ELSE coalesce((SELECT min("offset") FROM messages m WHERE m."partition" = p."partition" AND m.sent_ms >= t.time_ms),
                          (SELECT max("offset") + 1 FROM messages m WHERE m."partition" = p."partition")) END AS offset_at
FROM (SELECT DISTINCT "partition" FROM messages) p, times t"""))
def q_offset_for_time(spark, sf):
    m = fx.messages(spark, sf)
    times = [offsets.LATEST_TIME, offsets.EARLIEST_TIME, *(1_704_067_200_000 + i * 133_200_000 for i in range(26))]
    requests = m.select("partition").distinct().withColumn("time_ms", F.explode(F.lit(times).cast("array<long>")))
    return offsets.offsets_for_times(m.select("partition", "offset", "ts"), requests)


def _positions_at(spark: SparkSession, sf: str, time_ms: int) -> DataFrame:
    """Positions of the message partitions, with the offset at ``time_ms``."""
    m = fx.messages(spark, sf).select("partition", "offset", "ts")
    at = offsets.offsets_for_times(m, m.select("partition").distinct().withColumn("time_ms", F.lit(time_ms).cast("long")))
    ends = m.groupBy("partition").agg(F.min("offset").alias("earliest"), (F.max("offset") + 1).alias("current"))
    p = F.col("partition")
    saved = F.when(p == 0, F.lit(None).cast("long")).when(p == 1, F.lit(0)).when(p == 2, F.lit(10)).otherwise(F.col("offset_at") + 5)
    return at.join(ends, "partition").select(p.alias("partition_id"), "earliest", "current", F.col("offset_at").alias("at_time"), saved.cast("long").alias("saved"),
                                             F.when(p == 2, F.lit("B")).otherwise(F.lit("A")).alias("saved_topology"))


_AT_TIME_SQL = f"""
, ends AS (SELECT "partition", min("offset") AS earliest, max("offset") + 1 AS latest,
                  coalesce(min("offset") FILTER (WHERE sent_ms >= {START_TIME_MS}), max("offset") + 1) AS at_time FROM messages GROUP BY "partition"),
  pos AS (SELECT "partition" AS partition_id, earliest, latest, at_time,
                 CASE "partition" WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN 10 ELSE at_time + 5 END AS saved,
                 CASE WHEN "partition" = 2 THEN 'B' ELSE 'A' END AS saved_topology FROM ends)"""


@query("start_offset_plan_time", "D1", with_fixtures(["messages"], _AT_TIME_SQL + f"""
, b AS (SELECT partition_id, at_time AS start, CASE WHEN saved IS NULL THEN 'none_saved' WHEN saved_topology <> 'A' THEN 'topology_changed' ELSE 'saved' END AS branch,
               CASE WHEN saved IS NULL OR saved_topology <> 'A' THEN at_time ELSE saved END AS committed FROM pos)
SELECT partition_id, branch, CAST(committed AS BIGINT) AS committed, (start - committed > {MAX_BEHIND} OR committed <= 0) AS reset,
       CAST(CASE WHEN start - committed > {MAX_BEHIND} OR committed <= 0 THEN start ELSE committed END AS BIGINT) AS start_offset FROM b"""))
def q_start_offset_plan_time(spark, sf):
    """D1 with startOffsetTime a point in time."""
    return offsets.start_offset_plan(_positions_at(spark, sf, START_TIME_MS), fx.RUNNING_TOPOLOGY, True, MAX_BEHIND, start_column="at_time")


@query("range_reset_time", "D3", with_fixtures(["messages"], _AT_TIME_SQL + """
SELECT partition_id, CAST(saved AS BIGINT) AS requested, CASE WHEN saved < earliest OR saved > latest THEN 'reset' WHEN saved IS NOT NULL THEN 'ok' END AS fetch_status,
       CAST(CASE WHEN saved < earliest OR saved > latest THEN at_time ELSE saved END AS BIGINT) AS fetch_offset
FROM (SELECT * REPLACE (CASE WHEN partition_id = 1 THEN -3 WHEN partition_id = 3 THEN latest + 1 ELSE saved END AS saved) FROM pos)"""))
def q_range_reset_time(spark, sf):
    """D3 with startOffsetTime a point in time: offsets out of range are fetched from there."""
    p = _positions_at(spark, sf, START_TIME_MS)
    asked = F.when(F.col("partition_id") == 1, F.lit(-3)).when(F.col("partition_id") == 3, F.col("current") + 1).otherwise(F.col("saved"))
    r = offsets.range_reset(p.select("partition_id", asked.cast("long").alias("requested"), "earliest", F.col("current").alias("latest"), "at_time"), start_offset_time="at_time")
    return r.select("partition_id", "requested", "fetch_status", "fetch_offset")


@query("fetch_slice", "D2", fixtures_prefix(["messages", "emitted", "ack_log"])
       + _COMMIT_SQL.rstrip() + f"""
, s AS (SELECT m.message_id, m."partition", m."offset", CAST(strlen(m.value_text) AS BIGINT) AS size,
               row_number() OVER (PARTITION BY m."partition" ORDER BY m."offset") AS n,
               sum(CAST(strlen(m.value_text) AS BIGINT)) OVER (PARTITION BY m."partition" ORDER BY m."offset"
                   ROWS UNBOUNDED PRECEDING) AS slice_bytes
        FROM messages m JOIN cp ON m."partition" = cp."partition"
        WHERE m."offset" >= coalesce(cp.min_pending, cp.next_offset))
SELECT message_id, "partition", "offset", CAST(slice_bytes AS BIGINT) AS slice_bytes FROM s
WHERE n = 1 OR slice_bytes <= {FETCH_BYTES}""")
def q_fetch_slice(spark, sf):
    pts = offsets.commit_point(fx.emitted(spark, sf), fx.ack_log(spark, sf))
    starts = pts.select("partition", F.col("commit_offset").alias("start_offset"))
    s = offsets.fetch_slice(fx.messages(spark, sf), starts, FETCH_BYTES)
    return s.select("message_id", "partition", "offset", "slice_bytes")


@query("range_reset", "D3", with_fixtures(["positions"], """
SELECT partition_id, saved AS requested,
       CASE WHEN saved IS NULL THEN NULL WHEN saved < earliest OR saved > "current" THEN 'reset' ELSE 'ok' END AS fetch_status,
       CASE WHEN saved < earliest OR saved > "current" THEN earliest ELSE saved END AS fetch_offset
FROM positions"""))
def q_range_reset(spark, sf):
    return offsets.range_reset(_requests(spark, sf)).select("partition_id", "requested", "fetch_status", "fetch_offset")


def _requests(spark, sf) -> DataFrame:
    return fx.positions(spark, sf).select("partition_id", F.col("saved").alias("requested"), "earliest", F.col("current").alias("latest"))


@query("range_reset_latest", "D3", with_fixtures(["positions"], """
SELECT partition_id, CASE WHEN saved < earliest OR saved > "current" THEN "current" ELSE saved END AS latest_offset,
       CASE WHEN saved IS NULL THEN NULL WHEN saved < earliest OR saved > "current" THEN 'error' ELSE 'ok' END AS strict_status
FROM positions"""))
def q_range_reset_latest(spark, sf):
    """Start offset time latest, and the strict form in which a request out of range is an error."""
    late = offsets.range_reset(_requests(spark, sf), start_offset_time="latest").select("partition_id", F.col("fetch_offset").alias("latest_offset"))
    strict = offsets.range_reset(_requests(spark, sf), False).select("partition_id", F.col("fetch_status").alias("strict_status"))
    return late.join(strict, "partition_id")


# ---------------------------------------------------------------- queues

_LIVE_SQL = f"(expiration_ms = 0 OR {OBSERVED_MS} - epoch_ms(put_at) <= expiration_ms)"


@query("queue_get", "D4 D5", with_fixtures(["queue_state"], f"""
SELECT queue, seq, value, position FROM (
  SELECT queue, seq, value, row_number() OVER (PARTITION BY queue ORDER BY seq) AS position
  FROM queue_state WHERE state = 'waiting' AND {_LIVE_SQL})
WHERE position <= {GET_MAX_ITEMS}"""))
def q_queue_get(spark, sf):
    g = queues.get(fx.queue_state(spark, sf), _observed(), GET_MAX_ITEMS)
    return g.select("queue", "seq", "value", "position")


@query("queue_get_state", "D4 D6", with_fixtures(["queue_state"], f"""
SELECT queue, seq, CASE WHEN got AND auto_abort_ms = 0 THEN 'confirmed' WHEN got THEN 'open' ELSE state END AS state,
       CASE WHEN got AND auto_abort_ms = 0 THEN 0 WHEN got THEN seq END AS txn_id,
       CASE WHEN got THEN {OBSERVED_MS} ELSE epoch_ms(opened_at) END AS opened_ms
FROM (SELECT *, state = 'waiting' AND row_number() OVER (PARTITION BY queue, state ORDER BY seq) <= 1024 AS got
      FROM queue_state WHERE state <> 'waiting' OR {_LIVE_SQL})"""))
def q_queue_get_state(spark, sf):
    """All waiting items up to the default limit of 1024, and the table after it."""
    g = queues.get_state(fx.queue_state(spark, sf), _observed())
    return g.select("queue", "seq", "state", "txn_id", epoch_ms("opened_at").alias("opened_ms"))


@query("queue_expired", "D5", with_fixtures(["queue_state"], f"""
SELECT queue, seq, {OBSERVED_MS} - epoch_ms(put_at) AS age_ms, expiration_ms
FROM queue_state WHERE state = 'waiting' AND NOT {_LIVE_SQL}"""))
def q_queue_expired(spark, sf):
    e = queues.expired(fx.queue_state(spark, sf), _observed())
    return e.select("queue", "seq", queues.age_ms(_observed()).alias("age_ms"), "expiration_ms")


@query("auto_abort", "D6", with_fixtures(["queue_state"], f"""
SELECT queue, seq,
       CASE WHEN state <> 'open' THEN state WHEN auto_abort_ms = 0 THEN 'confirmed'
            WHEN {OBSERVED_MS} - epoch_ms(opened_at) > auto_abort_ms THEN 'waiting' ELSE 'open' END AS new_state,
       CASE WHEN state = 'open' AND auto_abort_ms = 0 THEN 0 ELSE seq END AS txn_id
FROM queue_state"""))
def q_auto_abort(spark, sf):
    a = queues.auto_abort(fx.queue_state(spark, sf), _observed())
    return a.select("queue", "seq", "new_state", "txn_id")


def _ids(spark, sf, confirm: bool) -> DataFrame:
    q = fx.queue_state(spark, sf).where(F.col("state") == "open")
    cond = F.col("price") > CONFIRM_PRICE
    return q.where(cond if confirm else ~cond).select("queue", "seq")


@query("confirm", "D7", with_fixtures(["queue_state"], f"""
SELECT queue, seq, state FROM queue_state
WHERE NOT (state = 'open' AND price > {CONFIRM_PRICE})"""))
def q_confirm(spark, sf):
    r = queues.confirm(fx.queue_state(spark, sf), _ids(spark, sf, True))
    return r.select("queue", "seq", "state")


@query("abort", "D7", with_fixtures(["queue_state"], f"""
SELECT queue, seq, CASE WHEN state = 'open' AND price <= {CONFIRM_PRICE} THEN 'waiting' ELSE state END AS state
FROM queue_state"""))
def q_abort(spark, sf):
    r = queues.abort(fx.queue_state(spark, sf), _ids(spark, sf, False))
    return r.select("queue", "seq", "state")


_PUT_SQL = f"""
, w AS (SELECT queue, count(*) AS waiting FROM queue_state WHERE state = 'waiting' AND {_LIVE_SQL} GROUP BY 1),
  fr AS (SELECT l.queue, greatest(l.capacity - coalesce(w.waiting, 0), 0) AS free
         FROM queue_limits l LEFT JOIN w ON l.queue = w.queue),
  pc AS (SELECT p.queue, p.seq, fr.free IS NULL OR row_number() OVER (PARTITION BY p.queue ORDER BY p.seq) <= fr.free AS accepted
         FROM next_put p LEFT JOIN fr ON p.queue = fr.queue)
"""


def _put_sql(select: str) -> str:
    base = fixtures_prefix(["queue_state", "next_put", "queue_limits"])
    return base + _PUT_SQL.rstrip() + "\n" + select


def _put(spark, sf) -> DataFrame:
    waiting = queues.expire(fx.queue_state(spark, sf), _observed())
    return queues.put_with_capacity(fx.next_put(spark, sf), waiting, fx.queue_limits(spark, sf))


@query("put_capacity", "D8", _put_sql("SELECT queue, seq, accepted FROM pc"))
def q_put_capacity(spark, sf):
    return _put(spark, sf).select("queue", "seq", "accepted")


def _info_sql(where: str, known: str) -> str:
    return with_fixtures(["queue_state"], f"""
, s AS (SELECT *, state = 'waiting' AND {_LIVE_SQL} AS live FROM queue_state WHERE {where}),
  i AS (SELECT queue,
       CAST(sum(CASE WHEN live THEN 1 ELSE 0 END) AS BIGINT) AS items,
       CAST(sum(CASE WHEN live THEN strlen(value) ELSE 0 END) AS BIGINT) AS bytes,
       {OBSERVED_MS} - epoch_ms(arg_min(put_at, seq) FILTER (WHERE live)) AS age_ms,
       CAST(sum(CASE WHEN state = 'open' THEN 1 ELSE 0 END) AS BIGINT) AS open_transactions,
       arg_min(value, seq) FILTER (WHERE live) AS head_item
       FROM s GROUP BY queue)
SELECT k.queue, coalesce(i.items, 0) AS items, coalesce(i.bytes, 0) AS bytes, i.age_ms,
       coalesce(i.open_transactions, 0) AS open_transactions, i.head_item
FROM ({known}) k LEFT JOIN i ON k.queue = i.queue""")


_FLUSH_LIST = ", ".join(f"'{q}'" for q in FLUSHED)
_DELETE_LIST = ", ".join(f"'{q}'" for q in DELETED)


@query("queue_flush", "D9", _info_sql(f"NOT (state = 'waiting' AND queue IN ({_FLUSH_LIST}))",
                                      "SELECT DISTINCT queue FROM queue_state"))
def q_queue_flush(spark, sf):
    st = fx.queue_state(spark, sf)
    return queues.queue_info(queues.flush(st, FLUSHED), _observed(), known_queues=st.select("queue"))


@query("queue_delete", "D9", _info_sql(f"queue NOT IN ({_DELETE_LIST})",
                                       f"SELECT DISTINCT queue FROM queue_state WHERE queue NOT IN ({_DELETE_LIST})"))
def q_queue_delete(spark, sf):
    st = queues.delete_queue(fx.queue_state(spark, sf), DELETED)
    return queues.queue_info(st, _observed(), known_queues=st.select("queue"))


@query("op_counts", "A6", _put_sql(f"""
SELECT queue, CAST(sum(CASE WHEN op = 'put' THEN 1 ELSE 0 END) AS BIGINT) AS put_count,
       CAST(sum(CASE WHEN op = 'confirm' THEN 1 ELSE 0 END) AS BIGINT) AS confirm_count,
       CAST(sum(CASE WHEN op = 'abort' THEN 1 ELSE 0 END) AS BIGINT) AS abort_count
FROM (SELECT queue, 'put' AS op FROM pc WHERE accepted
      UNION ALL SELECT queue, CASE WHEN price > {CONFIRM_PRICE} THEN 'confirm' ELSE 'abort' END
      FROM queue_state WHERE state = 'open')
GROUP BY queue"""))
def q_op_counts(spark, sf):
    put = _put(spark, sf).where("accepted")
    return queues.op_counts(put, _ids(spark, sf, True), _ids(spark, sf, False))


# ---------------------------------------------------------------- acknowledgements

@query("ack_pending", "T1", with_fixtures(["emitted", "ack_log"], """
SELECT e."partition", e."offset" FROM emitted e
WHERE NOT EXISTS (SELECT 1 FROM ack_log a WHERE a."partition" = e."partition" AND a."offset" = e."offset")"""))
def q_ack_pending(spark, sf):
    return acks.ack_pending(fx.emitted(spark, sf), fx.ack_log(spark, sf))


@query("ack_unknown", "T1", with_fixtures(["emitted", "ack_log"], """
SELECT a."partition", a."offset", a.ack_seq FROM ack_log a
WHERE NOT EXISTS (SELECT 1 FROM emitted e WHERE a."partition" = e."partition" AND a."offset" = e."offset")"""))
def q_ack_unknown(spark, sf):
    return acks.ack_unknown(fx.emitted(spark, sf), fx.ack_log(spark, sf))


@query("fail_disposition", "T2", with_fixtures(["fail_log"], """
SELECT "partition", "offset", protocol, requeue,
       CASE protocol WHEN 'amqp' THEN CASE WHEN requeue THEN 'requeue' ELSE 'dead_letter' END
                     WHEN 'kestrel' THEN 'abort' WHEN 'jms' THEN 'drop' WHEN 'mqtt' THEN 'drop'
                     WHEN 'kafka' THEN 'replay' END AS disposition
FROM (SELECT *, (['kafka','amqp','jms','mqtt','kestrel'])[CAST(fail_seq % 5 AS INTEGER) + 1] AS protocol,
             fail_seq % 2 = 0 AS requeue FROM fail_log)"""))
def q_fail_disposition(spark, sf):
    f = fx.fail_log(spark, sf)
    eid = F.col("fail_seq")
    f = f.select("partition", "offset", fx.protocol_of(eid).alias("protocol"), (eid % 2 == 0).alias("requeue"))
    return f.withColumn("disposition", acks.fail_disposition(F.col("protocol"), F.col("requeue")))


@query("pending_prune_unbounded", "T3", with_fixtures(["emitted", "ack_log"], """
, ranked AS (SELECT "partition", "offset", ack_seq,
                    row_number() OVER (PARTITION BY "partition" ORDER BY ack_seq, "offset") AS t FROM ack_log),
  tau AS (SELECT "partition", "offset", min(t) AS tau FROM ranked GROUP BY 1, 2),
  e AS (SELECT e."partition", e."offset", coalesce(tau.tau, 4611686018427387904) AS tau
        FROM (SELECT DISTINCT "partition", "offset" FROM emitted) e
        LEFT JOIN tau ON e."partition" = tau."partition" AND e."offset" = tau."offset")
SELECT r."partition", r.ack_seq, r."offset", 'remove' AS action,
       (SELECT min(e."offset") FROM e WHERE e."partition" = r."partition" AND e.tau > r.t - 1) AS min_pending_before,
       (SELECT min(e."offset") FROM e WHERE e."partition" = r."partition" AND e.tau > r.t) AS min_pending_after
FROM ranked r"""))
def q_pending_prune_unbounded(spark, sf):
    """T3 with the reference's default bound (none): parallel form."""
    return acks.pending_prune(fx.ack_log(spark, sf), fx.emitted(spark, sf), None)


def _prune_sql(log: str, behind: int) -> str:
    """The ledger ack by ack: the pending offsets are a list that every step makes anew."""
    return fixtures_prefix(["emitted", log]).replace("WITH", "WITH RECURSIVE", 1) + f"""
, ranked AS MATERIALIZED (
  SELECT "partition", "offset", ack_seq, row_number() OVER (PARTITION BY "partition" ORDER BY ack_seq, "offset") AS t FROM {log}),
  f AS (
  SELECT e."partition", CAST(0 AS BIGINT) AS t, CAST(NULL AS BIGINT) AS ack_seq, CAST(NULL AS BIGINT) AS "offset", CAST(NULL AS VARCHAR) AS action,
         CAST(NULL AS BIGINT) AS min_pending_before, list(DISTINCT e."offset" ORDER BY e."offset") AS pending
  FROM emitted e GROUP BY e."partition"
  UNION ALL
  SELECT f."partition", r.t, r.ack_seq, r."offset", CASE WHEN f.pending[1] < r."offset" - {behind} THEN 'clear' ELSE 'remove' END, f.pending[1],
         CASE WHEN f.pending[1] < r."offset" - {behind} THEN list_filter(f.pending, lambda x: x >= r."offset")
              ELSE list_filter(f.pending, lambda x: x <> r."offset") END
  FROM f JOIN ranked r ON r."partition" = f."partition" AND r.t = f.t + 1)
SELECT "partition", ack_seq, "offset", action, min_pending_before, pending[1] AS min_pending_after FROM f WHERE t > 0"""


@query("pending_prune", "T3", _prune_sql("ack_log", MAX_BEHIND))
def q_pending_prune(spark, sf):
    return acks.pending_prune(fx.ack_log(spark, sf), fx.emitted(spark, sf), MAX_BEHIND)


@query("pending_prune_clears", "T3", _prune_sql("lagging_ack_log", fx.PRUNE_BEHIND))
def q_pending_prune_clears(spark, sf):
    """T3 with a bound that clears every partition many times."""
    return acks.pending_prune(fx.lagging_ack_log(spark, sf), fx.emitted(spark, sf), fx.PRUNE_BEHIND)




@query("flagship_route_counts", "P1 P7 J1 J3 (flagship)", _route_sql(""",
  named AS (SELECT name,
      CASE WHEN grouped THEN site || '.' || sensor || '.' || p_topic
           WHEN sensor_id IS NOT NULL THEN site || '.' || sensor || '.' || sensor_id || '.' || p_topic END AS kafka_topic
      FROM destinations)
SELECT r.destination, count(*) AS messages, CAST(sum(d.k) AS BIGINT) AS sum_k, max(d."offset") AS max_offset,
       n.kafka_topic
FROM r JOIN (""" + _DECODE_SQL.strip()[len("d AS ("):-1] + """) d ON r.message_id = d.message_id
LEFT JOIN named n ON r.destination = n.name
WHERE d.dead_reason IS NULL AND r.route_reason IS NULL
GROUP BY r.destination, n.kafka_topic"""))
def q_flagship(spark, sf):
    from sluice.plans.flagship import flagship
    return flagship(spark, sf)


# ---------------------------------------------------------------- streaming twins
# Each runs a Structured Streaming query to completion (AvailableNow, with a
# checkpoint in the session's shared checkpoint folder) over the table files,
# then reads its sink back.  The oracle is the batch twin's SQL.

def _stream_route_sql() -> str:
    base = fixtures_prefix(["messages", "paths", "destinations"])
    return (base + ",\n" + _ROUTE_SQL_BODY.strip() + ",\n"
            + _DECODE_SQL.strip() + """
SELECT r.message_id, r.path, r.destination, r.route_reason, d.dead_reason, d.k,
       CASE WHEN d.dead_reason IS NOT NULL THEN 'dead' WHEN r.route_reason IS NOT NULL THEN 'unroutable'
            ELSE 'good' END AS output
FROM r JOIN d ON r.message_id = d.message_id""")


@query("stream_route", "S2 S7 S12 T5 P7 J1 J3", _stream_route_sql())
def q_stream_route(spark, sf):
    from sluice.streaming import pipelines as sp
    base = sp.fresh_dir(spark, "stream-route")
    ev = sp.table_stream(spark, sf, "events", order="event_id", batches=3)
    sp.route_stream(spark, ev, fx.paths(spark), fx.destinations(spark, sf), f"{base}/out", f"{base}/ckpt")
    out = spark.read.parquet(f"{base}/out/routes")
    return out.select("message_id", "path", "destination", "route_reason", "dead_reason", "k", "output")


def _stream_amqp_sql() -> str:
    base = fixtures_prefix(["messages", "paths", "destinations"])
    return (base + """,
  pub AS (SELECT name, p_exchange AS exchange,
                 CASE WHEN grouped THEN site || '.' || sensor || '.' || p_routing_key
                      ELSE site || '.' || sensor || '.' || sensor_id || '.' || p_routing_key END AS routing_key
          FROM destinations WHERE p_queue_name IS NOT NULL AND (grouped OR sensor_id IS NOT NULL)),
  sel AS (SELECT message_id, value_text, CASE WHEN origin = 'error' THEN NULL
                                  ELSE 'p' || CAST(user_id % 30 AS VARCHAR) END AS path FROM messages),
  """ + _DECODE_SQL.strip() + """
SELECT sel.message_id, pub.exchange, pub.routing_key, CAST(strlen(sel.value_text) AS BIGINT) AS body_len
FROM sel JOIN paths p ON sel.path = p.path JOIN pub ON p.destination = pub.name
JOIN d ON sel.message_id = d.message_id
WHERE d.dead_reason IS NULL""")


@query("stream_route_amqp", "S2 S7 P2 P4 J1 T5", _stream_amqp_sql())
def q_stream_route_amqp(spark, sf):
    from sluice.streaming import pipelines as sp
    base = sp.fresh_dir(spark, "stream-amqp")
    ev = sp.table_stream(spark, sf, "events", order="event_id", batches=3)
    sp.route_stream(spark, ev, fx.paths(spark), fx.destinations(spark, sf), f"{base}/out", f"{base}/ckpt",
                    protocol="amqp")
    r = spark.read.parquet(f"{base}/out/amqp")
    return r.select("message_id", "exchange", "routing_key", F.length("body").cast("long").alias("body_len"))


@query("stream_auto_abort", "D6 D7 T5", with_fixtures(["queue_state"], f"""
, o AS (SELECT * FROM queue_state WHERE state = 'open' AND NOT (price > {CONFIRM_PRICE})),
  hw AS (SELECT max(opened_at) AS hw FROM queue_state WHERE state = 'open')
SELECT o.queue, o.seq,
       CASE WHEN auto_abort_ms = 0 THEN 'confirmed' ELSE 'waiting' END AS new_state,
       CASE WHEN auto_abort_ms = 0 THEN 0 ELSE o.seq END AS txn_id
FROM o, hw
WHERE auto_abort_ms = 0 OR epoch_ms(hw.hw) - epoch_ms(o.opened_at) > auto_abort_ms"""))
def q_stream_auto_abort(spark, sf):
    from sluice.streaming import pipelines as sp
    base = sp.fresh_dir(spark, "stream-abort")
    orders = sp.table_stream(spark, sf, "orders", order="o_orderkey", batches=3)
    opened = fx.queue_items_from(orders).where((F.col("state") == "open") & (F.col("put_at") <= fx.observed_at()))
    sp.auto_abort_stream(spark, opened, _ids(spark, sf, True), f"{base}/out", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/out/decided").select("queue", "seq", "new_state", "txn_id")


@query("stream_route_kestrel", "S5 S10 J2 T5", _decode_sql("""
, sel AS (SELECT message_id, value_text, CASE WHEN origin = 'error' THEN NULL
                                  ELSE 'd' || CAST(user_id % 30 AS VARCHAR) END AS dest FROM messages)
SELECT sel.message_id, sel.dest AS queue, CAST(strlen(sel.value_text) AS BIGINT) AS data_len,
       CAST(30000 AS BIGINT) AS expiration_ms
FROM sel JOIN d ON sel.message_id = d.message_id
WHERE d.dead_reason IS NULL AND sel.dest IN (SELECT 'd' || CAST(n_nationkey AS VARCHAR) FROM nation)"""))
def q_stream_route_kestrel(spark, sf):
    from sluice.streaming import pipelines as sp
    base = sp.fresh_dir(spark, "stream-kestrel")
    ev = sp.table_stream(spark, sf, "events", order="event_id", batches=3)
    sp.route_stream(spark, ev, fx.paths(spark), fx.destinations(spark, sf), f"{base}/out", f"{base}/ckpt",
                    protocol="kestrel")
    r = spark.read.parquet(f"{base}/out/kestrel")
    return r.select("message_id", "queue", F.length("data").cast("long").alias("data_len"), "expiration_ms")


@query("stream_route_asof", "J6 J7 T5", CATALOGUE["route_asof"].sql)
def q_stream_route_asof(spark, sf):
    from sluice.streaming import pipelines as sp
    base = sp.fresh_dir(spark, "stream-asof")
    sp.route_asof_stream(spark, sp.table_stream(spark, sf, "events", order="event_id", batches=3), f"{base}/out", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/out/routes").select("message_id", "path", "destination", "route_reason")


@query("stream_route_asof_late", "J6 J7 T5", CATALOGUE["route_asof"].sql)
def q_stream_route_asof_late(spark, sf):
    """Events arrive up to 200 places late: messages wait until the horizon has passed them, so a change that comes after
    a message it concerns still counts; the state keeps live names and the changes within the horizon."""
    from sluice.streaming import pipelines as sp
    base = sp.fresh_dir(spark, "stream-asof-late")
    late = fx.table(spark, sf, "events").withColumn("arrival", F.col("event_id") + F.col("event_id") * 37 % 200)
    path = sp.land_in_order(late, "arrival", 3, "events")
    sp.route_asof_late_stream(sp.landed_stream(spark, path), 200, f"{base}/out", f"{base}/ckpt")
    routed = spark.read.parquet(f"{base}/out/routes").select("message_id", "path", "destination", "route_reason")
    return routed.unionByName(sp.route_waiting(spark, f"{base}/out"))


@query("stream_latency", "A1 P10 T5", CATALOGUE["running_latency"].sql)
def q_stream_latency(spark, sf):
    from sluice.streaming import pipelines as sp
    base = sp.fresh_dir(spark, "stream-latency")
    sp.latency_stream(spark, sp.table_stream(spark, sf, "events", order="event_id", batches=3), f"{base}/out", f"{base}/ckpt")
    r = spark.read.parquet(f"{base}/out/means").select("task", "seq", "val", "mean_latency")
    return r.withColumn("mean_latency", F.round("mean_latency", 6))


@query("stream_bridge", "S11 D4 D5", with_fixtures(["queue_state"], f"""
SELECT 'recv:' || queue AS queue, seq, value, CAST(30000 AS BIGINT) AS expiration_ms
FROM queue_state WHERE state = 'waiting' AND {_LIVE_SQL}"""))
def q_stream_bridge(spark, sf):
    from sluice.streaming import pipelines as sp
    base = sp.fresh_dir(spark, "stream-bridge")
    sp.bridge_stream(spark, sp.table_stream(spark, sf, "orders", order="o_orderkey", batches=3), f"{base}/out", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/out").select("queue", "seq", "value", "expiration_ms")


@query("stream_pending_prune", "T3 T5", CATALOGUE["pending_prune_clears"].sql)
def q_stream_pending_prune(spark, sf):
    from sluice.streaming import pipelines as sp
    base = sp.fresh_dir(spark, "stream-prune")
    bounds = fx.emitted(spark, sf).groupBy("partition").agg(F.min("offset").alias("first_offset"),
                                                            (F.max("offset") + 1).alias("next_offset"))
    log = sp.land_in_order(fx.lagging_ack_log(spark, sf), "ack_seq", 3, "acks")
    sp.prune_stream(sp.landed_stream(spark, log), bounds, fx.PRUNE_BEHIND, f"{base}/out", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/out/decisions").select(*acks.PRUNE_COLUMNS)


_LEDGER_SQL = with_fixtures(["emitted", "ack_log"], """
, m AS (SELECT "partition", "partition" || ':' || "offset" AS message_id FROM emitted),
  a AS (SELECT DISTINCT "partition", "partition" || ':' || "offset" AS message_id FROM ack_log)
SELECT "partition", message_id, CASE WHEN m.message_id IS NULL THEN 'unknown' WHEN a.message_id IS NULL THEN 'pending' ELSE 'acked' END AS outcome
FROM m FULL JOIN a USING ("partition", message_id)""")


@query("stream_commits", "A3 A4 P14 T5", with_fixtures(["emitted", "lagging_ack_log"], """
, p AS (SELECT e."partition", coalesce(min(e."offset") FILTER (WHERE a."offset" IS NULL), max(e."offset") + 1) AS saved_offset
        FROM emitted e LEFT JOIN (SELECT DISTINCT "partition", "offset" FROM lagging_ack_log) a USING ("partition", "offset") GROUP BY e."partition")
SELECT "partition", saved_offset, '{"topology":{"id":"A","name":"topology"},"offset":' || saved_offset || ',"partition":' || "partition"
       || ',"broker":{"host":"broker","port":9092},"topic":"readings"}' AS document FROM p"""))
def q_stream_commits(spark, sf):
    """The commit points of a running ledger, written by a listener as saved-offset documents while it runs."""
    from sluice.streaming import listeners, pipelines as sp
    base = sp.fresh_dir(spark, "stream-commits")
    bounds = fx.emitted(spark, sf).groupBy("partition").agg(F.min("offset").alias("first_offset"), (F.max("offset") + 1).alias("next_offset"))
    path = sp.land_in_order(fx.lagging_ack_log(spark, sf), "ack_seq", 3, "acks")
    saved = listeners.SavedOffsets(spark, f"{base}/saved", "A", "topology", "broker", 9092, "readings")
    cadence = listeners.CommitCadence(saved, lambda b: spark.read.parquet(f"{base}/out/low/batch={b}").withColumnRenamed("low", "commit_offset"))
    spark.streams.addListener(cadence)
    try:
        sp.prune_stream(sp.landed_stream(spark, path), bounds, 1 << 40, f"{base}/out", f"{base}/ckpt")
        listeners.heard(spark)
    finally:
        spark.streams.removeListener(cadence)
    if cadence.failure is not None:
        raise cadence.failure
    return saved.read().select("partition", "saved_offset", "document")


@query("stream_replay", "J8 T5", with_fixtures(["replay_fails"], """
SELECT "partition", "offset", step + 1 AS batch, min("offset") OVER (PARTITION BY "partition", step) AS replay_from FROM replay_fails"""))
def q_stream_replay(spark, sf):
    from sluice.streaming import pipelines as sp
    base = sp.fresh_dir(spark, "stream-replay")
    log = fx.replay_log(spark, sf)
    last = log.where("step = 0 and kind = 'message'").limit(1).withColumn("step", F.lit(fx.REPLAY_STEPS - 1))  # something lands after the last failures
    path = sp.land_steps(log.unionByName(last), "step", fx.REPLAY_STEPS, "replay")
    sp.replay_stream(sp.landed_stream(spark, path), fx.emitted(spark, sf), f"{base}/out", f"{base}/ckpt")
    r = spark.read.parquet(f"{base}/out/replayed")
    return r.select("partition", "offset", F.col("batch").cast("int").alias("batch"), "replay_from")


@query("stream_ack_ledger", "T1 T5", _LEDGER_SQL)
def q_stream_ack_ledger(spark, sf):
    """The ledger over two runs of one query: the second starts from the first one's checkpoint, with messages pending
    and acks waiting across the restart.  Messages without an ack have expired or are still in the state."""
    from sluice.streaming import ledger, pipelines as sp
    base = sp.fresh_dir(spark, "stream-ledger")
    log = fx.ledger_log(spark, sf)
    half = log.agg(F.percentile_approx("at_ms", 0.5)).first()[0]
    path = sp.land_in_order(log.where(F.col("at_ms") <= half), "at_ms", 2, "ledger")
    run = lambda: ledger.run_to_end(ledger.ack_ledger(sp.landed_stream(spark, path)), f"{base}/out", f"{base}/ckpt")
    run()
    sp.land_in_order(log.where(F.col("at_ms") > half), "at_ms", 2, "ledger", path)
    run()
    left = spark.read.schema(ledger.LEDGER_OUT).parquet(f"{base}/out").withColumn("outcome", F.when(F.col("outcome") == "expired", "pending").otherwise(F.col("outcome")))
    held = ledger.pending_now(spark, f"{base}/ckpt").withColumn("outcome", F.lit("pending"))
    early = ledger.pending_now(spark, f"{base}/ckpt", "early").withColumn("outcome", F.lit("unknown"))
    columns = ["partition", "message_id", "outcome"]
    return left.select(*columns).unionByName(held.select(*columns)).unionByName(early.select(*columns))


@query("stream_auto_abort_timers", "D6 D7 T5", with_fixtures(["queue_state"], f"""
, o AS (SELECT * FROM queue_state WHERE state = 'open' AND (queue <> '1-URGENT' OR opened_at < TIMESTAMP '1996-01-01 00:00:00')),
  hw AS (SELECT max(epoch_ms(opened_at) + CASE WHEN price > {CONFIRM_PRICE} THEN 3600000 ELSE 0 END) - 1800000 AS mark FROM o)
SELECT queue, seq,
       CASE WHEN auto_abort_ms = 0 OR price > {CONFIRM_PRICE} THEN 'confirmed'
            WHEN epoch_ms(opened_at) + auto_abort_ms < hw.mark THEN 'waiting' ELSE 'open' END AS new_state,
       CASE WHEN auto_abort_ms = 0 THEN 0 WHEN price > {CONFIRM_PRICE} OR epoch_ms(opened_at) + auto_abort_ms < hw.mark THEN seq END AS txn_id
FROM o, hw"""))
def q_stream_auto_abort_timers(spark, sf):
    """Items return to their queue when the watermark passes their deadline; nothing is fetched from 1-URGENT any more
    when most of its items expire."""
    from sluice.streaming import ledger, pipelines as sp
    base = sp.fresh_dir(spark, "stream-abort-timers")
    path = sp.land_in_order(fx.open_log(spark, sf), "at_ms", 3, "open")
    ledger.run_to_end(ledger.auto_abort_timers(sp.landed_stream(spark, path), delay="30 minutes"), f"{base}/out", f"{base}/ckpt")
    left = spark.read.schema(ledger.ABORT_OUT).parquet(f"{base}/out").select("queue", "seq", "new_state", "txn_id")
    held = ledger.open_now(spark, f"{base}/ckpt")
    return left.unionByName(held.select("queue", "seq", F.lit("open").alias("new_state"), F.lit(None).cast("long").alias("txn_id")))


# ---------------------------------------------------------------- landed deliveries (S1-S5) and publish records

# Deliveries as a broker sends them: some bodies are not UTF-8 or hold two
# documents, some messages carry a header of the name the source adds, Kafka
# headers repeat, and some messages are delivered twice.
_LANDED_SQL = """
  landed AS (
    SELECT *, CASE WHEN event_id % 19 = 0 THEN 'undecodable'
                   WHEN event_id % 23 = 0 AND NOT (event_id % 13 = 0 OR event_id % 17 = 0) THEN 'undecodable'
                   WHEN value_text = '' THEN 'empty'
                   WHEN NOT json_valid(value_text) THEN 'undecodable' END AS dead_reason
    FROM (SELECT * FROM messages UNION ALL SELECT * FROM messages WHERE event_id % 29 = 0))
"""
_LANDED_COLUMNS = {
    "kafka": ("message_id", "key_text", "CASE WHEN event_id % 3 = 0 THEN sent_ms - 5 ELSE sent_ms END", "'2'", '"partition"', '"offset"'),
    "amqp": ("origin || ':0:' || CAST(event_id AS VARCHAR)", "key_text", "CASE WHEN event_id % 3 = 0 THEN sent_ms - 5 ELSE sent_ms END",
             "'x'", "0", "event_id"),
    "jms": ("'ID:' || CAST(event_id AS VARCHAR)", "NULL", "sent_ms",
            "CASE WHEN event_id % 3 = 0 THEN '9' ELSE CAST(event_id % 2 + 1 AS VARCHAR) END", "0", "event_id"),
    "mqtt": ("origin || ':0:' || CAST(event_id AS VARCHAR)", "NULL", "sent_ms", "CAST(event_id % 3 AS VARCHAR)", "0", "event_id"),
    "kestrel": ("origin || ':0:' || CAST(event_id AS VARCHAR)", "NULL", "sent_ms", "NULL", "0", "event_id"),
}


def _landed_sql(protocol: str) -> str:
    mid, key, sent, extra, part, off = _LANDED_COLUMNS[protocol]
    return fixtures_prefix(["messages"]) + ",\n" + _LANDED_SQL.strip() + f"""
SELECT {mid} AS message_id, origin, '{protocol}' AS protocol, CAST({key} AS VARCHAR) AS key_text, CAST({sent} AS BIGINT) AS sent_ms,
       CAST({extra} AS VARCHAR) AS extra, CAST({part} AS INTEGER) AS "partition", CAST({off} AS BIGINT) AS "offset",
       CASE WHEN dead_reason IS NULL THEN TRY_CAST(json_extract_string(value_text, '$.k') AS BIGINT) END AS k, dead_reason
FROM landed"""


def landed_records(spark: SparkSession, sf: str, protocol: str) -> DataFrame:
    """``events`` as the delivery records of a broker (``landed.RECORDS``, or the Kafka source's rows)."""
    from sluice.sources import landed
    eid = F.col("event_id")
    m = fx.messages(spark, sf, [F.col("user_id")])
    m = m.unionByName(m.where(eid % 29 == 0))
    body = (F.when(eid % 19 == 0, F.unhex(F.lit("FFFE7B"))).when((eid % 23 == 0) & (eid % 13 != 0) & (eid % 17 != 0), F.concat("value", "value"))
            .otherwise(F.col("value")))
    sent = epoch_ms("ts")
    user = F.col("user_id").cast("string")
    headers = F.when(eid % 3 == 0, F.create_map(F.lit("time"), (sent - 5).cast("string")))
    if protocol == "kafka":
        def one(k: str, v: F.Column) -> F.Column:
            return F.struct(F.lit(k).alias("key"), v.cast("binary").alias("value"))
        many = F.concat(F.array(one("a", F.lit("1")), one("bin", F.unhex(F.lit("FF"))), one("a", F.lit("2"))),
                        F.when(eid % 3 == 0, F.array(one("time", (sent - 5).cast("string"))))
                        .otherwise(F.expr("cast(array() as array<struct<key:string,value:binary>>)")))
        return m.select(F.col("key"), body.alias("value"), F.col("origin").alias("topic"), "partition", "offset",
                        F.col("ts").alias("timestamp"), F.lit(0).alias("timestampType"), many.alias("headers"))
    made = {
        "amqp": [F.col("origin").alias("queue"), F.lit("c").alias("consumer_tag"), eid.alias("delivery_tag"), F.lit("ex").alias("exchange"),
                 user.alias("routing_key"), F.create_map(F.lit("p"), F.lit("x")).alias("properties"), headers.alias("headers"),
                 body.alias("body"), F.col("ts").alias("timestamp")],
        "jms": [F.col("origin").alias("destination"), F.concat(F.lit("ID:"), eid.cast("string")).alias("jms_message_id"), eid.alias("seq"),
                sent.alias("jms_timestamp"), (eid % 2 + 1).cast("int").alias("delivery_mode"),
                F.when(eid % 3 == 0, F.create_map(F.lit("delivery_mode"), F.lit("9"))).alias("properties"), body.alias("body")],
        "mqtt": [F.col("origin").alias("topic"), eid.alias("seq"), (eid % 3).cast("int").alias("qos"), body.alias("body"), F.col("ts").alias("timestamp")],
        "kestrel": [F.col("origin").alias("queue"), eid.alias("id"), body.alias("data"), F.col("ts").alias("put_at")],
    }
    return envelope.declare_fields(m.select(*made[protocol]), landed.RECORDS[protocol])


ADMITTED = "4096"            # messages of a queue in a micro-batch of the sources


def _source_query(protocol: str) -> QueryFn:
    def fn(spark: SparkSession, sf: str) -> DataFrame:
        """Kafka: the projection of its source's rows.  The others: deliveries land in files and are read as a stream, so
        many of each queue at a time as the configuration admits."""
        from sluice.config import PipelineConfig
        from sluice.sources import broker_log, landed
        from sluice.streaming import pipelines as sp
        records = landed_records(spark, sf, protocol)
        if protocol == "kafka":
            env = landed.kafka_to_envelope(records)
        else:
            base = sp.fresh_dir(spark, f"source-{protocol}")
            config = PipelineConfig.from_options(protocol, {"prefetchCount": ADMITTED, "queueSize": ADMITTED})
            broker_log.land(records, f"{base}/log", protocol)
            stream = broker_log.read_stream(spark, f"{base}/log", config, f"{base}/progress.json")
            sp.run_until_idle(stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt"))
            env = spark.read.schema(stream.schema).parquet(f"{base}/out")
        d = decode.decode(env, BODY_SCHEMA)
        extra = {"kafka": F.col("headers")["a"], "amqp": F.col("context")["p"], "jms": F.col("context")["delivery_mode"],
                 "mqtt": F.col("context")["qos"], "kestrel": F.lit(None)}[protocol]
        return d.select("message_id", "origin", "protocol", bytes_text("key").alias("key_text"),
                        F.col("headers")["time"].cast("long").alias("sent_ms"), extra.cast("string").alias("extra"),
                        "partition", "offset", F.col("decoded.k").alias("k"), "dead_reason")
    fn.__name__ = f"q_source_{protocol}"
    return fn


for _protocol, _operators in (("kafka", "S1 P7 P8"), ("amqp", "S2 P7 P8"), ("jms", "S3 P7 P8"), ("mqtt", "S4 P7 P8"), ("kestrel", "S5 P7 P8")):
    query(f"source_{_protocol}", _operators, _landed_sql(_protocol))(_source_query(_protocol))


_SINK_TWO_HOP = """
  twice AS (SELECT * FROM messages UNION ALL SELECT * FROM messages WHERE event_id % 29 = 0),
  good AS (SELECT t.*, d.name, d.grouped, d.site, d.sensor, d.sensor_id
           FROM twice t JOIN destinations d ON d.name = 'd' || CAST(user_id % 30 AS VARCHAR) AND user_id % 30 < 28
           WHERE origin <> 'error' AND json_valid(value_text) AND value_text <> ''
             AND TRY_CAST(json_extract_string(value_text, '$.k') AS BIGINT) IS NOT NULL)
"""


def _sink_sql(select: str) -> str:
    return fixtures_prefix(["messages", "destinations"]) + ",\n" + _SINK_TWO_HOP.strip() + "\n" + select


def _sink(spark: SparkSession, sf: str, protocol: str) -> DataFrame:
    """The messages as a stream, some delivered twice, routed and published in three micro-batches; what the published
    files hold.  MQTT messages carry a quality of service, but for every fourth."""
    from sluice.streaming import pipelines as sp, publish
    base = sp.fresh_dir(spark, f"sink-{protocol}")
    dest = fx.destinations(spark, sf)
    eid = F.col("event_id")
    m = fx.messages_from(sp.table_stream(spark, sf, "events", order="event_id", batches=3))
    m = m.withColumn("_copy", F.explode(F.when(eid % 29 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("_copy")
    m = m.withColumn("context", F.when(eid % 4 != 0, F.create_map(F.lit("qos"), (eid % 3).cast("string"))).otherwise(F.col("context")))
    r = sp.labelled_routes(m, fx.paths(spark), sp.publishable(dest, protocol), one_hop=protocol in sp.ONE_HOP)
    records = sp.sink_records(protocol, r.where(F.col("output") == "good"), dest)
    sp.run_available_now(publish.publish(records, f"{base}/out", "sink").option("checkpointLocation", f"{base}/ckpt"))
    return publish.published(spark, f"{base}/out", records.schema)


@query("sink_mqtt", "S9 J2 T5", _sink_sql("""
SELECT message_id, name AS topic, hex(value_text) AS body, false AS retain, CASE WHEN event_id % 4 <> 0 THEN CAST(event_id % 3 AS INTEGER) END AS qos FROM good"""))
def q_sink_mqtt(spark, sf):
    return _sink(spark, sf, "mqtt").select("message_id", "topic", F.hex("body").alias("body"), "retain", "qos")


@query("sink_jms", "S8 J2 P3 P4 T5", _sink_sql("""
SELECT message_id, 'jq' AS queue, hex(value_text) AS body, sent_ms AS jms_timestamp FROM good"""))
def q_sink_jms(spark, sf):
    return _sink(spark, sf, "jms").select("message_id", "queue", F.hex("body").alias("body"), "jms_timestamp")


@query("sink_kestrel", "S10 J2 T5", _sink_sql("""
SELECT message_id, name AS queue, hex(value_text) AS data, CAST(30000 AS BIGINT) AS expiration_ms, sent_ms + 30000 AS expires_ms FROM good"""))
def q_sink_kestrel(spark, sf):
    return _sink(spark, sf, "kestrel").select("message_id", "queue", F.hex("data").alias("data"), "expiration_ms", epoch_ms("expires_at").alias("expires_ms"))


@query("sink_kafka", "S6 J1 P1 P4 T5", _sink_sql("""
SELECT CASE WHEN grouped THEN site || '.' || sensor || '.readings' ELSE site || '.' || sensor || '.' || sensor_id || '.readings' END AS topic,
       key_text, hex(value_text) AS value, CAST(sent_ms AS VARCHAR) AS time_header FROM good
WHERE NOT (NOT grouped AND sensor_id IS NULL)"""))
def q_sink_kafka(spark, sf):
    r = _sink(spark, sf, "kafka")
    return r.select("topic", bytes_text("key").alias("key_text"), F.hex("value").alias("value"),
                    F.decode(F.element_at("headers", 1)["value"], "UTF-8").alias("time_header"))


def queries() -> dict[str, QueryFn]:
    return {name: q.fn for name, q in CATALOGUE.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in CATALOGUE.items() if q.sql is not None}
