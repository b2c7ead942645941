"""Scalar functions: error-code names, broker host parsing, saved-offset
documents and latency (P10, P11, P13, P14).  All are Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.columns import col, epoch_ms

# Kafka fetch error codes by ordinal 0..12; any other code is UNKNOWN.
KAFKA_ERRORS = [
    "NO_ERROR", "OFFSET_OUT_OF_RANGE", "INVALID_MESSAGE", "UNKNOWN_TOPIC_OR_PARTITION",
    "INVALID_FETCH_SIZE", "LEADER_NOT_AVAILABLE", "NOT_LEADER_FOR_PARTITION",
    "REQUEST_TIMED_OUT", "BROKER_NOT_AVAILABLE", "REPLICA_NOT_AVAILABLE",
    "MESSAGE_SIZE_TOO_LARGE", "STALE_CONTROLLER_EPOCH", "OFFSET_METADATA_TOO_LARGE",
]
UNKNOWN_ERROR = "UNKNOWN"
# Fixed value: the broker port when a host spec has none.
DEFAULT_KAFKA_PORT = 9092


def error_name(code: str | Column) -> Column:
    """Name of a Kafka error code; outside 0..12 -> UNKNOWN."""
    c = col(code).cast("int")
    names = F.array(*[F.lit(n) for n in KAFKA_ERRORS])
    return F.when((c >= 0) & (c < len(KAFKA_ERRORS)), F.element_at(names, c + 1)).otherwise(F.lit(UNKNOWN_ERROR))


def parse_host(spec: str | Column, default_port: int = DEFAULT_KAFKA_PORT) -> Column:
    """``host[:port]`` -> struct(host, port, error).

    One part: default port.  Two parts: the port must be an integer.  More
    than two parts (or a bad port): host and port null, error set."""
    # Trailing empty parts are dropped ("host:" is one part), as a Java split does.
    parts = F.split(F.regexp_replace(col(spec), ":+$", ""), ":")
    n = F.size(parts)
    port_txt = F.element_at(parts, 2)
    port = F.when(n == 1, F.lit(default_port)).when(n == 2, port_txt.try_cast("int"))
    err = (F.when(n > 2, F.lit("invalid host specification"))
           .when((n == 2) & port.isNull(), F.lit("invalid port")))
    ok = err.isNull()
    return F.struct(
        F.when(ok, F.element_at(parts, 1)).alias("host"),
        F.when(ok, port).alias("port"),
        err.alias("error"))


SAVED_OFFSET_SCHEMA = T.StructType([
    T.StructField("topology", T.StructType([
        T.StructField("id", T.StringType()), T.StructField("name", T.StringType())])),
    T.StructField("offset", T.LongType()),
    T.StructField("partition", T.LongType()),
    T.StructField("broker", T.StructType([
        T.StructField("host", T.StringType()), T.StructField("port", T.IntegerType())])),
    T.StructField("topic", T.StringType()),
])


def saved_offset_json(topology_id: Column, topology_name: Column, offset: Column, partition: Column,
                      host: Column, port: Column, topic: Column) -> Column:
    """P14 write: the saved-offset document as JSON text."""
    return F.to_json(F.struct(
        F.struct(topology_id.alias("id"), topology_name.alias("name")).alias("topology"),
        offset.cast("long").alias("offset"),
        partition.cast("long").alias("partition"),
        F.struct(host.alias("host"), port.cast("int").alias("port")).alias("broker"),
        topic.alias("topic")))


def read_saved_offset(doc: str | Column) -> Column:
    """P14 read: parse a saved-offset document (null if unparseable)."""
    return F.from_json(col(doc), SAVED_OFFSET_SCHEMA)


def latency_ms(observed: str | Column, sent_ms: str | Column) -> Column:
    """P10: observed time minus sent time, in milliseconds.  ``observed`` is a
    column (never the wall clock) so that a replay gives the same answer."""
    return epoch_ms(observed) - col(sent_ms).cast("long")
