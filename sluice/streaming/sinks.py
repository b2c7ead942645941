"""Broker sinks (S6-S10) and the idempotent batch writer.

Every sink takes routed ENVELOPE rows (``destination`` set by J1/J2) and
produces the protocol's publish records; ``write_batch`` lands several
outputs of one micro-batch (good rows, dead letters, unroutable) under
``<base>/<output>/batch=<id>`` with overwrite, so a retried batch replaces
its own files and never duplicates rows (exactly-once by batch id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.joins import dim_join
from sluice.operators.naming import destination_names

DEFAULT_KESTREL_EXPIRATION_MS = 30_000


def write_batch(outputs: dict[str, DataFrame], base: str, batch_id: int,
                partition_by: dict[str, list[str]] | None = None) -> None:
    """Write each output of a micro-batch to its own folder, overwriting."""
    partition_by = partition_by or {}
    for name, df in outputs.items():
        w = df.write.mode("overwrite")
        if partition_by.get(name):
            w = w.partitionBy(*partition_by[name])
        w.parquet(f"{base.rstrip('/')}/{name}/batch={batch_id}")


def _named(destinations: DataFrame) -> DataFrame:
    n = destination_names(destinations)
    return n.select(F.col("name").alias("_s_name"), "amqp_exchange", "amqp_routing_key", "jms_queue")


def _context(routed: DataFrame) -> F.Column:
    """The message's protocol properties; none for rows cut down to fewer columns."""
    return F.col("context") if "context" in routed.columns else F.lit(None).cast("map<string,string>")


def amqp_records(routed: DataFrame, destinations: DataFrame) -> DataFrame:
    """Publish to (exchange, routing key) of the destination, with the
    message's properties (its context) and headers."""
    j = dim_join(routed, _named(destinations), F.col("destination") == F.col("_s_name"), "inner")
    return j.select("message_id", F.col("amqp_exchange").alias("exchange"),
                    F.col("amqp_routing_key").alias("routing_key"), _context(routed).alias("properties"), "headers",
                    F.col("value").alias("body"))


def jms_records(routed: DataFrame, destinations: DataFrame) -> DataFrame:
    """One hop; the JMS queue is the destination's ``queue`` property."""
    j = dim_join(routed, _named(destinations), F.col("destination") == F.col("_s_name"), "inner")
    return j.select("message_id", F.col("jms_queue").alias("queue"), F.col("value").alias("body"),
                    F.col("headers")["time"].cast("long").alias("jms_timestamp"))


def mqtt_records(routed: DataFrame) -> DataFrame:
    """One hop, published to the destination name with the QoS the message
    came with (null: the producer's own), retain = false."""
    return routed.select("message_id", F.col("destination").alias("topic"), F.col("value").alias("body"),
                         F.lit(False).alias("retain"), _context(routed)["qos"].try_cast("int").alias("qos"))


def kestrel_records(routed: DataFrame, expiration_ms: int = DEFAULT_KESTREL_EXPIRATION_MS) -> DataFrame:
    """One hop; items carry an expiry (``expires_at`` = ts + expiration)."""
    return routed.select("message_id", F.col("destination").alias("queue"), F.col("value").alias("data"),
                         F.lit(expiration_ms).cast("long").alias("expiration_ms"),
                         (F.col("ts") + F.make_dt_interval(secs=F.lit(expiration_ms / 1000.0))).alias("expires_at"))
