"""Destination naming.

A destination configuration carries site, sensor, sensor_id, a ``grouped``
flag and a property map.  Broker names are built from it:

* P1 name: not grouped -> ``site.sensor.sensor_id.base``; grouped ->
  ``site.sensor.base``.  ``base`` is property ``topic`` (Kafka) or
  ``queueName`` (AMQP).
* P2 routing key: the same rule over property ``routingKey``; the exchange
  is property ``exchange``.
* P3 JMS: property ``queue``, unprefixed.
* P4 required properties: ``queueName`` for AMQP and ``queue`` for JMS.

Decision: where a required part is null the row is rejected with a reason
(``reject_*`` columns) and the name is null -- a literal ``"null"`` segment is
never produced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def prop(name: str, properties: str = "properties") -> Column:
    return F.col(properties).getItem(name)


def dotted_name(base: Column) -> Column:
    """The dotted name for ``base``, or null when a required part is null."""
    grouped_name = F.concat_ws(".", F.col("site"), F.col("sensor"), base)
    full_name = F.concat_ws(".", F.col("site"), F.col("sensor"), F.col("sensor_id"), base)
    common_ok = F.col("site").isNotNull() & F.col("sensor").isNotNull() & base.isNotNull()
    return (F.when(F.col("grouped") & common_ok, grouped_name)
            .when(~F.col("grouped") & common_ok & F.col("sensor_id").isNotNull(), full_name))


def dotted_reject(base: Column, base_name: str) -> Column:
    """Why ``dotted_name`` is null, in a fixed order of checks."""
    return (F.when(base.isNull(), F.lit(f"missing property {base_name}"))
            .when(F.col("site").isNull(), F.lit("null site"))
            .when(F.col("sensor").isNull(), F.lit("null sensor"))
            .when(~F.col("grouped") & F.col("sensor_id").isNull(), F.lit("null sensor_id")))


def destination_names(dest: DataFrame, properties: str = "properties") -> DataFrame:
    """Add the broker names of each destination and the reasons a protocol
    rejects it.  Columns added: kafka_topic, amqp_queue, amqp_routing_key,
    amqp_exchange, jms_queue, reject_kafka, reject_amqp, reject_jms."""
    topic = prop("topic", properties)
    queue_name = prop("queueName", properties)
    routing = prop("routingKey", properties)
    jms_queue = prop("queue", properties)
    return dest.select(
        "*",
        dotted_name(topic).alias("kafka_topic"),
        dotted_name(queue_name).alias("amqp_queue"),
        dotted_name(routing).alias("amqp_routing_key"),
        prop("exchange", properties).alias("amqp_exchange"),
        jms_queue.alias("jms_queue"),
        dotted_reject(topic, "topic").alias("reject_kafka"),
        F.coalesce(dotted_reject(queue_name, "queueName"),
                   dotted_reject(routing, "routingKey")).alias("reject_amqp"),
        F.when(jms_queue.isNull(), F.lit("missing property queue")).alias("reject_jms"),
    )


def rejected(named: DataFrame, protocol: str) -> DataFrame:
    """The destinations a protocol refuses (the reject frame)."""
    return named.where(F.col(f"reject_{protocol}").isNotNull())


def strict(named: DataFrame, protocol: str) -> DataFrame:
    """P4 strict mode: fail the job on the first refused destination."""
    reason = F.col(f"reject_{protocol}")
    failure = F.raise_error(F.concat(F.lit("destination "), F.col("name"), F.lit(": "), reason))
    # A filter keeps the check in the plan (a dropped column would be pruned).
    return named.where(F.coalesce(F.when(reason.isNotNull(), failure).cast("boolean"), F.lit(True)))
