"""Broker sources over landed logs (S2-S5) and Kafka (S1), all into ENVELOPE.

Push brokers (AMQP, JMS, MQTT, Kestrel) are not replayable, so their
deliveries are landed as files (one record per delivery) by the broker side
and read here with Spark's own file source -- batch ``spark.read`` or
``spark.readStream`` with a checkpoint, which gives replay and exactly-once
progress (T5).  Each protocol's record schema maps to ENVELOPE by a plain
projection; ids are deterministic so a replay yields the same ids.

Kafka uses Spark's Kafka connector (``format("kafka")``, the
``spark-sql-kafka`` package on the cluster); ``kafka_to_envelope`` projects
its fixed source schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.columns import epoch_ms
from sluice.operators.envelope import make_envelope

_MAP = T.MapType(T.StringType(), T.StringType())

# Landed record schemas, one per protocol.
AMQP_RECORD = T.StructType([
    T.StructField("queue", T.StringType()), T.StructField("consumer_tag", T.StringType()),
    T.StructField("delivery_tag", T.LongType()), T.StructField("exchange", T.StringType()),
    T.StructField("routing_key", T.StringType()), T.StructField("properties", _MAP),
    T.StructField("headers", _MAP), T.StructField("body", T.BinaryType()),
    T.StructField("timestamp", T.TimestampType())])
JMS_RECORD = T.StructType([
    T.StructField("destination", T.StringType()), T.StructField("jms_message_id", T.StringType()),
    T.StructField("seq", T.LongType()), T.StructField("jms_timestamp", T.LongType()),
    T.StructField("delivery_mode", T.IntegerType()), T.StructField("properties", _MAP),
    T.StructField("body", T.BinaryType())])
MQTT_RECORD = T.StructType([
    T.StructField("topic", T.StringType()), T.StructField("seq", T.LongType()),
    T.StructField("qos", T.IntegerType()), T.StructField("body", T.BinaryType()),
    T.StructField("timestamp", T.TimestampType())])
KESTREL_RECORD = T.StructType([
    T.StructField("queue", T.StringType()), T.StructField("id", T.LongType()),
    T.StructField("data", T.BinaryType()), T.StructField("put_at", T.TimestampType())])

RECORDS = {"amqp": AMQP_RECORD, "jms": JMS_RECORD, "mqtt": MQTT_RECORD, "kestrel": KESTREL_RECORD}


def _with_entry(m: F.Column, key: str, value: F.Column) -> F.Column:
    """``m`` with ``key`` added; an entry the sender set stays."""
    m = F.coalesce(m, F.create_map().cast("map<string,string>"))
    return F.when(F.map_contains_key(m, key), m).otherwise(
        F.map_concat(m, F.create_map(F.lit(key), value.cast("string"))))


def _time_header(ts_ms: F.Column) -> F.Column:
    return F.create_map(F.lit("time"), ts_ms.cast("string"))


def _last_values(headers: F.Column) -> F.Column:
    """Kafka headers as a map: of a repeated key the last value counts, a value
    that is not UTF-8 is null, a null key is left out."""
    keys = F.transform(headers, lambda h: h["key"])
    again = lambda h, i: F.coalesce(F.array_contains(F.slice(keys, i + 2, F.size(keys)), h["key"]), F.lit(False))
    kept = F.filter(headers, lambda h, i: h["key"].isNotNull() & ~again(h, i))
    return F.map_from_entries(F.transform(kept, lambda h: F.struct(
        h["key"], F.try_validate_utf8(h["value"].cast("string")))))


def amqp_to_envelope(df: DataFrame) -> DataFrame:
    """id = (queue, delivery tag) -- the tag alone repeats across channels.
    A ``time`` header the sender set (its send time) is kept."""
    return make_envelope(df.select(
        F.col("queue").alias("origin"), F.lit("amqp").alias("protocol"),
        F.col("routing_key").cast("binary").alias("key"), F.col("body").alias("value"),
        _with_entry(F.col("headers"), "time", epoch_ms("timestamp")).alias("headers"),
        F.coalesce(F.col("properties"), F.create_map().cast("map<string,string>")).alias("context"),
        F.lit(0).alias("partition"), F.col("delivery_tag").alias("offset"), F.col("timestamp").alias("ts")))


def jms_to_envelope(df: DataFrame) -> DataFrame:
    """S3: id = JMSMessageID; the JMS timestamp becomes the time header."""
    return make_envelope(df.select(
        F.col("jms_message_id").alias("message_id"), F.col("destination").alias("origin"),
        F.lit("jms").alias("protocol"), F.col("body").alias("value"),
        _time_header(F.col("jms_timestamp")).alias("headers"),
        _with_entry(F.col("properties"), "delivery_mode", F.col("delivery_mode")).alias("context"),
        F.lit(0).alias("partition"), F.col("seq").alias("offset"),
        F.timestamp_millis("jms_timestamp").alias("ts")))


def mqtt_to_envelope(df: DataFrame) -> DataFrame:
    """id = topic:0:seq (a random id per delivery would break replay)."""
    return make_envelope(df.select(
        F.col("topic").alias("origin"), F.lit("mqtt").alias("protocol"), F.col("body").alias("value"),
        _time_header(epoch_ms("timestamp")).alias("headers"),
        F.create_map(F.lit("qos"), F.col("qos").cast("string")).alias("context"),
        F.lit(0).alias("partition"), F.col("seq").alias("offset"), F.col("timestamp").alias("ts")))


def kestrel_to_envelope(df: DataFrame) -> DataFrame:
    """id = queue:0:item id."""
    return make_envelope(df.select(
        F.col("queue").alias("origin"), F.lit("kestrel").alias("protocol"), F.col("data").alias("value"),
        _time_header(epoch_ms("put_at")).alias("headers"),
        F.lit(0).alias("partition"), F.col("id").alias("offset"), F.col("put_at").alias("ts")))


TO_ENVELOPE = {"amqp": amqp_to_envelope, "jms": jms_to_envelope, "mqtt": mqtt_to_envelope,
               "kestrel": kestrel_to_envelope}


def read_landed(spark: SparkSession, path: str, protocol: str, streaming: bool = False,
                fmt: str = "parquet", options: dict[str, str] | None = None) -> DataFrame:
    """Read a landed delivery log of ``protocol`` as ENVELOPE (batch or stream).
    ``options`` pass through (e.g. ``maxFilesPerTrigger`` for admission, S12)."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.format(fmt).schema(RECORDS[protocol])
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return TO_ENVELOPE[protocol](reader.load(path))


# ----------------------------------------------------------------- Kafka

KAFKA_SOURCE = T.StructType([
    T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()), T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
    T.StructField("headers", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])))])

# The reference consumer's defaults (1 MiB fetch, 10 s max wait).
KAFKA_FETCH_BYTES = 1 << 20
KAFKA_FETCH_MAX_WAIT_MS = 10_000


def kafka_options(bootstrap: str, topic: str, starting_offsets: str | None = None,
                  max_offsets_per_trigger: int | None = None, fail_on_data_loss: bool = True) -> dict[str, str]:
    """S1 reader options.  ``starting_offsets``: JSON from
    ``offsets.starting_offsets_option`` (D1); out-of-range handling (D3) is
    ``failOnDataLoss``; bounded admission (S12) is ``maxOffsetsPerTrigger``."""
    opts = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "includeHeaders": "true",
        "kafka.fetch.max.bytes": str(KAFKA_FETCH_BYTES),
        "kafka.fetch.max.wait.ms": str(KAFKA_FETCH_MAX_WAIT_MS),
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if starting_offsets:
        opts["startingOffsets"] = starting_offsets
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def kafka_to_envelope(df: DataFrame) -> DataFrame:
    """The Kafka source schema as ENVELOPE (the key is kept)."""
    hdrs = _last_values(F.coalesce(F.col("headers"), F.array().cast(KAFKA_SOURCE["headers"].dataType)))
    return make_envelope(df.select(
        F.col("topic").alias("origin"), F.lit("kafka").alias("protocol"), "key", "value",
        _with_entry(hdrs, "time", epoch_ms("timestamp")).alias("headers"),
        "partition", "offset", F.col("timestamp").alias("ts")))


def read_kafka(spark: SparkSession, options: dict[str, str], streaming: bool = True) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return kafka_to_envelope(reader.format("kafka").options(**options).load())


def to_kafka_records(df: DataFrame, topic_col: str = "kafka_topic") -> DataFrame:
    """Routed ENVELOPE rows as Kafka sink records (topic, key, value,
    headers).  A null key is allowed (the reference threw on it)."""
    hdrs = F.transform(F.map_entries(F.coalesce(F.col("headers"), F.create_map().cast("map<string,string>"))),
                       lambda e: F.struct(e["key"].alias("key"), F.encode(e["value"], "UTF-8").alias("value")))
    return df.select(F.col(topic_col).alias("topic"), "key", "value", hdrs.alias("headers"))
