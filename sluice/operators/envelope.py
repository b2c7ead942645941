"""The common message envelope.

Every source yields ENVELOPE and every sink accepts it:

    message_id STRING, origin STRING, protocol STRING, stream STRING,
    key BINARY, value BINARY, headers MAP<STRING,STRING>,
    context MAP<STRING,STRING>, partition INT, offset BIGINT, ts TIMESTAMP

``message_id`` is deterministic -- ``origin:partition:offset`` -- so that a
replay produces the same ids (a random id per delivery would not).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The five broker protocols, in this order.
PROTOCOLS = ["kafka", "amqp", "jms", "mqtt", "kestrel"]

DEFAULT_STREAM = "default"

ENVELOPE = T.StructType([
    T.StructField("message_id", T.StringType()),
    T.StructField("origin", T.StringType()),
    T.StructField("protocol", T.StringType()),
    T.StructField("stream", T.StringType()),
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("context", T.MapType(T.StringType(), T.StringType())),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("ts", T.TimestampType()),
])

ENVELOPE_COLUMNS = [f.name for f in ENVELOPE.fields]


def _empty_map() -> Column:
    return F.create_map().cast("map<string,string>")


def message_id(origin: Column, partition: Column, offset: Column) -> Column:
    return F.concat_ws(":", origin, partition.cast("string"), offset.cast("string"))


def make_envelope(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Project ``df`` to ENVELOPE, filling absent optional fields.

    Missing ``message_id`` is derived from (origin, partition, offset);
    missing maps become empty maps; ``keep`` columns are carried after the
    envelope columns (e.g. a lineage id).
    """
    cols = set(df.columns)

    def pick(name: str, default: Column) -> Column:
        src = F.col(name) if name in cols else default
        return src.cast(ENVELOPE[name].dataType).alias(name)

    origin = F.col("origin") if "origin" in cols else F.lit(None).cast("string")
    part = F.col("partition") if "partition" in cols else F.lit(None).cast("int")
    off = F.col("offset") if "offset" in cols else F.lit(None).cast("long")
    out = [
        pick("message_id", message_id(origin, part, off)),
        pick("origin", F.lit(None)),
        pick("protocol", F.lit(None)),
        pick("stream", F.lit(None)),
        pick("key", F.lit(None)),
        pick("value", F.lit(None)),
        pick("headers", _empty_map()),
        pick("context", _empty_map()),
        pick("partition", F.lit(None)),
        pick("offset", F.lit(None)),
        pick("ts", F.lit(None)),
    ]
    return df.select(*out, *[F.col(c) for c in (keep or [])])


def declare_fields(df: DataFrame, schema: T.StructType) -> DataFrame:
    """P5: select and cast to the declared output fields (missing -> null)."""
    cols = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def with_default_stream(df: DataFrame, default: str = DEFAULT_STREAM) -> DataFrame:
    """A message without a named stream goes to the default stream."""
    return df.withColumn("stream", F.coalesce(F.col("stream"), F.lit(default)))


def ack_required(protocol: Column, ack_mode: Column, jms_ack_mode: Column,
                 delivery_mode: Column, qos: Column, kestrel_ack_mode: Column) -> Column:
    """Does this source keep the message pending until acknowledged?

    kafka/amqp: ack mode 'manual'; jms: session ack mode other than
    AUTO_ACKNOWLEDGE (1) or a delivery mode other than 1; mqtt: QoS above
    AT_MOST_ONCE; kestrel: ack mode other than 0 (NO_ACK).
    """
    return (F.when(protocol.isin("kafka", "amqp"), ack_mode == "manual")
            .when(protocol == "jms", (jms_ack_mode != 1) | (delivery_mode != 1))
            .when(protocol == "mqtt", qos != "AT_MOST_ONCE")
            .when(protocol == "kestrel", kestrel_ack_mode != 0)
            .otherwise(F.lit(False)))
