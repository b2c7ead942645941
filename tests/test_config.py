"""U6 configuration and P5 declared fields."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.config import PipelineConfig
from sluice.operators.envelope import declare_fields


def test_options_parse_both_prefetch_spellings():
    a = PipelineConfig.from_options("amqp", {"prefectCount": "64", "reQueue": "true", "ackMode": "manual"})
    b = PipelineConfig.from_options("amqp", {"prefetchCount": "32"})
    assert (a.prefetch, a.requeue_on_fail, a.ack_mode) == (64, True, "manual")
    assert b.prefetch == 32 and b.requeue_on_fail is False
    j = PipelineConfig.from_options("jms", {"ackMode": "2", "isQueue": "false"})
    assert j.jms_ack_mode == 2 and j.is_queue is False
    with pytest.raises(ValueError):
        PipelineConfig.from_options("mqtt", {"qos": "SOMETIMES"})
    k = PipelineConfig.from_options("kafka", {"queueSize": "500", "custom": "x"})
    assert k.admission() == {"maxOffsetsPerTrigger": "500"} and k.extra == {"custom": "x"}
    assert PipelineConfig.from_options("amqp", {"prefectCount": "7", "queueSize": "9"}).admission() == {"prefetch": "7"}
    assert [PipelineConfig.from_options(p, {}).admission() for p in ("amqp", "jms", "mqtt", "kestrel")] == [{"prefetch": "1024"}] * 4


def test_ack_required_from_config(spark):
    df = spark.range(1)
    cases = [
        ("amqp", {"ackMode": "manual"}, True), ("amqp", {}, False),
        ("jms", {"ackMode": "1"}, False), ("mqtt", {"qos": "AT_LEAST_ONCE"}, True),
        ("kestrel", {"ackMode": "1"}, True), ("kafka", {}, False),
    ]
    for proto, opts, want in cases:
        got = df.select(PipelineConfig.from_options(proto, opts).ack_required().alias("a")).first().a
        assert got is want, (proto, opts)
    jms = PipelineConfig.from_options("jms", {"ackMode": "1"})
    assert df.select(jms.ack_required(F.lit(2)).alias("a")).first().a is True   # persistent delivery


def test_declare_fields(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    schema = T.StructType([T.StructField("b", T.StringType()), T.StructField("a", T.LongType()),
                           T.StructField("c", T.DoubleType())])
    out = declare_fields(df, schema)
    assert out.schema == schema and tuple(out.first()) == ("x", 1, None)
