"""Naming (P1-P4), routing (J1-J3, J5, J7), registry (J6), status gate."""

import pytest
from pyspark.sql import functions as F

from sluice.operators import naming, registry, routing

DEST = "name string, site string, sensor string, sensor_id string, grouped boolean, properties map<string,string>"


def test_names_and_rejects(spark):
    d = spark.createDataFrame([
        ("a", "s", "n", None, True, {"topic": "t", "queueName": "q", "routingKey": "rk", "exchange": "ex"}),
        ("b", "s", "n", None, False, {"topic": "t", "queueName": "q", "routingKey": "rk"}),
        ("c", "s", "n", "7", False, {"topic": "t", "routingKey": "rk", "queue": "jq"}),
    ], DEST)
    got = {r.name: r for r in naming.destination_names(d).collect()}
    assert got["a"].kafka_topic == "s.n.t" and got["a"].amqp_queue == "s.n.q" and got["a"].reject_amqp is None
    assert got["b"].kafka_topic is None and got["b"].reject_kafka == "null sensor_id"
    assert got["c"].kafka_topic == "s.n.7.t" and got["c"].amqp_routing_key == "s.n.7.rk"
    assert got["c"].reject_amqp == "missing property queueName" and got["c"].jms_queue == "jq"
    assert got["a"].reject_jms == "missing property queue"
    assert sorted(r.name for r in naming.rejected(naming.destination_names(d), "amqp").collect()) == ["b", "c"]
    with pytest.raises(Exception):
        naming.strict(naming.destination_names(d), "amqp").collect()


def test_two_hop_reasons(spark):
    msgs = spark.createDataFrame([("m1", None), ("m2", "p9"), ("m3", "p1"), ("m4", "p2")], "id string, sel string")
    paths = spark.createDataFrame([("p1", "d1"), ("p2", "d2")], "path string, destination string")
    dests = spark.createDataFrame([("d1",)], "name string")
    r = {x.id: x.route_reason for x in routing.route_two_hop(msgs, F.col("sel"), paths, dests).collect()}
    assert r == {"m1": "no selection", "m2": "path unknown", "m3": None, "m4": "producer unknown"}
    empty = spark.createDataFrame([], "path string, destination string")
    r2 = {x.id: x.route_reason for x in
          routing.route_two_hop(msgs, F.col("sel"), empty, spark.createDataFrame([], "name string")).collect()}
    assert r2["m3"] == "path unknown"


def test_one_hop_and_exchange(spark):
    msgs = spark.createDataFrame([("m1", "d1"), ("m2", "dx"), ("m3", None)], "id string, sel string")
    dests = spark.createDataFrame([("d1",)], "name string")
    r = {x.id: x.route_reason for x in routing.route_one_hop(msgs, F.col("sel"), dests).collect()}
    assert r == {"m1": None, "m2": "producer unknown", "m3": "no selection"}
    pub = spark.createDataFrame([("m1", "ex", "k1"), ("m2", "ex", "k2")], "id string, exchange string, routing_key string")
    b = spark.createDataFrame([("ex", "k1", "q1"), ("ex", "k1", "q2"), ("ey", "k2", "q3")],
                              "exchange string, binding_key string, queue string")
    got = sorted((x.id, x.bound_queue) for x in routing.direct_exchange(pub, b).collect())
    assert got == [("m1", "q1"), ("m1", "q2"), ("m2", None)]


CH = "seq long, op string, name string, path string"


def test_registry_current_and_as_of(spark):
    ch = spark.createDataFrame([
        (1, "add_destination", "d1", None), (2, "add_path", "d1", "p1"),
        (5, "remove_destination", "d1", None), (7, "add_destination", "d1", None),
        (8, "remove_path", "zz", "p1"), (9, "add_path", "d1", "p1"),
    ], CH)
    assert [r.name for r in registry.current_destinations(ch).collect()] == ["d1"]
    assert [(r.path, r.destination) for r in registry.current_paths(ch).collect()] == [("p1", "d1")]
    msgs = spark.createDataFrame([(s, f"m{s}", "p1") for s in (0, 2, 3, 5, 6, 7, 8, 10)] + [(4, "mnull", None)],
                                 "seq long, id string, sel string")
    r = {x.id: x.route_reason for x in routing.route_as_of(msgs, F.col("sel"), "seq", ch, block_size=2).collect()}
    assert r == {"m0": "path unknown", "m2": None, "m3": None, "m5": "producer unknown",
                 "m6": "producer unknown", "m7": None, "m8": "path unknown", "m10": None,
                 "mnull": "no selection"}


def test_status_gate(spark):
    ops = spark.createDataFrame([("q1", "read"), ("q1", "write"), ("q2", "write"), ("q3", "read"), ("q4", "write")],
                                "queue string, op string")
    st = spark.createDataFrame([("q1", "READ_ONLY"), ("q2", "QUIESCENT"), ("q3", "UP")], "queue string, status string")
    got = {(r.queue, r.op): r.allowed for r in routing.status_gate(ops, st).collect()}
    assert got == {("q1", "read"): True, ("q1", "write"): False, ("q2", "write"): False,
                   ("q3", "read"): True, ("q4", "write"): True}


def test_parse_host(spark):
    from sluice.functions.scalars import parse_host
    df = spark.createDataFrame([("h",), ("h:9093",), ("h:",), ("h:x",), ("a:1:2",), (":7",)], "s string")
    got = [tuple(r.p) for r in df.select(parse_host("s").alias("p")).collect()]
    assert got == [("h", 9092, None), ("h", 9093, None), ("h", 9092, None), (None, None, "invalid port"),
                   (None, None, "invalid host specification"), ("", 7, None)]


def test_duplicate_path_rows_do_not_multiply_messages(spark):
    msgs = spark.createDataFrame([("m1", "p1"), ("m2", "p2")], "id string, sel string")
    paths = spark.createDataFrame([("p1", "d1"), ("p1", "d1"), ("p2", "d2")], "path string, destination string")
    dests = spark.createDataFrame([("d1",), ("d1",), ("d2",)], "name string")
    r = routing.route_two_hop(msgs, F.col("sel"), paths, dests)
    assert r.count() == 2 and routing.routed(r).count() == 2
