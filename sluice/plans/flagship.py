"""The flagship pipeline: broker messages -> decode split -> two-hop route ->
per-destination counts of routed good messages.

One scan of ``events``; the decode is a JVM-side ``from_json``; both routing
hops are size-checked broadcast joins against the registry dimensions, so the
only shuffle is the final (partially pre-aggregated) group by destination.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.columns import bytes_text
from sluice.operators import decode, naming, routing
from sluice.operators.joins import dim_join
from sluice.sources import fixtures as fx

BODY = T.StructType([T.StructField("k", T.LongType())])


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = fx.messages(spark, sf_dir)
    good = decode.good(decode.decode(msgs, BODY))
    dests = fx.destinations(spark, sf_dir)
    sel = fx.selector_path(bytes_text("key"), F.col("origin"))
    routed = routing.routed(routing.route_two_hop(good, sel, fx.paths(spark), dests))
    topics = naming.destination_names(dests).select(F.col("name").alias("_t_name"), "kafka_topic")
    per = routed.groupBy("destination").agg(F.count(F.lit(1)).alias("messages"),
                                            F.sum("k").alias("sum_k"),
                                            F.max("offset").alias("max_offset"))
    return (dim_join(per, topics, F.col("destination") == F.col("_t_name"), "left")
            .drop("_t_name").orderBy("destination"))
