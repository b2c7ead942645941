"""Conservation properties on the whole small fixtures."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from sluice.operators import decode, queues, routing
from sluice.plans.catalogue import BODY_SCHEMA
from sluice.sources import fixtures as fx
from tests.conftest import SF_SMALL


def test_good_plus_dead_is_input(spark):
    m = fx.messages(spark, SF_SMALL)
    d = decode.decode(m, BODY_SCHEMA)
    assert decode.good(d).count() + decode.dead_letters(d).count() == m.count()


def test_routed_plus_unroutable_is_input(spark):
    r = entry.queries()["route_two_hop"](spark, SF_SMALL)
    n = fx.messages(spark, SF_SMALL).count()
    assert routing.routed(r).count() + routing.unroutable(r).count() == n
    assert r.select("message_id").distinct().count() == n


def test_queue_states_partition_the_put(spark):
    obs = fx.observed_at()
    st = fx.queue_state(spark, SF_SMALL)
    waiting = queues.expire(st, obs).count()
    gone = queues.expired(st, obs).count()
    other = st.where(F.col("state") != "waiting").count()
    assert waiting + gone + other == st.count()


def test_put_accepted_never_exceeds_free(spark):
    acc = entry.queries()["put_capacity"](spark, SF_SMALL).where("accepted").groupBy("queue").count()
    lim = fx.queue_limits(spark, SF_SMALL)
    w = queues.expire(fx.queue_state(spark, SF_SMALL), fx.observed_at()).groupBy("queue").count() \
        .withColumnRenamed("count", "waiting")
    j = acc.join(lim, "queue").join(w, "queue", "left").fillna(0, ["waiting"])
    assert j.where(F.col("count") > F.greatest(F.col("capacity") - F.col("waiting"), F.lit(0))).count() == 0
