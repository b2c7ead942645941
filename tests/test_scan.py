"""The blocked prefix scan equals a plain per-key running window."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from sluice.operators.scan import prefix_scan, running_count


def _rows(n, keys, seed):
    rnd = random.Random(seed)
    seqs = rnd.sample(range(n * 3), n)
    return [(rnd.choice(keys), s, rnd.randint(-5, 20)) for s in seqs]


def test_prefix_scan_matches_window(spark):
    rows = _rows(600, ["a", "b", None, "hot", "hot", "hot"], 1)
    df = spark.createDataFrame(rows, "k string, seq long, v long")
    w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    want = {(r.k, r.seq): (r.s, r.m) for r in
            df.select("k", "seq", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("m")).collect()}
    for block in (1, 7, 64, 10_000):
        got = prefix_scan(df, ["k"], "seq", {"s": ("sum", F.col("v")), "m": ("max", F.col("v"))}, block)
        res = {(r.k, r.seq): (r.s, r.m) for r in got.collect()}
        assert res == want, block


def test_running_count_is_row_number(spark):
    rows = _rows(300, ["x", "y"], 2)
    df = spark.createDataFrame(rows, "k string, seq long, v long")
    got = running_count(df, ["k"], "seq", "rank", block_size=5)
    w = Window.partitionBy("k").orderBy("seq")
    want = df.withColumn("rank", F.row_number().over(w))
    assert sorted(map(tuple, got.select("k", "seq", "rank").collect())) == \
        sorted(map(tuple, want.select("k", "seq", "rank").collect()))


def test_scan_keeps_block_and_reuses_it(spark):
    df = spark.createDataFrame(_rows(200, ["a", "b"], 3), "k string, seq long, v long")
    p1 = prefix_scan(df, ["k"], "seq", {"s": ("sum", F.col("v"))}, 16, keep_block=True)
    assert "_scan_blk" in p1.columns
    p2 = prefix_scan(p1, ["k"], "seq", {"m": ("max", F.col("s"))}, 16)
    assert "_scan_blk" not in p2.columns
    for r in p2.collect():
        assert r.m >= r.s or r.s < 0


def test_blocks_by_position_take_any_order(spark):
    """A microsecond time with ties as the order, a key with a third of all rows, null keys."""
    n = 5000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
        (F.timestamp_seconds((F.col("id") * 7919 % 100) * 3601 + 0.000001)).alias("at"), "id", (F.col("id") % 11).alias("v"))
    got = prefix_scan(df, ["k"], ["at", "id"], {"s": ("sum", F.col("v"))}, by_position=True)
    w = Window.partitionBy("k").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.withColumn("s", F.sum("v").over(w))
    assert sorted(map(str, got.select("id", "s").collect())) == sorted(map(str, want.select("id", "s").collect()))
    placed = running_count(df, ["k"], ["at", "id"], by_position=True)
    assert placed.where("k = 'hot'").agg(F.max("rank")).first()[0] == df.where("k = 'hot'").count()
