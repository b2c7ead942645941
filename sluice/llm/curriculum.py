"""Mixing sources to target weights along a time-varying curriculum (operator 3).

Target of a source: its weight's share of all sizes, at most ``most`` times its own size; what is
above goes to the other sources by weight, again and again until none is above.

Schedule: each weight class has a piecewise linear weight over training time t in [0, 1].  Its
integral, scaled to the source's target, is the source's cumulative demand D(t).  A source's documents
are laid end to end in a seeded order, epoch after epoch; the token at place x of that line is read at
time D^-1(x).  A copy of a document is taken if its middle lies below the target, at the time at which
its middle is reached, so a source's taken size misses its target by at most half a document.
Documents are then range-sorted by time.

The place of a document in its source is a prefix sum, made in blocks (seeded hash ranges) so that a
source holding most rows is spread over tasks; only block sums, at most 256 for each source, meet in a window.  Targets are found by aggregates over the table of sources, which stays distributed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import n_words, written

#: Weights over time, by weight class: (time, weight) knots from time 0 to time 1.  Light classes lead
#: early, heavy classes late.
SCHEDULES = {
    1: ((0.0, 1.5), (1.0, 0.5)),
    2: ((0.0, 0.75), (0.5, 1.25), (1.0, 0.75)),
    3: ((0.0, 0.5), (1.0, 1.5)),
}


def inverse_demand(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """The time at which the integral of the weight reaches this share of its total."""
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False)]
    if any(a <= 0 for a in areas):
        raise ValueError("a schedule needs rising times and positive weights")
    total, before, out = sum(areas), 0.0, None
    for ((t0, w0), (t1, w1)), area in zip(zip(knots, knots[1:], strict=False), areas, strict=True):
        need, slope = share * total - before, (w1 - w0) / (t1 - t0)  # w0 x + slope x^2 / 2 = need
        t = F.lit(t0) + (2 * need) / (w0 + F.sqrt(F.greatest(F.lit(0.0), w0 * w0 + 2 * slope * need)))
        before += area
        out = F.when(share * total <= before, t) if out is None else out.when(share * total <= before, t)
    return F.least(F.greatest(out.otherwise(F.lit(1.0)), F.lit(0.0)), F.lit(1.0))


def _times(knots) -> Column:
    return F.transform("middles", lambda x: inverse_demand(x / F.col("target"), knots))


def targets(sizes: DataFrame, source: str, size: str, most: float = 3.0, weights: int = 3) -> DataFrame:
    """(source, source_size, weight, target) from rows with a size.  Sources by code point, null last,
    weigh 1 .. ``weights``, repeating."""
    per = sizes.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    # places in the sorted list: range-sorted parts, numbered within the part plus the rows of earlier parts
    parts = written(per.repartitionByRange(F.isnull("source"), "source").withColumn("part", F.spark_partition_id()), "sources")
    before = parts.groupBy("part").count().select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.isnull("source"), "source")) + F.col("before") - 1
    out = written(parts.join(before, "part").select("source", "source_size", (place % weights + 1).cast("int").alias("weight")), "weights")
    cap = F.col("source_size") * float(most)
    total = out.agg(F.sum("source_size")).first()[0] or 0
    level, taken = None, F.lit(False)
    while True:  # each round caps at least one more source, or ends
        row = out.agg(F.sum(F.when(taken, cap)).alias("full"), F.sum(F.when(~taken, F.col("weight"))).alias("open")).first()
        if not row["open"]:
            break
        now = (total - (row["full"] or 0.0)) / row["open"]
        if level is not None and now <= level:
            break
        level, taken = now, cap <= F.col("weight") * now
    return out.withColumn("target", F.least(cap, F.col("weight") * (level or 0.0)).cast("double"))


def curriculum(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", most: float = 3.0,
               seed: int = 17, schedules: dict | None = None) -> DataFrame:
    """Every row of ``docs`` as (doc_id, n, size, source_size, target, times): ``times`` are the times of
    its copies, none to ``most`` of them; rows are range-sorted by their first time, rows not taken last.

    ``n`` numbers rows with the same doc_id and size.  A null text has size 0, as an empty one; such rows
    are never taken.  A null source is a source of its own.  Rows with a null doc_id and repeated rows are
    documents like any other.  Other columns are ignored.  An empty table gives no rows.
    """
    schedules = schedules or SCHEDULES
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"))
    # repeated (doc_id, source, size) share one row with a count, so one hot id is no hot group
    rows = written(rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows")), "mix")
    goal = targets(rows.select("source", (F.col("size") * F.col("rows")).alias("size")), "source", "size", most, len(schedules))

    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string")))
    rows = rows.withColumn("key", key).withColumn("block", F.substring("key", 1, 2))  # 256 ranges of the order
    line = rows.withColumn("length", F.col("size") * F.col("rows"))
    sums = line.groupBy("source", "block").agg(F.sum("length").alias("length"))
    earlier = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source", "block", F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("block_at"))
    sums = sums.join(goal, sums["source"].eqNullSafe(goal["source"])).drop(goal["source"])
    within = Window.partitionBy("source", "block").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    line = line.withColumn("in_block", F.coalesce(F.sum("length").over(within), F.lit(0)))
    line = line.join(sums, line["source"].eqNullSafe(sums["source"]) & (line["block"] == sums["block"])).drop(sums["source"], sums["block"])
    line = line.withColumn("n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    at = F.col("block_at") + F.col("in_block") + (F.col("n") - 1) * F.col("size") + F.col("size") / 2

    middles = F.transform(F.sequence(F.lit(0), F.lit(int(most))), lambda e: e * F.col("source_size") + at)
    middles = F.filter(middles, lambda x: (F.col("size") > 0) & (x < F.col("target")))
    times = None
    for weight, knots in schedules.items():
        t = _times(knots)
        times = F.when(F.col("weight") == weight, t) if times is None else times.when(F.col("weight") == weight, t)
    out = line.withColumn("middles", middles).withColumn("times", times)
    # placed once: range-sorting reads its input twice, for the bounds and for the rows
    out = written(out.select("doc_id", "n", "source", "size", "source_size", "target", "times"), "placed")
    return out.repartitionByRange(F.get("times", F.lit(0)).asc_nulls_last(), "doc_id", "n").sortWithinPartitions(F.get("times", F.lit(0)).asc_nulls_last(), "doc_id", "n")


def training_order(mixed: DataFrame) -> DataFrame:
    """A row for each copy, range-sorted by its time: (doc_id, n, source, size, copy from 0, time)."""
    out = mixed.select("doc_id", "n", "source", "size", F.posexplode("times").alias("copy", "time"))
    return out.repartitionByRange("time", "doc_id", "n", "copy").sortWithinPartitions("time", "doc_id", "n", "copy")
