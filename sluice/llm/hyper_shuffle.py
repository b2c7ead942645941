"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix (operator 6).

1. For input partitions of c_p rows and shards of m_s rows (at most one apart), the number of rows that
   p sends to s in a uniform random permutation is drawn exactly: row after row of the matrix is
   multivariate hypergeometric, given what the shards still have room for.
2. Each partition permutes its rows locally (a seeded hash order) and deals them out by its matrix row.
3. After the exchange each shard is permuted again: a second seeded hash cuts it into buckets, buckets
   are put in order by their counts and sorted within, so a shard never meets in one task.

Only (id, size, checksum) rows move.  The driver holds one count for each partition and shard, which
grows with the number of input files, not with rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import written


def communication_matrix(counts: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """counts[p] rows dealt to shards whose sizes are at most one apart: matrix [p, s], drawn exactly."""
    total = int(counts.sum())
    room = np.full(shards, total // shards, dtype=np.int64)
    room[: total % shards] += 1
    rng = np.random.Generator(np.random.PCG64(seed))
    out = np.zeros((len(counts), shards), dtype=np.int64)
    for p, c in enumerate(counts):
        left = int(c)
        for s in range(shards):  # one hypergeometric draw for each shard, given those before
            others = int(room[s + 1:].sum())
            out[p, s] = _draw(rng, int(room[s]), others, left)
            left -= int(out[p, s])
        room -= out[p]
    return out


def _draw(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Good ones among the draws, without replacement.  Beyond 10^9, numpy's limit, by inversion of the
    probabilities within 12 standard deviations of the mode, all but 10^-30 of them."""
    if not draws or not good:
        return 0
    if not bad:
        return draws
    total = good + bad
    if total < 10**9:
        return int(rng.hypergeometric(good, bad, draws))
    least, most = max(0, draws - bad), min(good, draws)
    mode = (draws + 1) * (good + 1) // (total + 2)
    wide = int(12 * (draws * (good / total) * (bad / total)) ** 0.5) + 50
    k = np.arange(max(least, mode - wide), min(most, mode + wide) + 1, dtype=np.float64)
    step = np.log(good - k[:-1]) + np.log(draws - k[:-1]) - np.log(k[1:]) - np.log(bad - draws + k[1:])
    weight = np.concatenate(([0.0], np.cumsum(step)))
    share = np.cumsum(np.exp(weight - weight.max()))
    return int(k[np.searchsorted(share, rng.random() * share[-1], side="right")])


def hyper_shuffle(docs: DataFrame, size: Column, checksum: Column, doc_id: str = "doc_id", shards: int = 8,
                  seed: int = 29, bucket_rows: int = 1024, most_buckets: int = 16384) -> DataFrame:
    """Every row of ``docs`` as (doc_id, size, checksum, shard, slot): shard sizes are at most one apart and
    slots run from 0 without a gap in each shard.

    Repeated rows and rows with null ids are rows like any other; the order depends on a row's place in the
    input files and the seed only.  Other columns are ignored.  An empty table gives no rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), size.alias("size"), checksum.alias("checksum"),
                       F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"))
    rows = written(rows, "shuffle")  # the place of a row is fixed here
    spark = docs.sparkSession
    counts = sorted((r["part"], r["count"]) for r in rows.groupBy("part").count().collect())
    matrix = communication_matrix(np.array([c for _, c in counts], dtype=np.int64), shards, seed)
    sent = spark.createDataFrame([(p, [int(x) for x in np.cumsum(m)]) for (p, _), m in zip(counts, matrix, strict=True)], "part int, upto array<long>")

    local = F.row_number().over(Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed), "place"), "place"))
    dealt = rows.withColumn("nth", local).join(sent, "part")
    dealt = dealt.withColumn("shard", F.size(F.filter("upto", lambda x: x < F.col("nth"))).cast("int")).drop("upto", "nth", "part")

    total = int(sum(c for _, c in counts))
    buckets = max(1, min(most_buckets, -(-total // (shards * bucket_rows))))
    again = F.xxhash64(F.lit(seed + 1), "place")
    dealt = written(dealt.withColumn("mark", again), "dealt").withColumn("bucket", F.pmod(F.shiftrightunsigned("mark", 20), F.lit(buckets)).cast("int"))
    sums = dealt.groupBy("shard", "bucket").count()
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("mark", "place"))
    out = dealt.withColumn("nth", nth).join(sums, ["shard", "bucket"])
    return out.select("doc_id", "size", "checksum", "shard", (F.col("before") + F.col("nth") - 1).cast("long").alias("slot"))
