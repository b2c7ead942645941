"""Running latency mean (P10, A1).

The aggregate is a fold over one task's values in arrival order: the first
row fixes the start; rows up to ``warmup_ms`` after it (inclusive) are
skipped; afterwards a negative value resets the mean and emits nothing, and
any other value updates the running mean and emits it.

Batch and stream form share ``_since_reset``, a segmented blocked scan: rows are
cut into blocks of the sequence; within a block, running counts of resets make
segments and running sums restart with each; a block's total is (holds a reset,
sum and count after its last one).  The totals, one small row per task and block,
are scanned the same way, and each block's rows before its first reset carry on
from the block before.  Rows are shuffled once, by (task, block), so a task
holding a third of all rows is spread over many tasks, and nothing is
checkpointed.
Values are BIGINT milliseconds and the sums are exact integers.  A null value
(P10 of a message without a time header) is no measurement: it neither counts nor
emits, though its arrival can open the warm-up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.operators.scan import DEFAULT_BLOCK, _key_default, auto_block_size

# Fixed value: rows within 5000 ms of the first one are not counted.
DEFAULT_WARMUP_MS = 5000


def after_warmup(rows: DataFrame, task: str = "task", seq: str = "seq", arrival: str = "arrival_ms",
                 warmup_ms: int = DEFAULT_WARMUP_MS) -> DataFrame:
    """Rows arriving strictly more than ``warmup_ms`` after the task's first row."""
    first = (rows.groupBy(task).agg(F.min_by(F.col(arrival), F.col(seq)).alias("_l_first"))
             .withColumnRenamed(task, "_l_task"))
    j = rows.join(first, F.col(task).eqNullSafe(F.col("_l_task")), "inner")
    return j.where(F.col(arrival) - F.col("_l_first") > F.lit(warmup_ms)).drop("_l_task", "_l_first")


def _since_reset(rows: DataFrame, task: str, seq: str, val: str, block_size: int) -> DataFrame:
    """``rows`` with ``_l_s`` and ``_l_c``, sum and count of the values since the
    last negative one up to the row, and ``_l_reset``, whether there was one."""
    neg = F.col(val) < 0
    d = rows.select(
        "*", F.coalesce(F.col(task), _key_default(rows.schema[task].dataType)).alias("_l_k"), F.isnull(F.col(task)).alias("_l_n"),
        F.floor(F.col(seq) / F.lit(block_size)).cast("long").alias("_l_b"),
        F.when(neg, F.lit(0)).otherwise(F.col(val)).cast("long").alias("_l_v"), neg.cast("long").alias("_l_neg"))
    block = ["_l_k", "_l_n", "_l_b"]
    to_here = (Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("_l_g", F.sum("_l_neg").over(Window.partitionBy(*block).orderBy(seq).rowsBetween(*to_here)))
    segment = Window.partitionBy(*block, "_l_g").orderBy(seq).rowsBetween(*to_here)
    d = d.withColumns({"_l_s0": F.sum("_l_v").over(segment), "_l_c0": F.sum(1 - F.col("_l_neg")).over(segment)})
    last = d.groupBy(*block).agg(F.max_by(F.struct((F.col("_l_g") > 0).cast("long").alias("r"), "_l_s0", "_l_c0"), F.col(seq)).alias("t"))
    by_block = Window.partitionBy("_l_k", "_l_n").orderBy("_l_b")
    last = last.withColumn("_l_G", F.sum("t.r").over(by_block.rowsBetween(*to_here)))
    run = Window.partitionBy("_l_k", "_l_n", "_l_G").orderBy("_l_b").rowsBetween(*to_here)
    last = last.withColumn("up", F.struct(F.sum("t._l_s0").over(run).alias("s"), F.sum("t._l_c0").over(run).alias("c"), F.col("_l_G").alias("g")))
    carried = last.select(*block, F.lag("up").over(by_block).alias("_l_up"))
    j = d.join(carried, block)
    first = F.col("_l_g") == 0
    return j.select(
        *rows.columns,
        (F.col("_l_s0") + F.when(first, F.coalesce(F.col("_l_up.s"), F.lit(0))).otherwise(0)).alias("_l_s"),
        (F.col("_l_c0") + F.when(first, F.coalesce(F.col("_l_up.c"), F.lit(0))).otherwise(0)).alias("_l_c"),
        (~first | (F.coalesce(F.col("_l_up.g"), F.lit(0)) > 0)).alias("_l_reset"))


def running_latency(rows: DataFrame, task: str = "task", seq: str = "seq", arrival: str = "arrival_ms",
                    val: str = "val", warmup_ms: int = DEFAULT_WARMUP_MS,
                    block_size: int | None = DEFAULT_BLOCK) -> DataFrame:
    """A1: one output row per emitted mean: (task, seq, val, mean_latency)."""
    block_size = block_size or auto_block_size(rows)  # of the input: a join's estimate is far off
    w = after_warmup(rows.select(task, seq, arrival, val), task, seq, arrival, warmup_ms)
    scored = _since_reset(w.where(F.col(val).isNotNull()), task, seq, val, block_size)
    return (scored.where(F.col(val) >= 0)
            .select(task, seq, val, (F.col("_l_s").cast("double") / F.col("_l_c").cast("double")).alias("mean_latency")))


LATENCY_STATE_COLUMNS = ["task", "first_ms", "total", "count"]


def running_latency_from(rows: DataFrame, prior: DataFrame | None, task: str = "task", seq: str = "seq",
                         arrival: str = "arrival_ms", val: str = "val", warmup_ms: int = DEFAULT_WARMUP_MS,
                         block_size: int | None = DEFAULT_BLOCK) -> tuple[DataFrame, DataFrame]:
    """A1 continued from a state table -- one micro-batch of a stream.

    ``prior``: (task, first_ms, total, count) left by the previous batch
    (total/count since the last reset), or None.  Returns (emitted means,
    new state).  Same blocked scan as the batch form, so a hot task in a big
    micro-batch is still spread over many tasks."""
    spark = rows.sparkSession
    block_size = block_size or auto_block_size(rows)
    if prior is None:
        prior = spark.createDataFrame([], "task int, first_ms long, total long, count long")
    prior = prior.select(F.col("task").alias("_p_task"), F.col("first_ms").alias("_p_first"),
                         F.col("total").alias("_p_total"), F.col("count").alias("_p_count"))
    r = rows.select(task, seq, arrival, val)
    first_here = r.groupBy(task).agg(F.min_by(F.col(arrival), F.col(seq)).alias("_b_first"))
    firsts = (first_here.join(prior, F.col(task).eqNullSafe(F.col("_p_task")), "full")
              .select(F.coalesce(F.col("_p_task"), F.col(task)).alias("_l_task"),
                      F.coalesce(F.col("_p_first"), F.col("_b_first")).alias("_l_first"),
                      F.coalesce(F.col("_p_total"), F.lit(0)).cast("long").alias("_l_pt"),
                      F.coalesce(F.col("_p_count"), F.lit(0)).cast("long").alias("_l_pc")))
    w = (r.join(firsts, F.col(task).eqNullSafe(F.col("_l_task")), "inner")
         .where(F.col(arrival) - F.col("_l_first") > F.lit(warmup_ms))
         .where(F.col(val).isNotNull()).drop("_l_task", "_l_first"))
    # since the last reset: the prior run carries on until the first negative here
    more = F.when(F.col("_l_reset"), F.lit(0))
    scored = _since_reset(w, task, seq, val, block_size).select(
        task, seq, val, (F.col("_l_s") + more.otherwise(F.col("_l_pt"))).alias("_l_ss"),
        (F.col("_l_c") + more.otherwise(F.col("_l_pc"))).alias("_l_cc"))
    means = (scored.where(F.col(val) >= 0)
             .select(task, seq, val, (F.col("_l_ss").cast("double") / F.col("_l_cc").cast("double"))
                     .alias("mean_latency")))
    last = (scored.groupBy(task).agg(F.max_by(F.struct("_l_ss", "_l_cc"), F.col(seq)).alias("_l_last"))
            .withColumnRenamed(task, "_n_task"))
    state = (firsts.join(last, F.col("_l_task").eqNullSafe(F.col("_n_task")), "left")
             .select(F.col("_l_task").alias("task"), F.col("_l_first").alias("first_ms"),
                     F.coalesce(F.col("_l_last._l_ss"), F.col("_l_pt")).alias("total"),
                     F.coalesce(F.col("_l_last._l_cc"), F.col("_l_pc")).alias("count")))
    return means, state
