"""Kafka offset planning and commit accounting.

Positions are per partition; acknowledgement logs are per (partition,
offset).  Per-partition results are hash aggregates (map-side partial
aggregation, so a hot partition is summed on every map task before the
shuffle); the running byte total of a fetch slice uses the blocked scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.operators.joins import dim_join
from sluice.operators.registry import as_of
from sluice.operators.scan import DEFAULT_BLOCK, materialize, prefix_scan

# Fixed values: "no offset known" marker, 1 MiB fetch size, 2000 ms commit interval.
NO_OFFSET = -5
DEFAULT_FETCH_BYTES = 1 << 20
DEFAULT_COMMIT_INTERVAL_MS = 2000
# Fixed values of a Kafka offset request: the latest and the earliest offset as times.
LATEST_TIME, EARLIEST_TIME = -1, -2


def time_index(msgs: DataFrame, bucket_ms: int = 3_600_000) -> DataFrame:
    """(partition, bucket, first_offset): the smallest offset of each partition and time bucket.  One row a bucket,
    summed by map tasks; messages without a time are in none."""
    bucket = F.floor(F.unix_millis("ts") / bucket_ms).cast("long")
    return msgs.where(F.col("ts").isNotNull()).groupBy("partition", bucket.alias("bucket")).agg(F.min("offset").alias("first_offset"))


def offsets_for_times(msgs: DataFrame, requests: DataFrame, bucket_ms: int = 3_600_000) -> DataFrame:
    """D1's startOffsetTime: ``requests`` (partition, time_ms, ...) with ``offset_at``, the smallest offset of the
    partition whose message is not older than ``time_ms``; the next offset to come if all are older.  The times -1 and -2
    ask for the latest (next) and the earliest offset.  A partition without messages has no offset: -5.

    Later buckets answer from the index (smallest offset from a bucket on, found as of the request), and only the
    messages of a request's own bucket are looked at.  Offsets need not rise with time."""
    own = requests.columns
    asked = requests.withColumn("_bucket", F.when(F.col("time_ms") >= 0, F.floor(F.col("time_ms") / bucket_ms).cast("long")))
    asked = materialize(asked.withColumns({"_request": F.monotonically_increasing_id(), "_after": -F.col("_bucket") - 1}))
    ends = msgs.groupBy("partition").agg(F.min("offset").alias("_first"), (F.max("offset") + 1).alias("_next"))
    later = Window.partitionBy("partition").orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, 0)
    index = time_index(msgs, bucket_ms).withColumns({"_from": F.min("first_offset").over(later), "_order": -F.col("bucket")})
    timed = as_of(asked.where("_bucket is not null"), "partition", "_after", materialize(index), "partition", "_order", F.col("_from"), "_later")
    here = msgs.where(F.col("ts").isNotNull()).select("partition", F.floor(F.unix_millis("ts") / bucket_ms).cast("long").alias("_bucket"), F.unix_millis("ts").alias("_ms"), "offset")
    here = dim_join(here, asked.select("partition", "_bucket", "time_ms", "_request").where("_bucket is not null"), ["partition", "_bucket"], "inner")
    here = here.where("_ms >= time_ms").groupBy("_request").agg(F.min("offset").alias("_here"))
    timed = timed.join(here, "_request", "left").select("_request", F.least("_here", "_later").alias("_at"))
    out = asked.join(timed, "_request", "left").join(ends, "partition", "left")
    at = F.when(F.col("time_ms") == EARLIEST_TIME, F.col("_first")).when(F.col("time_ms") == LATEST_TIME, F.col("_next")).otherwise(F.coalesce("_at", "_next"))
    return out.select(*own, F.coalesce(at, F.lit(NO_OFFSET)).cast("long").alias("offset_at"))


def start_offset_plan(positions: DataFrame, running_topology: str, force_from_start: bool = False,
                      max_offset_behind: int | None = None, zero_is_valid: bool = False,
                      start_column: str = "earliest") -> DataFrame:
    """Where each partition starts reading.

    ``positions``: partition_id, earliest, current (latest), saved (nullable),
    saved_topology.  In order: (a) nothing saved -> start; (b) saved by another
    topology and force_from_start -> earliest; (c) else the saved offset; then
    (d) when start - committed > max_offset_behind, or committed <= 0 (< 0 with
    ``zero_is_valid``), the start offset wins.  ``start`` is the latest offset,
    or when force_from_start the one at startOffsetTime; a missing offset is -5.
    ``start_column`` holds the offset at startOffsetTime, by default the earliest;
    ``offsets_for_times`` gives it for any time.
    """
    start = F.coalesce(F.col(start_column) if force_from_start else F.col("current"), F.lit(NO_OFFSET))
    none_saved = F.col("saved").isNull() | F.col("saved_topology").isNull()
    other_topology = (F.col("saved_topology") != F.lit(running_topology)) & F.lit(force_from_start)
    branch = (F.when(none_saved, F.lit("none_saved"))
              .when(other_topology, F.lit("topology_changed"))
              .otherwise(F.lit("saved")))
    committed = (F.when(none_saved, start)
                 .when(other_topology, F.coalesce(F.col(start_column), F.lit(NO_OFFSET)))
                 .otherwise(F.col("saved")))
    behind = (start - committed > F.lit(max_offset_behind)) if max_offset_behind is not None else F.lit(False)
    low = (committed < 0) if zero_is_valid else (committed <= 0)
    reset = behind | low
    return positions.select(
        "partition_id",
        branch.alias("branch"),
        committed.cast("long").alias("committed"),
        reset.alias("reset"),
        F.when(reset, start).otherwise(committed).cast("long").alias("start_offset"))


def from_start_offsets(msgs: DataFrame, plan: DataFrame) -> DataFrame:
    """D1 as a table, for a plan of any size: messages read from the earliest
    offset, from their partition's planned start on.  Partitions the plan does
    not name are read whole.  Nothing comes to the driver."""
    s = plan.select(F.col("partition_id").alias("_p_part"), F.col("start_offset").alias("_p_start"))
    j = dim_join(msgs, s, F.col("partition") == F.col("_p_part"), "left")
    return j.where(F.col("_p_start").isNull() | (F.col("offset") >= F.col("_p_start"))).drop("_p_part", "_p_start")


def starting_offsets_option(plan: DataFrame, topic: str) -> str:
    """The Kafka source ``startingOffsets`` JSON for a start-offset plan.

    The option is a driver-side string by the Kafka source's API, with one entry
    per topic partition; ``from_start_offsets`` needs none."""
    row = (plan.agg(F.to_json(F.create_map(
        F.lit(topic),
        F.map_from_entries(F.collect_list(F.struct(F.col("partition_id").cast("string"),
                                                   F.col("start_offset")))))).alias("j"))
           .first())
    return row["j"] if row and row["j"] else "{}"


def fetch_slice(msgs: DataFrame, starts: DataFrame, fetch_bytes: int = DEFAULT_FETCH_BYTES,
                size_col: str | None = None, block_size: int | None = DEFAULT_BLOCK) -> DataFrame:
    """Per partition, messages from the start offset on, while the running
    byte total stays within ``fetch_bytes``; the first message is always
    admitted.  ``starts``: (partition, start_offset).  Adds ``slice_bytes``."""
    size = F.col(size_col) if size_col else F.coalesce(F.length("value"), F.lit(0)).cast("long")
    s = starts.select(F.col("partition").alias("_f_part"), F.col("start_offset").alias("_f_start"))
    m = dim_join(msgs, s, F.col("partition") == F.col("_f_part"), "inner")
    m = m.where(F.col("offset") >= F.col("_f_start")).drop("_f_part", "_f_start").withColumn("_f_size", size)
    # Sizes are non-negative, so a block whose preceding bytes already exceed
    # the limit holds no admitted row: it is dropped before the row window.
    scanned = prefix_scan(m, ["partition"], "offset",
                          {"slice_bytes": ("sum", F.col("_f_size")), "_f_n": ("sum", F.lit(1).cast("long"))},
                          block_size,
                          keep_blocks=lambda off: F.coalesce(off["slice_bytes"], F.lit(0)) <= F.lit(fetch_bytes))
    return (scanned.where((F.col("_f_n") == 1) | (F.col("slice_bytes") <= F.lit(fetch_bytes)))
            .drop("_f_size", "_f_n"))


def range_reset(requests: DataFrame, use_start_offset_if_out_of_range: bool = True, start_offset_time: str = "earliest") -> DataFrame:
    """D3: a requested offset outside [earliest, latest] is retried once at the
    start offset (``start_offset_time``: earliest, latest, or a column of
    ``requests`` that holds the offset at startOffsetTime) when enabled, else it
    is an error.  ``requests``: partition_id, requested, earliest, latest; a null
    request has no status."""
    if start_offset_time not in ("earliest", "latest", *requests.columns):
        raise ValueError(f"unknown start offset time {start_offset_time!r}")
    out = (F.col("requested") < F.col("earliest")) | (F.col("requested") > F.col("latest"))
    status = F.when(~out, F.lit("ok")).when(out, F.lit("reset" if use_start_offset_if_out_of_range else "error"))
    offset = F.when(~out, F.col("requested")).when(out & F.lit(use_start_offset_if_out_of_range), F.col(start_offset_time))
    return requests.select("*", status.alias("fetch_status"), offset.cast("long").alias("fetch_offset"))


def ack_status(emitted: DataFrame, acks: DataFrame) -> DataFrame:
    """Emitted (partition, offset) rows with ``acked``.  Duplicate acks count once;
    the distinct and the join share one shuffle on (partition, offset)."""
    a = acks.select("partition", "offset").distinct().withColumn("acked", F.lit(True))
    return (emitted.join(a, ["partition", "offset"], "left")
            .withColumn("acked", F.coalesce(F.col("acked"), F.lit(False))))


def commit_point(emitted: DataFrame, acks: DataFrame) -> DataFrame:
    """A3: per partition, the smallest pending (un-acked) offset, else the next
    offset to emit.  Failed offsets stay pending."""
    st = ack_status(emitted, acks)
    return (st.groupBy("partition")
            .agg(F.min(F.when(~F.col("acked"), F.col("offset"))).alias("min_pending"),
                 (F.max("offset") + 1).alias("next_offset"),
                 F.sum(F.when(~F.col("acked"), 1).otherwise(0)).cast("long").alias("pending"))
            .withColumn("commit_offset", F.coalesce(F.col("min_pending"), F.col("next_offset"))))


def commit_changes(points: DataFrame, saved: DataFrame) -> DataFrame:
    """A4: the commit points that differ from the saved offsets (what a commit
    would write).  ``saved``: (partition, saved_offset).  The 2000 ms cadence is
    the streaming trigger (``sluice.streaming``)."""
    s = saved.select(F.col("partition").alias("_c_part"), F.col("saved_offset"))
    j = dim_join(points, s, F.col("partition") == F.col("_c_part"), "left").drop("_c_part")
    return j.where(F.col("saved_offset").isNull() | (F.col("saved_offset") != F.col("commit_offset")))


def fail_admission(fails: DataFrame, emitted: DataFrame, max_offset_behind: int) -> DataFrame:
    """T4: a failure is ignored when its offset is more than
    ``max_offset_behind`` below the partition's next offset to emit."""
    nxt = emitted.groupBy("partition").agg((F.max("offset") + 1).alias("_a_next"))
    nxt = nxt.withColumnRenamed("partition", "_a_part")
    j = fails.join(nxt, F.col("partition") == F.col("_a_part"), "left").drop("_a_part")
    admitted = F.col("offset") >= F.col("_a_next") - F.lit(max_offset_behind)
    return j.withColumn("admitted", F.coalesce(admitted, F.lit(False))).withColumnRenamed("_a_next", "next_offset")


def ack_counters(emitted: DataFrame, acks: DataFrame, fails: DataFrame, max_offset_behind: int) -> DataFrame:
    """A5: per partition, acknowledged and (admitted) failed counts; ``error``
    when failures exceed max_offset_behind while nothing is acked yet: those before
    the partition's first acknowledgement, by ``ack_seq`` and ``fail_seq``.  Logs
    without these columns have no order; then nothing may be acked at all."""
    acked = (ack_status(emitted, acks).groupBy("partition")
             .agg(F.sum(F.col("acked").cast("long")).alias("acked")))
    admitted = fail_admission(fails, emitted, max_offset_behind).where("admitted")
    if "ack_seq" in acks.columns and "fail_seq" in fails.columns:
        first = (acks.join(emitted, ["partition", "offset"], "left_semi").groupBy("partition")
                 .agg(F.min("ack_seq").alias("_a_first")))
        admitted = dim_join(admitted, first.withColumnRenamed("partition", "_a_part"), F.col("partition") == F.col("_a_part"), "left")
        early = F.col("_a_first").isNull() | (F.col("fail_seq") < F.col("_a_first"))
    else:
        early = F.lit(True)
    failed = admitted.groupBy("partition").agg(F.count(F.lit(1)).alias("failed"), F.count_if(early).alias("_a_early"))
    j = acked.join(failed, "partition", "left").withColumn("failed", F.coalesce(F.col("failed"), F.lit(0)).cast("long"))
    none_acked = F.lit(True) if "ack_seq" in acks.columns and "fail_seq" in fails.columns else F.col("acked") == 0
    return j.withColumn("error", none_acked & (F.coalesce(F.col("_a_early"), F.lit(0)) > F.lit(max_offset_behind))).drop("_a_early")


def replay_failed(msgs: DataFrame, fails: DataFrame) -> DataFrame:
    """When a partition has failures, re-read from its smallest failed
    offset and emit only the failed offsets.  Adds ``replay_from``."""
    f = fails.select("partition", "offset").distinct()
    start = f.groupBy("partition").agg(F.min("offset").alias("replay_from"))
    replay = msgs.join(f, ["partition", "offset"], "left_semi")
    return replay.join(start, "partition", "inner")
