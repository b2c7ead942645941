"""Scale check: replicate events N times (ids shifted; derived by Spark from the
given table, nothing written) and compare the blocked running latency with a
plain per-task window.

    python tools/scale_check.py [sf_dir] [copies]
"""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from sluice.session import get_session  # noqa: E402

SF = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
COPIES = int(sys.argv[2]) if len(sys.argv) > 2 else 10
spark = get_session("local[8]", 32)
from sluice.sources import fixtures as fx
from sluice.operators.latency import running_latency
e = spark.read.parquet(f"{SF}/events.parquet")
n = e.count()
big = (e.select(F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("r"), "*")
        .select((F.col("event_id") + F.col("r") * n).alias("event_id"), "ts", "user_id", "event_type", "value", "props"))
lat = fx.latencies_from(big)
t = time.time()
got = running_latency(lat)
cnt = got.count(); print("rows", cnt, "sec", round(time.time() - t, 1))
# reference: plain per-task windows (fine here, one JVM) on the same rows
first = lat.groupBy("task").agg(F.min_by("arrival_ms", "seq").alias("f"))
w = lat.join(first, "task").where(F.col("arrival_ms") - F.col("f") > 5000)
ep = w.withColumn("epoch", F.sum(F.when(F.col("val") < 0, 1).otherwise(0)).over(Window.partitionBy("task").orderBy("seq")))
ref = ep.where("val >= 0").withColumn("m", F.avg("val").over(Window.partitionBy("task", "epoch").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)))
diff = got.join(ref.select("task", "seq", "m"), ["task", "seq"], "full").where(
    F.col("m").isNull() | F.col("mean_latency").isNull() | (F.abs(F.col("m") - F.col("mean_latency")) > 1e-9)).count()
print("mismatches", diff)
