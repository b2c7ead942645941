"""Session helpers.

The library never creates a cluster configuration of its own on a real
cluster: ``get_session`` only fills settings that are still unset, so the
cluster's ``spark.checkpoint.dir`` (a shared folder) and sizing win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators are written against.  UTC matters: fixture and
# message times are TIMESTAMP_NTZ and are turned into epoch milliseconds.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # no Python call-site capture on every DataFrame/Column call (several py4j
    # round trips each); it only enriches error messages
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # checkpoint files of chained scans go when their DataFrames are collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "sluice") -> SparkSession:
    """Return the active session, or build a local one for tests/bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("SLUICE_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in _DEFAULTS.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` of the session, else the folder set with
    ``setCheckpointDir``.  Where neither names one, a scratch folder is made for
    a local master (tests); on a cluster that would be a folder of the driver
    alone, so it is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # pragma: no cover - Spark Connect: the server owns the folder
        sc = None
    if not path and sc is not None:
        path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path and sc is not None and sc.getCheckpointDir() is not None:
        path = sc.getCheckpointDir()
    if not path:
        master = sc.master if sc is not None else ""
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="sluice-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables and
    streaming checkpoints (never a machine-local temp folder on a cluster)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/sluice/{name}"
