"""Spark session settings and the shared working folder.

Everything that depends on the cluster (checkpoint folder, shuffle width) is
read from the session, so the same code runs on ``local[8]`` and on a large
cluster. Defaults are set only where the session leaves them unset.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on for deterministic, scalable plans:
# UTC wall clock (bucket keys must not move with the driver's zone), AQE for
# runtime re-planning (partition coalescing, skew splitting, broadcast
# conversion after a measured aggregate), and Arrow for any pandas edge.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Remove checkpoint files once their data is no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "tidemark",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the project defaults.

    ``master`` is only for local runs and tests; on a cluster it comes from
    ``spark-submit``. ``shuffle_partitions`` defaults to the core count when
    local; on a cluster leave it to the deployment (AQE coalesces anyway).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if shuffle_partitions is None:
            shuffle_partitions = os.cpu_count() or 8
        builder = builder.config("spark.driver.memory", "16g")
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # The session may pre-exist (driver harness); make the time zone certain.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """Folder shared by all executors, taken from ``spark.checkpoint.dir``.

    The setting names the shared folder and is always read from the session; a
    folder that the caller gave to ``setCheckpointDir`` counts too. If neither is
    set this raises: there is no fallback to a machine-local folder. Give it when
    the session is built (``get_session(extra={"spark.checkpoint.dir": ...})``);
    Spark does not let it be set later.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors when the session is built")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return "/".join([base.rstrip("/"), *parts]) if parts else base


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that goes when the application ends."""
    path = shared_dir(spark, f"{name}-{uuid.uuid4().hex}")
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path
