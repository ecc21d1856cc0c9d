"""Spark session settings the library relies on."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job of the library assumes. ANSI stays on (Spark 4 default):
# bad casts and division by zero raise instead of turning into nulls silently.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Coalesce shuffle partitions to the advisory size (64 MB) rather than to
    # the core count: month-grain stages become one task, while large stages
    # keep as many partitions as their bytes need (the setting Spark advises
    # for busy clusters).
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Monthly lookup sides are joined by AQE's runtime broadcast switch: the
    # decision uses the measured size of the shuffled side, so a side that is
    # unexpectedly large falls back to a sort-merge join instead of failing.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.parquet.filterPushdown": "true",
    # Checkpoints go when the frames that own them do.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # PySpark 4 records the Python call site of every DataFrame/Column call
    # for error messages; that costs several JVM round trips per call and
    # dominated query-construction time. Errors still carry the JVM context.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    Without ``master`` the one of the submitted job holds (a master set in code
    would outrank it); a plain Python process without any runs locally.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names shared storage and is always read from the
    session; an unset folder is an error there, since a machine-local folder
    would not survive the loss of an executor. Only where driver and executors
    are one process (local mode, as in tests) is a scratch folder created when
    nothing is set.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or S3)")
        configured = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
