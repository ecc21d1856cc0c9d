"""Tables of one run on the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str = "table") -> str:
    """A new path below ``spark.checkpoint.dir``; what is written there goes when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def stored(df: DataFrame) -> DataFrame:
    """Write a frame as Parquet to a scratch path and read it back: lineage is cut, and
    columns that depend on how rows were dealt out keep their values."""
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
