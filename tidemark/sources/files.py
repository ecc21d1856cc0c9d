"""What file systems know of a source: where rows come from, and how fresh its files are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SOURCE_FILE, SOURCE_TIME = "source_file", "source_modified"


def with_source(df: DataFrame) -> DataFrame:
    """Add the file that each row was read from and when that file was last changed.

    ``df`` reads files directly (batch or stream): the columns are hidden ones of the
    scan, so they cost no pass of their own and stay right however files are dealt out.
    """
    return df.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE),
                     F.col("_metadata.file_modification_time").alias(SOURCE_TIME))


def listed_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(source_file, source_modified, bytes) of all files below a path; none of them is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(F.col("path").alias(SOURCE_FILE), F.col("modificationTime").alias(SOURCE_TIME),
                                    F.col("length").alias("bytes"))


def file_freshness(files: DataFrame, as_of: str, *, group: str = r"([^/]+)/[^/]*$", stale_after_days: int = 35) -> DataFrame:
    """Per group of files, their number, bytes, latest change, and days since.

    ``group``: what the first group of this pattern finds in a path, by default the
    name of the folder; load days and batches of a bronze table are such folders.
    """
    last = F.max(SOURCE_TIME)
    days = F.date_diff(F.lit(as_of).cast("date"), F.to_date(last))
    return (files.groupBy(F.regexp_extract(SOURCE_FILE, group, 1).alias("source"))
            .agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), last.alias("last_changed"),
                 days.cast("bigint").alias("days_stale"))
            .withColumn("is_stale", F.col("days_stale") > stale_after_days))
