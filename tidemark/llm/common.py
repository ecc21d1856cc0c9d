"""Helpers shared by the operators: stored tables, byte-level word splitting, row identity."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

# The white space of the word contracts: 0x20 and 0x09-0x0D, which is also
# what bytes.split() and bytes.lower() (A-Z only) work by.
WORD = r"[^\x20\x09-\x0D]+"
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Write a frame as Parquet below ``spark.checkpoint.dir`` and read it back.

    Cuts lineage like ``checkpoint()``, but keeps only the columns, encoded and
    compressed, on the shared folder. The files go when the driver ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return spark.read.schema(df.schema).parquet(path)


def id_remainder(col: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as -1."""
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.crc32(col.cast("string")) % modulus, F.lit(-1))


def content_key(*columns: str | Column) -> list[Column]:
    """Two independent 64-bit hashes of a row's columns, named _k1 and _k2: rows share both only if they are equal."""
    return [F.xxhash64(*columns).alias("_k1"), F.xxhash64(F.lit("second"), *columns).alias("_k2")]


def numbered(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Number the rows of each key 0, 1, 2, ...; ``rows`` are stored and have a unique ``_row``.

    Rows of keys that occur once are not sorted. Others are numbered within the
    split that they were written by (the upper bits of ``_row``), each of which
    starts after the ones before it, so no task holds all rows of a frequent key.
    """
    split = F.shiftright("_row", 33)
    counts = rows.groupBy(*keys, split.alias("_split")).agg(F.count("*").alias("_n"))
    along = Window.partitionBy(*keys).orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    several = counts.groupBy(*keys).agg(F.sum("_n").alias("_all")).where(F.col("_all") > 1).select(*keys)
    starts = counts.join(several, keys, "left_semi").withColumn("_before", F.coalesce(F.sum("_n").over(along), F.lit(0)))
    once = rows.join(several, keys, "left_anti").withColumn(name, F.lit(0).cast("bigint"))
    within = Window.partitionBy("_split", *keys).orderBy("_row")
    again = (rows.join(several, keys, "left_semi").withColumn("_split", split)
             .withColumn("_place", F.row_number().over(within)).join(starts, [*keys, "_split"])
             .withColumn(name, F.col("_before") + F.col("_place") - 1).select(*rows.columns, name))
    return once.unionByName(again)


def word_blocks(data: bytes, step: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in order, about ``step`` bytes of text at a time."""
    at, end = 0, len(data)
    while at < end:
        cut = end
        if end - at > step:
            found = _SPACE.search(data, at + step)
            cut = found.start() if found else end
        yield data[at:cut].split()
        at = cut
