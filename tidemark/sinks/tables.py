"""Writers: re-runnable daily append, full replace by releases, table
materialisation, the CSV exports, and counts observed during a write."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .releases import Releases

INGEST_DATE = "ingest_date"
LOAD_BATCH = "load_batch"
DAILY = "daily"               # the batch of a plain daily load


def _laid_out(df: DataFrame, sort_by) -> DataFrame:
    """Sort rows inside each task before writing (file layout only: row
    groups get tight min/max stats for the series keys; no shuffle)."""
    return df.sortWithinPartitions(*sort_by) if sort_by else df


def _observed(df: DataFrame, name: str, metrics) -> tuple[DataFrame, Observation]:
    """Attach a row count (and any extra aggregate ``metrics``) that the
    write itself computes: no second pass over the data."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *metrics), obs


def utc_day(df: DataFrame, loaded: str):
    """The UTC day of a load time, whatever zone the session shows times in.
    A time without a zone is taken as it is."""
    if dict(df.dtypes)[loaded] == "timestamp":
        return F.to_date(F.to_utc_timestamp(F.col(loaded), F.current_timezone()))
    return F.to_date(F.col(loaded))


def append_daily(df: DataFrame, path: str, loaded: str = "ingested_at", sort_by=(),
                 metrics=(), batch: str = DAILY, run_ts=None) -> dict:
    """Re-runnable load: rows land under their UTC load day and batch; a
    replay of the same day and batch replaces only these rows (dynamic
    partition overwrite), other days and batches stay. A replay without rows
    clears the batch of the run's day (``run_ts``, a UTC time or null for now).
    Returns the observed metrics.
    """
    keyed = df.withColumn(INGEST_DATE, utc_day(df, loaded)).withColumn(LOAD_BATCH, F.lit(batch))
    out, obs = _observed(keyed, "append_daily", metrics)
    out = _laid_out(out, sort_by)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(INGEST_DATE, LOAD_BATCH).parquet(path))
    seen = obs.get
    if not seen["rows"]:
        day = (run_ts or _dt.datetime.now(_dt.timezone.utc)).date()
        _drop_folder(df.sparkSession, f"{path}/{INGEST_DATE}={day}/{LOAD_BATCH}={batch}")
    return seen


def _drop_folder(spark, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


ROWS = "rows"                 # the one table of a release made by replace_table


def replace_table(df: DataFrame, path: str, sort_by=(), metrics=(), checks=()) -> dict:
    """Full replace by a new release (see ``releases``): readers keep the rows they have
    begun to read, and a job that dies or fails one of the ``checks`` leaves the table as
    it was. The schema is the frame's own. Returns the observed metrics."""
    draft = Releases(df.sparkSession, path).draft()
    draft.write(ROWS, df, sort_by=sort_by, metrics=metrics, checks=checks)
    return draft.publish().observed[ROWS]


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Replace a table by a model's rows and read it back: later readers start from
    the stored files (lineage cut), as a table materialisation."""
    replace_table(df, path)
    return read_replaced(df.sparkSession, path)


def read_replaced(spark, path: str) -> DataFrame:
    """The rows of a table as ``replace_table`` last wrote it."""
    return Releases(spark, path).read(ROWS)


def write_export_csv(df: DataFrame, path: str, order: str = "period_date") -> dict:
    """One CSV file with a header, ordered by month; nulls written empty.

    A single file means a single writer task; the frame is month grain (one
    row per month), so that task is bounded by the calendar.
    """
    out, obs = _observed(df, "export", ())
    single = out.repartition(1).sortWithinPartitions(order)
    (single.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd")
     .csv(path))
    return obs.get


def write_ordered_csv(df: DataFrame, path: str, order, files: int) -> dict:
    """The rows in order over several CSV files with headers: every file holds a range of
    the order, and the files' names sort like the ranges. Each is written by a task of its own."""
    out, obs = _observed(df.repartitionByRange(files, *order), "export", ())
    (out.sortWithinPartitions(*order).write.mode("overwrite").option("header", True)
     .option("dateFormat", "yyyy-MM-dd").csv(path))
    return obs.get


def register_views(frames: dict[str, DataFrame]) -> None:
    """Publish lazy models as temp views (view materialisation)."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def read_bronze(spark, path: str, schema=None) -> DataFrame:
    """A bronze table: as ``replace_table`` last wrote it, or all days of ``append_daily``
    without its partition columns.

    With its declared ``schema`` no file is opened to infer one.
    """
    replaced = Releases(spark, path).release()
    if replaced is not None:
        return Releases(spark, path).read(ROWS, replaced)
    df = spark.read.schema(schema).parquet(path) if schema is not None else spark.read.parquet(path)
    return df.drop(INGEST_DATE, LOAD_BATCH)
