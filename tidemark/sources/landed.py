"""Readers for landed source files (the loaders' extract + transform steps).

HTTP fetching is not part of the library: files are landed first (one file
per response page), then read here in parallel, one task per file or split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.labels import EXPORTS, IMPORTS
from ..functions.numeric import lenient_double, nan_to_null, strict_double

# Id columns of the record pages.
RECORD_ID = "_id"
SERIES_KEY = "DataSeries"
SERIES_KEY_ALT = "Data Series Text"


def _read_json(spark: SparkSession, paths, schema) -> DataFrame:
    paths = [paths] if isinstance(paths, str) else list(paths)
    # One JSON document per file (an API response); FAILFAST so a malformed
    # file stops the load instead of becoming an all-null row.
    return (spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST")
            .json(paths))


def _run_ts(run_ts) -> Column:
    return F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")


def _present(name: str, message: str) -> Column:
    """A required part of a payload: null fails the load. The check sits
    inside the exploded expression, so it cannot be pruned."""
    return F.when(F.col(name).isNull(), F.raise_error(F.lit(message))).otherwise(F.col(name))


def read_cpi_payload(spark: SparkSession, paths, run_ts=None) -> DataFrame:
    """CPI payload files -> bronze_cpi_raw rows (one per category x month).

    ``''`` and ``'na'`` values become null; any other non-number fails the
    load (ANSI cast). ``run_ts`` is the audit time of the run (one value per
    run; default: the query's ``current_timestamp``).
    """
    return flatten_cpi_payload(_read_json(spark, paths, schemas.CPI_PAYLOAD), run_ts)


def flatten_cpi_payload(payload: DataFrame, run_ts=None) -> DataFrame:
    """Nested payload rows -> (cpi_category, time_period, cpi_value, ingested_at).

    Two ``inline`` generators, row-parallel; works on batch and streaming frames.
    """
    rows = payload.select(F.inline(_present("Data.row", "CPI payload without 'Data' or 'row'")))
    obs = rows.select(F.col("rowText").alias("cpi_category"),
                      F.inline(_present("columns", "CPI row without 'columns'")))
    # An observation without a category, month or value (JSON null or a
    # missing field) fails the load, as a malformed payload should; only the
    # text marks '' and 'na' stand for "no value".
    incomplete = F.col("cpi_category").isNull() | F.col("key").isNull() | F.col("value").isNull()
    value = F.when(incomplete, F.raise_error(F.lit("CPI observation without category, month or value")))
    return obs.select("cpi_category", F.col("key").alias("time_period"),
                      value.otherwise(nan_to_null(strict_double("value"))).cast("double").alias("cpi_value"),
                      _run_ts(run_ts).alias("ingested_at"))


def read_record_pages(spark: SparkSession, paths, trade_type: str | None = None) -> DataFrame:
    """Record page files -> one row per record, ``record`` a map column.

    Pages are concatenated (a multi-file read); a page without ``result``
    fails the load. With ``trade_type`` each record is tagged with it.
    """
    pages = _read_json(spark, paths, schemas.RECORD_PAGE)
    recs = pages.select(F.explode(_present("result.records", "record page without 'result' or 'records'"))
                        .alias("record"))
    if trade_type is not None:
        recs = recs.select("record", F.lit(trade_type).alias("trade_type"))
    return recs


def melt_records(records: DataFrame, *, id_keys: Sequence[str], series: Column, var: str,
                 value: str, keep: Sequence[str] = ()) -> DataFrame:
    """Wide records (map column ``record``) -> long rows, one per month key.

    The month columns are whatever keys are not ids, found per record, so no
    schema has to be inferred up front. Values are parsed leniently and rows
    without a number are dropped. A record without its series name fails the
    load. Row-parallel: no shuffle.
    """
    named = F.when(series.isNull(), F.raise_error(F.lit("record without a series name"))).otherwise(series)
    ids = F.array(*[F.lit(k) for k in id_keys])
    months = F.map_filter("record", lambda k, v: ~F.array_contains(ids, k))
    # The name travels inside the exploded entries, so its check is not pruned
    # for records whose months hold no number.
    entries = F.transform(F.map_entries(months), lambda e: F.struct(
        named.alias("series"), e["key"].alias("month"), e["value"].alias("text")))
    exploded = records.select(*keep, F.explode(entries).alias("__entry"))
    out = exploded.select(F.col("__entry.series").alias("__series"), *keep, F.col("__entry.month").alias(var),
                          lenient_double("__entry.text").alias(value))
    return out.dropna(subset=[value])


def _records(spark: SparkSession, paths, trade_type: str | None, page_size: int | None) -> DataFrame:
    if page_size is None:
        return read_record_pages(spark, paths, trade_type)
    from .pages import read_page_set
    return read_page_set(spark, paths, page_size, trade_type=trade_type)


def read_fx_pages(spark: SparkSession, paths, run_ts=None, page_size: int | None = None) -> DataFrame:
    """FX record pages -> bronze_fx_raw (currency_pair, rate_month, exchange_rate, ingested_at).

    With ``page_size``, the records of a full page, a page set that is not whole
    fails the load (see ``pages``)."""
    return fx_rows(_records(spark, paths, None, page_size), run_ts)


def fx_rows(recs: DataFrame, run_ts=None) -> DataFrame:
    """Records (record map) -> bronze_fx_raw rows."""
    long = melt_records(recs, id_keys=[RECORD_ID, SERIES_KEY], series=F.col("record")[SERIES_KEY],
                        var="rate_month", value="exchange_rate")
    return long.select(F.col("__series").alias("currency_pair"), "rate_month", "exchange_rate",
                       _run_ts(run_ts).alias("ingested_at"))


def read_trade_pages(spark: SparkSession, imports_paths, exports_paths, run_ts=None,
                     page_size: int | None = None) -> DataFrame:
    """Import and export record pages -> bronze_trade_raw.

    The two datasets name their series column differently; each record's
    series is taken from whichever name it carries, so the two spellings
    never meet as two columns. ``page_size`` as in ``read_fx_pages``.
    """
    return trade_rows(_records(spark, imports_paths, IMPORTS, page_size)
                      .unionByName(_records(spark, exports_paths, EXPORTS, page_size)), run_ts)


def trade_rows(recs: DataFrame, run_ts=None) -> DataFrame:
    """Tagged records (record map, trade_type) -> bronze_trade_raw rows."""
    series = F.coalesce(F.col("record")[SERIES_KEY], F.col("record")[SERIES_KEY_ALT])
    long = melt_records(recs, id_keys=[RECORD_ID, SERIES_KEY, SERIES_KEY_ALT], series=series,
                        var="trade_month", value="trade_value_sgd_million", keep=["trade_type"])
    return long.select(F.col("__series").alias("commodity_category"), "trade_type", "trade_month",
                       "trade_value_sgd_million", _run_ts(run_ts).alias("ingested_at"))


def with_audit_columns(df: DataFrame, *, source_api: str, batch_id: str | None = None,
                       loaded_at=None) -> DataFrame:
    """Opt-in audit columns: load time, source name and a batch id per run.

    ``batch_id`` defaults to one random UUID for the whole run (``uuid()`` is
    per row, so the id is drawn once here instead).
    """
    import uuid

    batch = batch_id or str(uuid.uuid4())
    return df.select("*", _run_ts(loaded_at).alias("loaded_at"),
                     F.lit(source_api).alias("source_api"), F.lit(batch).alias("batch_id"))


def read_export_csv(spark: SparkSession, path: str) -> DataFrame:
    """The serving CSV with its explicit schema (no inference pass)."""
    return spark.read.schema(schemas.EXPORT).option("header", True).option("mode", "FAILFAST").csv(path)


def list_tables(spark: SparkSession) -> DataFrame:
    """Tables and views in the current catalog (``SHOW TABLES``)."""
    return spark.sql("SHOW TABLES")
