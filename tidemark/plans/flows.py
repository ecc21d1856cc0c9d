"""End-to-end flows: load landed files into bronze; build, test and export."""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.dates import COMPACT_MONTH, SPACED_MONTH
from ..operators import load_stats, quality
from ..operators.snapshots import latest_snapshot
from ..sinks import tables as sinks
from ..sinks.releases import Draft, Releases
from ..sources import landed
from . import marts, staging
from .export import export_projection

BRONZE_TABLES = {"bronze_cpi_raw": schemas.BRONZE_CPI, "bronze_fx_raw": schemas.BRONZE_FX,
                 "bronze_trade_raw": schemas.BRONZE_TRADE}


# Per bronze table: its category, month and value, and the layout of its months.
MEASURED = {"bronze_cpi_raw": ("cpi_category", "time_period", "cpi_value", SPACED_MONTH),
            "bronze_fx_raw": ("currency_pair", "rate_month", "exchange_rate", COMPACT_MONTH),
            "bronze_trade_raw": ("commodity_category", "trade_month", "trade_value_sgd_million", COMPACT_MONTH)}
LOADS = "load_stats"


def table_metrics(table: str) -> list:
    """What the write of a bronze table observes. Months are parsed (text order is
    alphabetical), so a malformed month also fails the load here."""
    category, month, value, fmt = MEASURED[table]
    return load_stats.load_metrics(category, F.to_date(F.col(month), fmt), value)


def load_sources(spark: SparkSession, *, cpi_files, fx_files, imports_files, exports_files,
                 bronze_dir: str, run_ts=None, page_size: int | None = None) -> dict[str, dict]:
    """Entry 1: landed files -> bronze tables. CPI is a re-runnable daily
    append; FX and trade are fully replaced. Returns, per table, the rows
    written, nulls and the month range, observed during the write; these and the
    categories are kept per load (``load_history``). With ``page_size``, an
    FX or trade download whose pages are not all there fails before its table is touched."""
    def path(table):
        return os.path.join(bronze_dir, table)

    stats = {}
    cpi = landed.read_cpi_payload(spark, cpi_files, run_ts)
    stats["bronze_cpi_raw"] = sinks.append_daily(
        cpi, path("bronze_cpi_raw"), sort_by=("cpi_category", "time_period"), metrics=table_metrics("bronze_cpi_raw"), run_ts=run_ts)
    fx = landed.read_fx_pages(spark, fx_files, run_ts, page_size)
    stats["bronze_fx_raw"] = sinks.replace_table(
        fx, path("bronze_fx_raw"), sort_by=("currency_pair", "rate_month"), metrics=table_metrics("bronze_fx_raw"))
    trade = landed.read_trade_pages(spark, imports_files, exports_files, run_ts, page_size)
    stats["bronze_trade_raw"] = sinks.replace_table(
        trade, path("bronze_trade_raw"), sort_by=("trade_type", "commodity_category", "trade_month"),
        metrics=table_metrics("bronze_trade_raw"))
    record_load(spark, path(LOADS), str(run_ts or _dt.datetime.now(_dt.timezone.utc)), stats)
    return {t: {k: v for k, v in s.items() if k not in ("named", "sketch", "tracked")} for t, s in stats.items()}


def record_load(spark: SparkSession, path: str, load_id: str, observed: dict[str, dict]) -> None:
    """Keep what the writes of a load observed; a load that is run again replaces its rows."""
    known = Releases(spark, path).release()
    stored = Releases(spark, path).read(sinks.ROWS, known) if known else None
    sinks.replace_table(load_stats.with_loads(stored, load_stats.load_rows(spark, load_id, observed)), path)


def load_history(spark: SparkSession, bronze_dir: str) -> DataFrame:
    """Per bronze table, over all loads: loads, rows, nulls, months and categories, from the kept
    statistics alone (``load_stats.merged_stats``)."""
    return load_stats.merged_stats(sinks.read_replaced(spark, os.path.join(bronze_dir, LOADS)))


def silver_models(bronze: dict[str, DataFrame], *, dedupe_cpi: bool = True) -> dict[str, DataFrame]:
    """Bronze frames -> the three silver models (lazy).

    ``dedupe_cpi`` keeps the latest load per (category, month): the CPI
    table keeps every earlier load day, which would otherwise double months.
    """
    cpi = bronze["bronze_cpi_raw"]
    if dedupe_cpi:
        cpi = latest_snapshot(cpi, ["cpi_category", "time_period"])
    return {"stg_cpi": staging.stg_cpi(cpi), "stg_fx": staging.stg_fx(bronze["bronze_fx_raw"]),
            "stg_trade": staging.stg_trade(bronze["bronze_trade_raw"])}


def draft_models(draft: Draft, bronze: dict[str, DataFrame], *, calendar_end: str | None = None,
                 dedupe_cpi: bool = True) -> dict[str, DataFrame]:
    """Write silver, calendar, fact and export into a draft, each from the stored tables
    before it, with the declared tests answered by the writes."""
    def write(name: str, df: DataFrame, **kw) -> DataFrame:
        return draft.write(name, df, checks=[c for c in quality.MODEL_CHECKS if c.model == name], **kw)

    out = {}
    for name, df in silver_models(bronze, dedupe_cpi=dedupe_cpi).items():
        out[name] = write(name, df)
    out["dim_calendar"] = write("dim_calendar", marts.calendar_upto(out["stg_cpi"], end=calendar_end))
    out["fct_sg_macro_monthly"] = write("fct_sg_macro_monthly", marts.fct_macro_monthly(
        out["stg_cpi"], out["stg_fx"], out["stg_trade"], out["dim_calendar"]))
    out["macro_monthly"] = write("macro_monthly", export_projection(out["fct_sg_macro_monthly"]), format="csv",
                                 sort_by=["period_date"], files=1)
    return out


def build_and_export(spark: SparkSession, *, bronze_dir: str, gold_dir: str, export_path: str,
                     calendar_end: str | None = None, dedupe_cpi: bool = True) -> DataFrame:
    """Entry 2: bronze -> silver -> gold, data tests, then the export.

    All tables are written to a draft of the release at ``gold_dir``; the tests run
    within these writes. A failure raises, and the release before stays the one that
    readers see; else one rename publishes silver, calendar, fact and export
    together (``read_gold``). The export is then copied to ``export_path``.
    """
    bronze = {t: sinks.read_bronze(spark, os.path.join(bronze_dir, t), schema) for t, schema in BRONZE_TABLES.items()}
    draft = Releases(spark, gold_dir).draft()
    tables = draft_models(draft, bronze, calendar_end=calendar_end, dedupe_cpi=dedupe_cpi)
    draft.publish()
    sinks.write_export_csv(tables["macro_monthly"], export_path)
    return draft.report()


def read_gold(spark: SparkSession, gold_dir: str, table: str) -> DataFrame:
    """A table of the current release of ``build_and_export``."""
    return Releases(spark, gold_dir).read(table)


def run_on_benchmark_tables(spark: SparkSession, sf_dir: str, work_dir: str,
                            calendar_end: str | None = None) -> dict[str, float]:
    """The whole pipeline on the benchmark tables, end to end, with the real
    sinks: stand-in bronze tables written (daily append for CPI, replace for
    FX and trade), then silver, gold, the data-test gate and the CSV export.
    Returns seconds per step. ``work_dir`` must be shared storage on a cluster.
    """
    import time

    from . import standins

    times = {}
    t0 = time.perf_counter()
    bronze = standins.bronze_tables(spark, sf_dir)
    bronze_dir = os.path.join(work_dir, "bronze")
    # Zone-free stand-in times become the timestamps that bronze declares.
    bronze = {t: df.select(*[F.col(f.name).cast(f.dataType) for f in BRONZE_TABLES[t]]) for t, df in bronze.items()}
    sinks.append_daily(bronze["bronze_cpi_raw"], os.path.join(bronze_dir, "bronze_cpi_raw"))
    sinks.replace_table(bronze["bronze_fx_raw"], os.path.join(bronze_dir, "bronze_fx_raw"))
    sinks.replace_table(bronze["bronze_trade_raw"], os.path.join(bronze_dir, "bronze_trade_raw"))
    times["load_bronze"] = time.perf_counter() - t0
    t1 = time.perf_counter()
    build_and_export(spark, bronze_dir=bronze_dir, gold_dir=os.path.join(work_dir, "gold"),
                     export_path=os.path.join(work_dir, "export"), calendar_end=calendar_end)
    times["build_test_export"] = time.perf_counter() - t1
    times["total"] = time.perf_counter() - t0
    return times
