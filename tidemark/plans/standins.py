"""Bronze-shaped inputs derived from the benchmark tables.

The landed sources (a CPI payload, FX and trade record pages) are not part of
the benchmark data. These adapters derive frames of the same shape from the
benchmark tables with Spark aggregations, so the real models run unchanged on
inputs whose size grows with the tables:

* ``orders``   -> CPI series: one category per order priority plus a headline
  category over all orders; value = monthly sum of ``o_totalprice``.
* ``lineitem`` -> FX series: one currency per return flag; rate = 1 + 10 x the
  monthly mean of ``l_tax`` (about 1.4, so every sourcing band is reached).
* ``lineitem`` -> trade lines: line status O = imports, F = exports; one
  commodity line per return flag, plus the published-total line for imports;
  value = monthly sum of ``l_extendedprice``.

Each table is scanned once, with map-side partial aggregation, into a
month-grain aggregate of at most (categories x months) rows; month text is
formatted per group, not per row, and money is summed as integer cents.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import COMPACT_MONTH, SPACED_MONTH, month_start, month_text
from ..functions.labels import EXPORTS, HEADLINE_CPI, IMPORT_TOTAL, IMPORTS
from ..functions.numeric import round_to
from ..session import table_path

# Fixed values of the stand-in mapping.
RUN_TS = _dt.datetime(2026, 1, 1, 0, 0, 0)
FLAG_CURRENCY = (("A", "US Dollar"), ("N", "Renminbi"), ("R", "Swiss Franc"))
STATUS_TRADE_TYPE = (("O", IMPORTS), ("F", EXPORTS))
MONEY_SCALE = 2


# Column types of the benchmark tables this module reads.
# Declaring them skips the footer-reading job that schema inference runs.
TABLE_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
              "props STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
}


def _audit_ts(run_ts):
    """The run's audit time as a zone-free timestamp (TIMESTAMP_NTZ), so the
    stand-in tables read the same in any session time zone."""
    return F.lit(run_ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(table_path(sf_dir, name))


def _map_values(c, pairs, default=None):
    out = None
    for key, label in pairs:
        cond = F.col(c) == key
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default) if default is not None else F.col(c))


def cents(c, scale: int = MONEY_SCALE):
    """Money as an exact integer count of 1/10^scale units (``rint``, long).

    Summing longs is exact, order-independent and runs on the fast long
    aggregation path; the sum divided by 10^scale equals the decimal sum.
    """
    return F.rint(F.col(c) * float(10 ** scale)).cast("long")


def orders_monthly(orders: DataFrame) -> DataFrame:
    """(priority, month) -> summed order value in cents. One scan of ``orders``,
    map-side partial aggregation, month kept as a DATE (text comes later)."""
    return (orders.groupBy(F.col("o_orderpriority").alias("cpi_category"),
                           month_start("o_orderdate").alias("month"))
            .agg(F.sum(cents("o_totalprice")).alias("cents")))


def orders_monthly_by_status(orders: DataFrame) -> DataFrame:
    """(priority, month, order status) -> cents: one scan of ``orders`` from
    which several simulated load days are derived (see ``orders_load``)."""
    return (orders.groupBy(F.col("o_orderpriority").alias("cpi_category"),
                           month_start("o_orderdate").alias("month"), "o_orderstatus")
            .agg(F.sum(cents("o_totalprice")).alias("cents")))


def orders_load(by_status: DataFrame, *, status: str | None = None,
                before: str | None = None) -> DataFrame:
    """A (priority, month) -> cents frame like ``orders_monthly`` for the
    orders of one status and/or months before a date (integer cents, so
    re-summing is exact)."""
    src = by_status
    if status is not None:
        src = src.where(F.col("o_orderstatus") == status)
    if before is not None:
        src = src.where(F.col("month") < F.lit(before).cast("date"))
    return src.groupBy("cpi_category", "month").agg(F.sum("cents").alias("cents"))


def lineitem_monthly(lineitem: DataFrame) -> DataFrame:
    """(flag, status, month) -> tax cents, tax count, price cents: the one
    aggregate of ``lineitem`` both the FX and the trade series derive from."""
    return (lineitem.groupBy("l_returnflag", "l_linestatus", month_start("l_shipdate").alias("month"))
            .agg(F.sum(cents("l_tax")).alias("tax_cents"), F.count("l_tax").alias("tax_n"),
                 F.sum(cents("l_extendedprice")).alias("price_cents")))


def cpi_bronze(orders: DataFrame, run_ts=RUN_TS) -> DataFrame:
    """bronze_cpi_raw shape from the orders table."""
    return cpi_bronze_of(orders_monthly(orders), run_ts)


def cpi_bronze_of(by_priority: DataFrame, run_ts=RUN_TS) -> DataFrame:
    """bronze_cpi_raw shape: cpi_category, time_period ('2024 Jan'), cpi_value, ingested_at.

    The headline category is the sum of the per-priority sums (exact: integer cents).
    """
    headline = (by_priority.groupBy("month").agg(F.sum("cents").alias("cents"))
                .select(F.lit(HEADLINE_CPI).alias("cpi_category"), "month", "cents"))
    both = by_priority.unionByName(headline)
    return both.select("cpi_category", month_text("month", SPACED_MONTH).alias("time_period"),
                       (F.col("cents") / float(10 ** MONEY_SCALE)).alias("cpi_value"),
                       _audit_ts(run_ts).alias("ingested_at"))


def fx_bronze_of(monthly: DataFrame, run_ts=RUN_TS) -> DataFrame:
    """bronze_fx_raw shape: currency_pair, rate_month ('2024Jan'), exchange_rate, ingested_at."""
    by_flag = (monthly.groupBy(_map_values("l_returnflag", FLAG_CURRENCY).alias("currency_pair"), "month")
               .agg(F.sum("tax_cents").alias("tax_cents"), F.sum("tax_n").alias("tax_n")))
    mean_tax = (F.col("tax_cents") / float(10 ** MONEY_SCALE)) / F.col("tax_n")
    return by_flag.select("currency_pair", month_text("month", COMPACT_MONTH).alias("rate_month"),
                          round_to(F.lit(1.0) + mean_tax * 10, 4).alias("exchange_rate"),
                          _audit_ts(run_ts).alias("ingested_at"))


def trade_bronze_of(monthly: DataFrame, run_ts=RUN_TS) -> DataFrame:
    """bronze_trade_raw shape: commodity_category, trade_type, trade_month,
    trade_value_sgd_million, ingested_at. One line per (status, flag, month)
    plus, for imports, the published-total line per month."""
    trade_type = _map_values("l_linestatus", STATUS_TRADE_TYPE)
    lines = monthly.select(F.concat(F.lit("Flag "), F.col("l_returnflag")).alias("commodity_category"),
                           trade_type.alias("trade_type"), "month", "price_cents")
    is_imp = trade_type == IMPORTS
    totals = (monthly.groupBy("month")
              .agg(F.sum(F.when(is_imp, F.col("price_cents"))).alias("price_cents"),
                   F.count_if(is_imp).alias("import_lines"))
              .where(F.col("import_lines") > 0)
              .select(F.lit(IMPORT_TOTAL).alias("commodity_category"), F.lit(IMPORTS).alias("trade_type"),
                      "month", "price_cents"))
    return (lines.unionByName(totals)
            .select("commodity_category", "trade_type",
                    month_text("month", COMPACT_MONTH).alias("trade_month"),
                    (F.col("price_cents") / float(10 ** MONEY_SCALE)).alias("trade_value_sgd_million"),
                    _audit_ts(run_ts).alias("ingested_at")))


def fx_bronze(lineitem: DataFrame, run_ts=RUN_TS) -> DataFrame:
    return fx_bronze_of(lineitem_monthly(lineitem), run_ts)


def trade_bronze(lineitem: DataFrame, run_ts=RUN_TS) -> DataFrame:
    return trade_bronze_of(lineitem_monthly(lineitem), run_ts)


def bronze_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three stand-in bronze tables (uncached; see ``layers.MacroLayers``)."""
    by_priority = orders_monthly(read_table(spark, sf_dir, "orders"))
    monthly = lineitem_monthly(read_table(spark, sf_dir, "lineitem"))
    return {
        "bronze_cpi_raw": cpi_bronze_of(by_priority),
        "bronze_fx_raw": fx_bronze_of(monthly),
        "bronze_trade_raw": trade_bronze_of(monthly),
    }
