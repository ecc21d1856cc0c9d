"""Gold models: calendar dimension and the monthly macro fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import CNY, EXPORTS, HEADLINE_CPI, IMPORT_TOTAL, IMPORTS, USD
from ..functions.numeric import exact_sum, nullif_zero, round_to
from ..operators.timeseries import dim_calendar_of, month_series, month_spine_of

FACT_START = "1999-01-01"

FACT_COLUMNS = (
    "period_date", "period_year", "period_month", "cpi_value", "cpi_mom_change", "cpi_yoy_pct",
    "usd_sgd_rate", "sgd_strength_vs_usd", "cny_sgd_rate", "total_imports_sgd",
    "total_exports_sgd", "trade_balance_sgd", "trade_openness_ratio", "month_name",
    "month_abbr", "quarter", "sg_trade_season",
)


def dim_calendar(spark: SparkSession, start: str = FACT_START, end: str | None = None) -> DataFrame:
    """Month spine from ``start`` to ``end`` (default: today) with names,
    quarter and trade season."""
    return dim_calendar_of(month_series(spark, start, end))


def calendar_upto(series: DataFrame, date_col: str = "period_date", start: str = FACT_START,
                  end: str | None = None) -> DataFrame:
    """Calendar from ``start`` to the last month of a series, or to ``end``."""
    if end is not None:
        return dim_calendar(series.sparkSession, start, end)
    return dim_calendar_of(month_spine_of(series, date_col, start=start))


def _derived(imp: str, exp: str):
    balance = round_to(F.col(exp) - F.col(imp), 0).alias("trade_balance_sgd")
    openness = round_to((F.col(imp) + F.col(exp)) / nullif_zero(imp), 2).alias("trade_openness_ratio")
    return balance, openness


def _headline(stg_cpi: DataFrame, headline: str, start: str) -> DataFrame:
    # The category filter moves below the lag window (it is the window's
    # partition key); the date filter must stay above it, so January of the
    # first year keeps its base from the year before.
    return (stg_cpi.where((F.col("cpi_category") == headline) & (F.col("period_date") >= F.lit(start).cast("date")))
            .select("period_date", "period_year", "period_month", "cpi_value",
                    "cpi_mom_change", "cpi_yoy_pct"))


def _with_calendar(joined: DataFrame, calendar: DataFrame, start: str) -> DataFrame:
    cal = calendar.select("period_date", "month_name", "month_abbr", "quarter", "sg_trade_season")
    return (joined.join(cal, "period_date", "left")
            .where(F.col("period_date") >= F.lit(start).cast("date"))
            .select(*FACT_COLUMNS))


def fct_macro_monthly(stg_cpi: DataFrame, stg_fx: DataFrame, stg_trade: DataFrame,
                      calendar: DataFrame, *, headline: str = HEADLINE_CPI, usd: str = USD,
                      cny: str = CNY, import_total: str = IMPORT_TOTAL,
                      start: str = FACT_START) -> DataFrame:
    """The monthly fact, as the SQL model: headline CPI rows left-joined to
    the USD and CNY rates, the import total line and the summed export lines,
    then to the calendar.

    Every right side is month grain (one row per month), so each is small and
    AQE turns the joins into broadcast hash joins from the measured size; the
    import total is not aggregated, so a duplicate month there fans out, as
    in the model (the ``unique`` data test catches it).
    """
    cpi = _headline(stg_cpi, headline, start)
    usd_side = (stg_fx.where(F.col("currency_pair") == usd)
                .select("period_date", F.col("sgd_per_foreign_unit").alias("usd_sgd_rate"),
                        F.col("foreign_units_per_sgd").alias("sgd_strength_vs_usd")))
    cny_side = (stg_fx.where(F.col("currency_pair") == cny)
                .select("period_date", F.col("sgd_per_foreign_unit").alias("cny_sgd_rate")))
    imports = (stg_trade.where((F.col("commodity_category") == import_total) & (F.col("trade_type") == IMPORTS))
               .select("period_date", F.col("trade_value_sgd_million").alias("total_imports_sgd")))
    exports = (stg_trade.where(F.col("trade_type") == EXPORTS).groupBy("period_date")
               .agg(exact_sum("trade_value_sgd_million").alias("total_exports_sgd")))
    joined = (cpi.join(usd_side, "period_date", "left")
              .join(cny_side, "period_date", "left")
              .join(imports, "period_date", "left")
              .join(exports, "period_date", "left"))
    joined = joined.select("*", *_derived("total_imports_sgd", "total_exports_sgd"))
    return _with_calendar(joined, calendar, start)


def fct_macro_monthly_one_pass(stg_cpi: DataFrame, stg_fx: DataFrame, stg_trade: DataFrame,
                               calendar: DataFrame, *, headline: str = HEADLINE_CPI,
                               usd: str = USD, cny: str = CNY, import_total: str = IMPORT_TOTAL,
                               start: str = FACT_START) -> DataFrame:
    """Same rows as ``fct_macro_monthly`` when (series, month) is unique:
    each silver table is read once and turned to columns with conditional
    aggregates, then two month-grain joins instead of four.
    """
    cpi = _headline(stg_cpi, headline, start)
    is_usd = F.col("currency_pair") == usd
    is_cny = F.col("currency_pair") == cny
    fx = (stg_fx.where(F.col("currency_pair").isin(usd, cny)).groupBy("period_date")
          .agg(F.max(F.when(is_usd, F.col("sgd_per_foreign_unit"))).alias("usd_sgd_rate"),
               F.max(F.when(is_usd, F.col("foreign_units_per_sgd"))).alias("sgd_strength_vs_usd"),
               F.max(F.when(is_cny, F.col("sgd_per_foreign_unit"))).alias("cny_sgd_rate")))
    is_imp = (F.col("trade_type") == IMPORTS) & (F.col("commodity_category") == import_total)
    is_exp = F.col("trade_type") == EXPORTS
    trade = (stg_trade.where(is_imp | is_exp).groupBy("period_date")
             .agg(F.max(F.when(is_imp, F.col("trade_value_sgd_million"))).alias("total_imports_sgd"),
                  exact_sum(F.when(is_exp, F.col("trade_value_sgd_million"))).alias("total_exports_sgd")))
    joined = cpi.join(fx, "period_date", "left").join(trade, "period_date", "left")
    joined = joined.select("*", *_derived("total_imports_sgd", "total_exports_sgd"))
    return _with_calendar(joined, calendar, start)
