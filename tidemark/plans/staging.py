"""Silver models: typed, filtered series built from the bronze tables.

Each model is a lazy DataFrame (the views of the SQL project); none sorts its
output, ordering is left to the final consumer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import COMPACT_MONTH, SPACED_MONTH, abbr_of_text, parse_month, year_of_text
from ..functions.labels import EXPORTS, IMPORT_TOTAL, IMPORTS, KEY_CURRENCIES
from ..functions.numeric import nullif_zero, round_to
from ..operators.timeseries import with_changes


def stg_cpi(bronze: DataFrame, *, month_format: str = SPACED_MONTH, ranges: int | None = None) -> DataFrame:
    """bronze_cpi_raw -> stg_cpi.

    Rows with a null value are dropped first, then the month change (3
    digits) and the year-on-year percent (2 digits) are taken per category.
    ``ranges`` as in ``timeseries.with_changes``.
    """
    period = parse_month("time_period", month_format)
    cleaned = (bronze.where(F.col("cpi_value").isNotNull())
               .select("cpi_category",
                       period.alias("period_date"),
                       year_of_text("time_period").alias("period_year"),
                       F.month(period).alias("period_month"),
                       F.col("cpi_value").cast("double").alias("cpi_value"),
                       "ingested_at"))
    return with_changes(cleaned, ["cpi_category"], "period_date", "cpi_value",
                        mom="cpi_mom_change", yoy="cpi_yoy_pct", ranges=ranges)


def stg_fx(bronze: DataFrame, *, currencies: Sequence[str] = KEY_CURRENCIES,
           month_format: str = COMPACT_MONTH) -> DataFrame:
    """bronze_fx_raw -> stg_fx: positive rates of the key currencies, with
    the inverse rate at 4 digits."""
    rate = F.col("exchange_rate").cast("double")
    cleaned = (bronze.where(F.col("exchange_rate").isNotNull() & (F.col("exchange_rate") > 0))
               .select("currency_pair",
                       parse_month("rate_month", month_format).alias("period_date"),
                       year_of_text("rate_month").alias("period_year"),
                       abbr_of_text("rate_month").alias("period_month_abbr"),
                       rate.alias("sgd_per_foreign_unit"),
                       round_to(F.lit(1.0) / nullif_zero(rate), 4).alias("foreign_units_per_sgd"),
                       "ingested_at"))
    return cleaned.where(F.col("currency_pair").isin(*currencies))


def stg_trade(bronze: DataFrame, *, import_total: str = IMPORT_TOTAL,
              month_format: str = COMPACT_MONTH) -> DataFrame:
    """bronze_trade_raw -> stg_trade: the published import total line and
    every export line, positive values only.

    The SQL model is ``imports-total UNION ALL exports`` over one source. The
    two branches select disjoint ``trade_type`` values, so one filter with an
    OR returns the same rows from a single scan.
    """
    keep_imports = (F.col("trade_type") == IMPORTS) & (F.col("commodity_category") == import_total)
    keep_exports = F.col("trade_type") == EXPORTS
    value = F.col("trade_value_sgd_million")
    return (bronze.where(value.isNotNull() & (value > 0) & (keep_imports | keep_exports))
            .select("trade_type", "commodity_category",
                    parse_month("trade_month", month_format).alias("period_date"),
                    year_of_text("trade_month").alias("period_year"),
                    abbr_of_text("trade_month").alias("period_month_abbr"),
                    value.cast("double").alias("trade_value_sgd_million"),
                    "ingested_at"))
