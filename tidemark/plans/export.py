"""Serving projection of the monthly fact (the 17-column ``macro_monthly`` file)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import nullif_zero, round_to

EXPORT_COLUMNS = (
    "period_date", "period_year", "period_month", "month_name", "quarter", "sg_trade_season",
    "cpi_index", "cpi_yoy_pct", "cpi_mom_pct", "usd_sgd", "cny_sgd", "usd_cny_ratio",
    "imports_sgd_bn", "exports_sgd_bn", "trade_balance_sgd_bn", "ge_usd_budget_m",
    "mindray_cny_budget_m",
)


def export_projection(fact: DataFrame, *, unit_divisor: float = 1_000_000.0,
                      budget: float = 50.0) -> DataFrame:
    """Scaled and rounded fact columns.

    Percent -> fraction for the year-on-year change; the month change (index
    points) is divided by 100 as well. Trade values are divided by
    ``unit_divisor`` and named ``*_bn``: the fixed 1,000,000 fits a source in
    thousands; pass another divisor for other units. The budget columns give
    ``budget`` converted at the USD and CNY rates.
    """
    usd, cny = F.col("usd_sgd_rate"), F.col("cny_sgd_rate")
    div = F.lit(float(unit_divisor))
    return fact.select(
        "period_date", "period_year", F.col("period_month").cast("int").alias("period_month"),
        "month_name", "quarter", "sg_trade_season",
        round_to(F.col("cpi_value"), 1).alias("cpi_index"),
        round_to(F.col("cpi_yoy_pct") / 100.0, 4).alias("cpi_yoy_pct"),
        round_to(F.col("cpi_mom_change") / 100.0, 5).alias("cpi_mom_pct"),
        round_to(usd, 4).alias("usd_sgd"),
        round_to(cny, 4).alias("cny_sgd"),
        round_to(usd / nullif_zero(cny), 2).alias("usd_cny_ratio"),
        round_to(F.col("total_imports_sgd") / div, 2).alias("imports_sgd_bn"),
        round_to(F.col("total_exports_sgd") / div, 2).alias("exports_sgd_bn"),
        round_to(F.col("trade_balance_sgd") / div, 2).alias("trade_balance_sgd_bn"),
        # stg_fx keeps only positive rates, so the USD divisor cannot be 0 here.
        round_to(F.lit(float(budget)) / usd, 1).alias("ge_usd_budget_m"),
        round_to(F.lit(float(budget)) / nullif_zero(cny), 0).alias("mindray_cny_budget_m"),
    )
