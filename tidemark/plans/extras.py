"""Operators the project's documentation describes beyond its SQL models."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import HEADLINE_CPI
from ..functions.numeric import exact_avg, exact_sum, round_to


def annual_summary(fact: DataFrame) -> DataFrame:
    """Yearly average USD rate and CPI and total trade balance."""
    return (fact.groupBy(F.year("period_date").alias("year"))
            .agg(round_to(exact_avg("usd_sgd_rate"), 4).alias("avg_usd_sgd"),
                 round_to(exact_avg("cpi_value"), 3).alias("avg_cpi"),
                 exact_sum("trade_balance_sgd").alias("total_trade_balance")))


def annual_balance(fact: DataFrame) -> DataFrame:
    """Yearly trade balance, imports and exports."""
    return (fact.groupBy("period_year")
            .agg(exact_sum("total_exports_sgd").alias("exports_sgd"),
                 exact_sum("total_imports_sgd").alias("imports_sgd"),
                 exact_sum("trade_balance_sgd").alias("trade_balance_sgd")))


def category_breakdown(stg_cpi: DataFrame, categories: Mapping[str, str],
                       measure: str = "cpi_yoy_pct") -> DataFrame:
    """One row per month, one column per listed category.

    ``pivot`` with an explicit value list: no extra job to discover values,
    and the output width is fixed by the caller, not by the data.
    """
    wide = (stg_cpi.where(F.col("cpi_category").isin(*categories))
            .groupBy("period_date").pivot("cpi_category", list(categories)).agg(F.max(measure)))
    return wide.select("period_date", *[F.col(f"`{k}`").alias(v) for k, v in categories.items()])


def rate_correlation(stg_fx: DataFrame, stg_cpi: DataFrame, headline: str = HEADLINE_CPI,
                     digits: int = 4) -> DataFrame:
    """Pearson correlation of each currency's rate with headline inflation
    over the months both have. The CPI side is month grain, so the join is a
    month-keyed lookup; the correlation is a two-phase aggregate per currency."""
    infl = (stg_cpi.where((F.col("cpi_category") == headline) & F.col("cpi_yoy_pct").isNotNull())
            .select("period_date", "cpi_yoy_pct"))
    joined = stg_fx.select("currency_pair", "period_date", "sgd_per_foreign_unit").join(infl, "period_date")
    return (joined.groupBy("currency_pair")
            .agg(F.count(F.lit(1)).alias("months"),
                 round_to(F.corr("sgd_per_foreign_unit", "cpi_yoy_pct"), digits).alias("correlation")))


def freshness(df: DataFrame, loaded: str, as_of: str, stale_after_days: int = 35,
              keys: tuple[str, ...] = ()) -> DataFrame:
    """Days from the latest load time to ``as_of`` and a stale flag."""
    grouped = df.groupBy(*keys) if keys else df.groupBy()
    return (grouped.agg(F.max(loaded).alias("last_loaded"))
            .select(*keys, "last_loaded",
                    F.datediff(F.lit(as_of).cast("date"), F.to_date("last_loaded")).alias("days_stale"))
            .select("*", (F.col("days_stale") > stale_after_days).alias("is_stale")))
