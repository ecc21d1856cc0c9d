"""Dashboard queries over the serving projection (``macro_monthly``).

Each is a function ``(export_df) -> DataFrame``. Rows come back unordered
unless a limit makes order part of the answer; the consumer sorts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import ACTION_LABELS, REGIME_LABELS, SCATTER_LABELS, inflation_band, sourcing_signal
from ..functions.numeric import exact_avg, exact_sum, round_to
from ..operators.aggregates import latest_rows
from ..operators.ordering import with_position

SINCE_YEAR = 2020
HISTORY_FROM = 2010


def latest_with(export: DataFrame, column: str) -> DataFrame:
    """Latest month that has ``column`` (``latest``, ``latest_fx``, ``latest_trade``)."""
    return latest_rows(export, "period_date", 1, present=[column])


def annual_scorecard(export: DataFrame, years: int = 12, *, inflation_name: str = "avg_inflation",
                     imports_name: str = "imports_sgd_bn") -> DataFrame:
    """Yearly mean inflation, USD rate, summed imports, regime and action for
    the latest ``years`` years with both rate and imports."""
    src = export.where(F.col("usd_sgd").isNotNull() & F.col("imports_sgd_bn").isNotNull())
    yearly = src.groupBy("period_year").agg(exact_avg("cpi_yoy_pct").alias("__infl"),
                                            exact_avg("usd_sgd").alias("__usd"),
                                            exact_sum("imports_sgd_bn").alias("__imp"))
    top = yearly.orderBy(F.col("period_year").desc()).limit(years)
    return top.select(
        F.col("period_year").cast("int").alias("year"),
        round_to(F.col("__infl") * 100, 1).alias(inflation_name),
        round_to(F.col("__usd"), 4).alias("usd_sgd"),
        round_to(F.col("__imp"), 0).alias(imports_name),
        inflation_band("__infl", REGIME_LABELS).alias("regime"),
        inflation_band("__infl", ACTION_LABELS).alias("prescribed_action"))


def sourcing_case(export: DataFrame, since_year: int = SINCE_YEAR) -> DataFrame:
    """USD and CNY budgets and the sourcing signal for months since ``since_year``."""
    return (export.where(F.col("usd_sgd").isNotNull() & F.col("cny_sgd").isNotNull()
                         & (F.col("period_year") >= since_year))
            .select("period_date",
                    round_to(F.col("usd_sgd"), 4).alias("usd_sgd"),
                    round_to(F.col("cny_sgd"), 4).alias("cny_sgd"),
                    round_to(F.col("ge_usd_budget_m"), 1).alias("ge_usd_m"),
                    round_to(F.col("mindray_cny_budget_m"), 0).alias("mindray_cny_m"),
                    sourcing_signal("usd_sgd").alias("signal")))


def inflation_history(export: DataFrame, since_year: int | None = HISTORY_FROM,
                      name: str = "inflation") -> DataFrame:
    """Monthly inflation in percent (``inflation_only``; ``cpi_history`` with no year bound)."""
    cond = F.col("cpi_yoy_pct").isNotNull()
    if since_year is not None:
        cond = cond & (F.col("period_year") >= since_year)
    return export.where(cond).select("period_date", round_to(F.col("cpi_yoy_pct") * 100, 2).alias(name))


def fx_history(export: DataFrame, since_year: int | None = None) -> DataFrame:
    """Monthly USD, CNY and cross rate (``fx_history``); ``fx_only`` is ``fx_rate_history``."""
    cond = F.col("usd_sgd").isNotNull()
    if since_year is not None:
        cond = cond & (F.col("period_year") >= since_year)
    return export.where(cond).select("period_date", round_to(F.col("usd_sgd"), 4).alias("usd_sgd"),
                                     round_to(F.col("cny_sgd"), 4).alias("cny_sgd"),
                                     round_to(F.col("usd_cny_ratio"), 2).alias("usd_cny_ratio"))


def fx_rate_history(export: DataFrame, since_year: int = HISTORY_FROM) -> DataFrame:
    return (export.where(F.col("usd_sgd").isNotNull() & (F.col("period_year") >= since_year))
            .select("period_date", round_to(F.col("usd_sgd"), 4).alias("fx_rate")))


def trade_history(export: DataFrame) -> DataFrame:
    return (export.where(F.col("imports_sgd_bn").isNotNull())
            .select("period_date", round_to(F.col("imports_sgd_bn"), 1).alias("imports_sgd_bn")))


def log_imports(export: DataFrame) -> DataFrame:
    """Natural log of monthly imports; non-positive months are left out first."""
    imp = F.col("imports_sgd_bn")
    return (export.where(imp.isNotNull() & (imp > 0))
            .select("period_date", round_to(F.ln(imp), 3).alias("imports_log")))


def scatter_regime(export: DataFrame) -> DataFrame:
    """USD rate against inflation with the inflation band of each month."""
    return (export.where(F.col("usd_sgd").isNotNull() & F.col("cpi_yoy_pct").isNotNull())
            .select("period_date", round_to(F.col("usd_sgd"), 4).alias("usd_sgd"),
                    round_to(F.col("cpi_yoy_pct") * 100, 2).alias("cpi_inflation"),
                    inflation_band("cpi_yoy_pct", SCATTER_LABELS).alias("inflation_regime")))


def in_order(series: DataFrame) -> DataFrame:
    """A monthly series in ascending order, its position as a column. Positions are
    counted within ranges of the months (see ``ordering.with_position``), at any grain."""
    return with_position(series, ["period_date"]).orderBy("position")


def series_history(export: DataFrame) -> DataFrame:
    """The three signals side by side per month, rounded as the history
    charts show them, for months that have at least one of them."""
    infl, usd, imp = F.col("cpi_yoy_pct"), F.col("usd_sgd"), F.col("imports_sgd_bn")
    return (export.where(infl.isNotNull() | usd.isNotNull() | imp.isNotNull())
            .select("period_date", round_to(infl * 100, 2).alias("inflation"),
                    round_to(usd, 4).alias("usd_sgd"), round_to(imp, 1).alias("imports_sgd_bn")))
