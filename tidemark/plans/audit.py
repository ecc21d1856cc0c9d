"""Audit queries over the bronze, silver and gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import COMPACT_MONTH, SPACED_MONTH
from ..functions.labels import EXPORTS, HEADLINE_CPI, IMPORT_TOTAL, IMPORTS, USD, balance_status
from ..functions.numeric import exact_avg, round_to
from ..operators.aggregates import coverage, latest_rows, table_profile, top_k
from ..operators.reshape import union_all


def bronze_profiles(cpi: DataFrame, fx: DataFrame, trade: DataFrame) -> DataFrame:
    """Rows, categories, month range and null values of each bronze table."""
    return union_all(
        table_profile(cpi, table="bronze_cpi_raw", category="cpi_category", month="time_period",
                      value="cpi_value", month_format=SPACED_MONTH),
        table_profile(fx, table="bronze_fx_raw", category="currency_pair", month="rate_month",
                      value="exchange_rate", month_format=COMPACT_MONTH),
        table_profile(trade, table="bronze_trade_raw", category="commodity_category",
                      month="trade_month", value="trade_value_sgd_million",
                      month_format=COMPACT_MONTH))


def top_trade_categories(trade: DataFrame, trade_type: str, k: int = 5) -> DataFrame:
    """Top ``k`` commodity lines of one direction by summed value (0 digits)."""
    return top_k(trade, ["commodity_category"], "trade_value_sgd_million", k,
                 name="total_sgd_million", digits=0, where=F.col("trade_type") == trade_type)


def silver_samples(stg_cpi: DataFrame, stg_fx: DataFrame, stg_trade: DataFrame) -> dict[str, DataFrame]:
    """Latest 6 headline CPI rows, latest 6 USD rows, latest 8 total lines."""
    totals = (IMPORT_TOTAL, "Total Merchandise Exports")
    return {
        "cpi": latest_rows(stg_cpi.where(F.col("cpi_category") == HEADLINE_CPI), "period_date", 6)
        .select("cpi_category", "period_date", "cpi_value", "cpi_mom_change", "cpi_yoy_pct"),
        "fx": latest_rows(stg_fx.where(F.col("currency_pair") == USD), "period_date", 6)
        .select("currency_pair", "period_date", "sgd_per_foreign_unit", "foreign_units_per_sgd"),
        "trade": latest_rows(stg_trade.where(F.col("commodity_category").isin(*totals)), "period_date", 8,
                             tie_break=["trade_type", "commodity_category"])
        .select("trade_type", "commodity_category", "period_date", "trade_value_sgd_million"),
    }


def gold_coverage(fact: DataFrame) -> DataFrame:
    return coverage(fact, "period_date", ["usd_sgd_rate", "total_imports_sgd"]).select(
        "total_rows", "earliest", "latest", F.col("usd_sgd_rate_rows").alias("fx_rows"),
        F.col("total_imports_sgd_rows").alias("trade_rows"))


def latest_complete(fact: DataFrame, n: int = 6) -> DataFrame:
    return latest_rows(fact, "period_date", n, present=["usd_sgd_rate"]).select(
        "period_date", "cpi_value", "cpi_yoy_pct", "usd_sgd_rate", "total_imports_sgd",
        "total_exports_sgd", "trade_balance_sgd")


def balance_check(fact: DataFrame, n: int = 6) -> DataFrame:
    """Latest months with exports and their surplus/deficit label (null reads deficit)."""
    return latest_rows(fact, "period_date", n, present=["total_exports_sgd"]).select(
        "period_date", "total_exports_sgd", "total_imports_sgd", "trade_balance_sgd",
        balance_status("trade_balance_sgd").alias("balance_status"))


def labelled_balance(fact: DataFrame) -> DataFrame:
    """Every month with its surplus/deficit label."""
    return fact.select("period_date", "total_imports_sgd", "trade_balance_sgd",
                       balance_status("trade_balance_sgd").alias("balance_status"))


def yearly_averages(fact: DataFrame, years: int = 10) -> DataFrame:
    """Yearly means over months with both rate and imports, latest ``years`` years."""
    src = fact.where(F.col("usd_sgd_rate").isNotNull() & F.col("total_imports_sgd").isNotNull())
    return (src.groupBy("period_year")
            .agg(round_to(exact_avg("cpi_yoy_pct"), 2).alias("avg_cpi_yoy_pct"),
                 round_to(exact_avg("usd_sgd_rate"), 4).alias("avg_usd_sgd"),
                 round_to(exact_avg("total_imports_sgd"), 0).alias("avg_monthly_imports"))
            .orderBy(F.col("period_year").desc()).limit(years))


def category_catalogue(trade: DataFrame) -> DataFrame:
    return trade.select("trade_type", "commodity_category").distinct()


def rows_by_trade_type(trade: DataFrame) -> DataFrame:
    return trade.groupBy("trade_type").agg(F.count(F.lit(1)).alias("rows"))


def trade_sample(trade: DataFrame, trade_type: str = EXPORTS, n: int = 5) -> DataFrame:
    """Unordered sample of ``n`` rows of one direction (``limit`` without order)."""
    return (trade.where(F.col("trade_type") == trade_type)
            .select("trade_type", "commodity_category", "trade_month", "trade_value_sgd_million")
            .limit(n))


def load_categories(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per table, the number and the names of its categories (one short list per table)."""
    return union_all(*[df.agg(F.sort_array(F.collect_set(c)).alias("found")).select(
        F.lit(name).alias("table_name"), F.size("found").cast("bigint").alias("categories"),
        F.array_join("found", ", ").alias("names")) for name, (df, c) in tables.items()])


def quality_score(report: DataFrame, profiles: DataFrame) -> DataFrame:
    """Tests, passing, pass rate, and the number of sources that hold rows."""
    monitored = profiles.select(F.count_if(F.col("row_count") > 0)).scalar()
    counted = report.agg(F.count(F.lit(1)).alias("tests"), F.count_if(F.col("status") == "PASS").alias("passing"))
    return counted.select("tests", "passing", round_to(F.col("passing") * 100.0 / F.col("tests"), 1).alias("pass_rate"),
                          monitored.alias("sources_monitored"))


# How the pipeline page names each source.
SOURCE_LABELS = (
    ("bronze_cpi_raw", "SingStat", "CPI by category", "CPI"),
    ("bronze_fx_raw", "MAS", "SGD exchange rates", "FX Rates"),
    ("bronze_trade_raw", "Enterprise SG", "Merchandise trade", "Trade"),
)


def source_stats(profiles: DataFrame) -> DataFrame:
    """Per source: dataset, frequency, first year, rows and categories, all
    measured from the bronze profiles (one row per table)."""
    label = None
    for table, source, dataset, _short in SOURCE_LABELS:
        cond = F.col("table_name") == table
        pair = F.struct(F.lit(source).alias("source"), F.lit(dataset).alias("dataset"))
        label = F.when(cond, pair) if label is None else label.when(cond, pair)
    return profiles.select(label.alias("l"), "*").select(
        "l.source", "l.dataset", F.lit("Monthly").alias("frequency"),
        F.year("first_month").cast("string").alias("since"),
        F.col("row_count").alias("rows"), "categories")


def rows_by_source(profiles: DataFrame) -> DataFrame:
    short = None
    for table, _source, _dataset, name in SOURCE_LABELS:
        cond = F.col("table_name") == table
        short = F.when(cond, F.lit(name)) if short is None else short.when(cond, F.lit(name))
    return profiles.select(short.alias("source"), F.col("row_count").alias("rows"))


def test_results(report: DataFrame) -> DataFrame:
    """The data-test report in the page's shape: 'test — column', model, status, rows checked."""
    return report.select(F.concat_ws(" \u2014 ", "test", "column_name").alias("test_name"),
                         "model", "status", "rows_checked")


LEVELS = ("line", "type", "category", "table")   # by grouping id: neither column is summed over, the second, the first, both


def trade_report(trade: DataFrame, month_format: str = COMPACT_MONTH) -> DataFrame:
    """All trade audits from one scan: a row per line, type, category and for the table.

    level, trade_type, commodity_category, row_count, null_values,
    total_sgd_million (0 digits), first_month, last_month, and the place of a line
    among those of its type by total (ties by name; 0 on other levels). Rows are first summed per line,
    with partial sums per task; grouping sets then run over the lines.
    """
    month = F.to_date("trade_month", month_format)
    value = F.col("trade_value_sgd_million")
    lines = trade.groupBy("trade_type", "commodity_category").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(value.isNull()).alias("nulls"),
        F.sum(value.cast("decimal(38,6)")).alias("total"), F.min(month).alias("first"), F.max(month).alias("last"))
    sets = [["trade_type", "commodity_category"], ["trade_type"], ["commodity_category"], []]
    levels = lines.groupingSets(sets, "trade_type", "commodity_category").agg(
        F.grouping_id().alias("id"), F.sum("n").alias("row_count"), F.sum("nulls").alias("null_values"),
        round_to(F.sum("total").cast("double"), 0).alias("total_sgd_million"),
        F.min("first").alias("first_month"), F.max("last").alias("last_month"))
    place = F.row_number().over(Window.partitionBy("id", "trade_type").orderBy(
        F.col("total_sgd_million").desc_nulls_last(), F.col("commodity_category").asc_nulls_last()))
    named = F.element_at(F.array(*[F.lit(level) for level in LEVELS]), (F.col("id") + 1).cast("int"))
    # Of an empty table there is nothing to report, not even a total.
    return levels.where(F.col("row_count").isNotNull()).select(
        named.alias("level"), "trade_type", "commodity_category", "row_count", "null_values", "total_sgd_million",
        "first_month", "last_month", F.when(F.col("id") == 0, place).otherwise(0).cast("bigint").alias("place"))


def of_report(report: DataFrame, k: int = 5) -> dict[str, DataFrame]:
    """The single audits from the rows of ``trade_report``."""
    line, by_type = report.where(F.col("level") == "line"), report.where(F.col("level") == "type")
    top = {f"top_{t}": line.where((F.col("trade_type") == t) & (F.col("place") <= k)).select("commodity_category", "total_sgd_million")
           for t in (IMPORTS, EXPORTS)}
    figures = report.agg(*[F.max(F.when(F.col("level") == "table", F.col(c))).alias(c)
                           for c in ("row_count", "first_month", "last_month", "null_values")],
                         F.count_if((F.col("level") == "category") & F.col("commodity_category").isNotNull()).alias("categories"))
    return {**top, "catalogue": line.select("trade_type", "commodity_category"),
            "rows_by_trade_type": by_type.select("trade_type", F.col("row_count").alias("rows")),
            "profile": figures.select(F.lit("bronze_trade_raw").alias("table_name"),
                                      F.coalesce("row_count", F.lit(0)).alias("row_count"), "categories", "first_month", "last_month",
                                      F.coalesce("null_values", F.lit(0)).alias("null_values"))}
