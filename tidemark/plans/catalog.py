"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the benchmark tables (through the stand-in bronze frames
or directly), so its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import (COMPACT_MONTH, SPACED_MONTH, abbr_of_text, month_name, month_start, month_text,
                               parse_month, year_of_text)
from ..functions.labels import EXPORTS, HEADLINE_CPI, IMPORTS, KEY_CURRENCIES
from ..functions.numeric import lenient_double, round_to, strict_double, unit_sum
from ..operators import aggregates as A
from ..operators import load_stats
from ..operators import quality as Q
from ..operators import snapshots as S
from ..operators.lookups import attach_attributes
from ..operators.reshape import union_all, unpivot_columns
from ..operators.revisions import changed_rows, touched_rows
from ..operators.timeseries import dim_calendar_of, month_spine_of, with_changes
from ..sinks.releases import Releases
from ..sinks.scratch import scratch_path
from ..sources import landed
from ..sources.pages import page_census, read_page_set
from . import audit, extras, flows, marts, signals, staging, standins, warehouse
from .layers import MacroLayers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def monthly_mom_yoy(spark, sf_dir):
    """stg_cpi: month change and year-on-year percent per category (L1, H1, H2)."""
    return MacroLayers(spark, sf_dir).stg_cpi


@query
def inverse_rate(spark, sf_dir):
    """stg_fx: positive rates of the key currencies with the inverse rate (L2)."""
    return MacroLayers(spark, sf_dir).stg_fx


@query
def totals_union(spark, sf_dir):
    """stg_trade: the import total line and all export lines."""
    return MacroLayers(spark, sf_dir).stg_trade


@query
def macro_fact(spark, sf_dir):
    """fct_sg_macro_monthly as the model: filtered sides and five left joins."""
    return MacroLayers(spark, sf_dir).fact


@query
def macro_fact_one_pass(spark, sf_dir):
    """The same fact with conditional aggregates: two joins instead of four."""
    return MacroLayers(spark, sf_dir).fact_one_pass


@query
def export_projection(spark, sf_dir):
    """The 17-column serving projection of the fact."""
    return MacroLayers(spark, sf_dir).export


# ---------------------------------------------------------------- parsing, spine, reshape

# Stand-in parameters: the benchmark months run 1995-2001, so year bounds
# that the dashboard sets at 2010/2020 are set inside that range here.
STANDIN_SINCE_YEAR = 2000
STANDIN_HISTORY_FROM = 1999


@query
def month_parse(spark, sf_dir):
    """Month text -> date, year, abbreviation, name; orders per month (K1-K6)."""
    orders = standins.read_table(spark, sf_dir, "orders")
    # Grouped by the month itself; text is made per group, not per row.
    counts = (orders.groupBy(month_start("o_orderdate").alias("month")).agg(F.count(F.lit(1)).alias("order_count"))
              .select(month_text("month", COMPACT_MONTH).alias("month_text"), "order_count"))
    d = parse_month("month_text", COMPACT_MONTH)
    return counts.select("month_text", d.alias("period_date"),
                         year_of_text("month_text").alias("period_year"),
                         F.month(d).alias("period_month"),
                         abbr_of_text("month_text").alias("period_month_abbr"),
                         month_name(d).alias("month_name"), "order_count")


@query
def date_spine(spark, sf_dir):
    """Calendar over the months the orders span."""
    orders = standins.read_table(spark, sf_dir, "orders")
    return dim_calendar_of(month_spine_of(orders, "o_orderdate"))


@query
def unpivot_wide(spark, sf_dir):
    """Wide monthly measures -> (month, measure, value) rows."""
    li = standins.read_table(spark, sf_dir, "lineitem")
    wide = (li.groupBy(month_start("l_shipdate").alias("month"))
            .agg(unit_sum("l_quantity", 2).alias("quantity"),
                 unit_sum("l_extendedprice", 2).alias("extendedprice"),
                 unit_sum("l_discount", 2).alias("discount"),
                 unit_sum("l_tax", 2).alias("tax"))
            .withColumn("rate_month", month_text("month", COMPACT_MONTH)).drop("month"))
    return unpivot_columns(wide, ["rate_month"], "measure", "value")


def _value_text(events):
    return (F.when(F.col("event_type") == "error", F.lit("na"))
            .when(F.col("event_type") == "signup", F.lit(""))
            .otherwise(F.col("value").cast("string")))


@query
def json_flatten(spark, sf_dir):
    """JSON text -> struct fields, grouped."""
    ev = standins.read_table(spark, sf_dir, "events")
    parsed = ev.select("event_type", F.from_json("props", "k BIGINT").alias("p"))
    return (parsed.groupBy("event_type")
            .agg(F.count(F.lit(1)).alias("events"), F.sum("p.k").alias("sum_k"),
                 F.min("p.k").alias("min_k"), F.max("p.k").alias("max_k")))


@query
def lenient_cast(spark, sf_dir):
    """Coercing number parse, then drop rows without a value.

    Some events carry a suffix or a hexadecimal form, which is no number.
    """
    ev = standins.read_table(spark, sf_dir, "events")
    kind, text = F.col("event_id") % 97, _value_text(ev)
    marked = (F.when(kind == 0, F.concat(text, F.lit("f"))).when(kind == 1, F.concat(text, F.lit("d")))
              .when(kind == 2, F.lit("0x1p3")).otherwise(text))
    parsed = ev.select("event_id", "event_type", lenient_double(marked).alias("value"))
    return parsed.dropna(subset=["value"])


@query
def strict_cast(spark, sf_dir):
    """Parse with '' and 'na' as null marks; other bad text fails (K8)."""
    ev = standins.read_table(spark, sf_dir, "events")
    return ev.select("event_id", "event_type", strict_double(_value_text(ev)).alias("value"))


# ---------------------------------------------------------------- latest rows, top-k

@query
def latest_inflation(spark, sf_dir):
    """Latest month with inflation (M1, I4)."""
    return signals.latest_with(MacroLayers(spark, sf_dir).export, "cpi_yoy_pct")


@query
def latest_fx(spark, sf_dir):
    """Latest month with a USD rate (M2)."""
    return signals.latest_with(MacroLayers(spark, sf_dir).export, "usd_sgd")


@query
def latest_trade(spark, sf_dir):
    """Latest month with imports (M3)."""
    return signals.latest_with(MacroLayers(spark, sf_dir).export, "imports_sgd_bn")


@query
def latest_row(spark, sf_dir):
    """Latest fact month with a year-on-year value (I4 on the gold table)."""
    return A.latest_rows(MacroLayers(spark, sf_dir).fact, "period_date", 1, present=["cpi_yoy_pct"])


@query
def latest_n(spark, sf_dir):
    """Latest 6 complete months of the fact."""
    return audit.latest_complete(MacroLayers(spark, sf_dir).fact)


@query
def top_k(spark, sf_dir):
    """Top 5 parts by revenue with their names."""
    li = standins.read_table(spark, sf_dir, "lineitem")
    part = standins.read_table(spark, sf_dir, "part")
    rev = li.select("l_partkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("rev"))
    # price (2 decimals) x (1 - discount) (2 decimals) has at most 4 decimals
    top = A.top_k(rev, ["l_partkey"], "rev", 5, name="revenue", digits=2, value_scale=4)
    # k rows: broadcast the k keys into a semi-join over part, never part itself
    return attach_attributes(top, part, "l_partkey", ["p_name"], large_key="p_partkey")


@query
def top_imports(spark, sf_dir):
    """Top 5 import lines by summed value."""
    return audit.top_trade_categories(MacroLayers(spark, sf_dir).bronze["bronze_trade_raw"], "imports")


@query
def top_exports(spark, sf_dir):
    """Top 5 export lines by summed value."""
    return audit.top_trade_categories(MacroLayers(spark, sf_dir).bronze["bronze_trade_raw"], "exports")


# ---------------------------------------------------------------- dashboard signals

@query
def annual_scorecard(spark, sf_dir):
    """Yearly inflation, rate, imports, regime and action, latest 12 years (M4)."""
    return signals.annual_scorecard(MacroLayers(spark, sf_dir).export)


@query
def annual_analysis(spark, sf_dir):
    """The analysis page's variant of the scorecard (M4)."""
    return signals.annual_scorecard(MacroLayers(spark, sf_dir).export,
                                    inflation_name="avg_cpi_yoy", imports_name="total_imports_sgd_bn")


@query
def sourcing_signal(spark, sf_dir):
    """Budgets and the USD/CNY sourcing signal (M5)."""
    return signals.sourcing_case(MacroLayers(spark, sf_dir).export, STANDIN_SINCE_YEAR)


@query
def scatter_regime(spark, sf_dir):
    """Rate against inflation with the band label (M9)."""
    return signals.scatter_regime(MacroLayers(spark, sf_dir).export)


@query
def inflation_history(spark, sf_dir):
    """Monthly inflation percent from a start year (M6 inflation_only)."""
    return signals.inflation_history(MacroLayers(spark, sf_dir).export, STANDIN_HISTORY_FROM)


@query
def cpi_history(spark, sf_dir):
    """Monthly inflation percent, full history (M6 cpi_history)."""
    return signals.inflation_history(MacroLayers(spark, sf_dir).export, None, name="cpi_yoy")


@query
def fx_rate_history(spark, sf_dir):
    """USD rate from a start year (M7 fx_only)."""
    return signals.fx_rate_history(MacroLayers(spark, sf_dir).export, STANDIN_HISTORY_FROM)


@query
def fx_history(spark, sf_dir):
    """USD, CNY and cross rate (M7 fx_history)."""
    return signals.fx_history(MacroLayers(spark, sf_dir).export)


@query
def trade_history(spark, sf_dir):
    """Monthly imports (M8 trade_history)."""
    return signals.trade_history(MacroLayers(spark, sf_dir).export)


@query
def series_history(spark, sf_dir):
    """Inflation, USD rate and imports per month, rounded (M6-M8 together)."""
    return signals.series_history(MacroLayers(spark, sf_dir).export)


@query
def log_series(spark, sf_dir):
    """ln of monthly imports (M8 log_imports, K12)."""
    return signals.log_imports(MacroLayers(spark, sf_dir).export)


# ---------------------------------------------------------------- audits

@query
def balance_status(spark, sf_dir):
    """Surplus/deficit of the latest 6 months with exports."""
    return audit.balance_check(MacroLayers(spark, sf_dir).fact)


@query
def yearly_averages(spark, sf_dir):
    """Yearly means over complete months, latest 10 years."""
    return audit.yearly_averages(MacroLayers(spark, sf_dir).fact)


@query
def table_profile(spark, sf_dir):
    """Rows, categories, month range, nulls per bronze table."""
    b = MacroLayers(spark, sf_dir).bronze
    return audit.bronze_profiles(b["bronze_cpi_raw"], b["bronze_fx_raw"], b["bronze_trade_raw"])


@query
def gold_coverage(spark, sf_dir):
    """Row count, date range and filled counts of the fact."""
    return audit.gold_coverage(MacroLayers(spark, sf_dir).fact)


@query
def silver_cpi_sample(spark, sf_dir):
    """Latest 6 headline CPI rows."""
    p = MacroLayers(spark, sf_dir)
    return audit.silver_samples(p.stg_cpi, p.stg_fx, p.stg_trade)["cpi"]


@query
def silver_fx_sample(spark, sf_dir):
    """Latest 6 USD rows."""
    p = MacroLayers(spark, sf_dir)
    return audit.silver_samples(p.stg_cpi, p.stg_fx, p.stg_trade)["fx"]


@query
def silver_trade_sample(spark, sf_dir):
    """Latest 8 total lines."""
    p = MacroLayers(spark, sf_dir)
    return audit.silver_samples(p.stg_cpi, p.stg_fx, p.stg_trade)["trade"]


@query
def distinct_pairs(spark, sf_dir):
    """Distinct (trade type, commodity) in bronze."""
    return audit.category_catalogue(MacroLayers(spark, sf_dir).bronze["bronze_trade_raw"])


@query
def count_by_key(spark, sf_dir):
    """Bronze trade rows per trade type."""
    return audit.rows_by_trade_type(MacroLayers(spark, sf_dir).bronze["bronze_trade_raw"])


# ---------------------------------------------------------------- data tests, layer counts

def _models(p: MacroLayers):
    return {"stg_cpi": p.stg_cpi, "stg_fx": p.stg_fx, "stg_trade": p.stg_trade,
            "fct_sg_macro_monthly": p.fact, "dim_calendar": p.dim_calendar}


@query
def quality_report(spark, sf_dir):
    """The fifteen declared tests as a report frame (O1-O3)."""
    return Q.run_checks(_models(MacroLayers(spark, sf_dir)))


@query
def quality_extra(spark, sf_dir):
    """Composite-grain, calendar and rate checks named in the docs."""
    return Q.run_checks(_models(MacroLayers(spark, sf_dir)), Q.EXTRA_CHECKS)


def _layer_counts(p: MacroLayers):
    tables = [("Bronze", "bronze_cpi_raw", p.bronze["bronze_cpi_raw"]),
              ("Bronze", "bronze_fx_raw", p.bronze["bronze_fx_raw"]),
              ("Bronze", "bronze_trade_raw", p.bronze["bronze_trade_raw"]),
              ("Silver", "stg_cpi", p.stg_cpi), ("Silver", "stg_fx", p.stg_fx),
              ("Silver", "stg_trade", p.stg_trade), ("Gold", "fct_sg_macro_monthly", p.fact)]
    return union_all(*[df.agg(F.count(F.lit(1)).alias("row_count"))
                       .select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count")
                       for layer, name, df in tables])


@query
def layer_counts(spark, sf_dir):
    """Measured rows per table and layer (M10 rows_by_source, A10, J2)."""
    return _layer_counts(MacroLayers(spark, sf_dir))


@query
def medallion_layers(spark, sf_dir):
    """Measured rows per layer (M10 medallion_layers)."""
    return (_layer_counts(MacroLayers(spark, sf_dir)).groupBy("layer")
            .agg(F.sum("row_count").alias("total_rows")))


@query
def source_stats(spark, sf_dir):
    """Source, dataset, frequency, first year, rows, categories, measured."""
    b = MacroLayers(spark, sf_dir).bronze
    return audit.source_stats(audit.bronze_profiles(b["bronze_cpi_raw"], b["bronze_fx_raw"],
                                                      b["bronze_trade_raw"]))


@query
def rows_by_source(spark, sf_dir):
    """Bronze rows per source, measured."""
    b = MacroLayers(spark, sf_dir).bronze
    return audit.rows_by_source(audit.bronze_profiles(b["bronze_cpi_raw"], b["bronze_fx_raw"],
                                                      b["bronze_trade_raw"]))


@query
def test_results(spark, sf_dir):
    """The fifteen tests with status and rows checked, in the page's shape."""
    return audit.test_results(Q.run_checks(_models(MacroLayers(spark, sf_dir))))


@query
def test_summary(spark, sf_dir):
    """Tests passing and pass rate from the report (M10 data_quality_score)."""
    report = Q.run_checks(_models(MacroLayers(spark, sf_dir)))
    return report.agg(F.count(F.lit(1)).alias("tests"),
                      F.count_if(F.col("status") == "PASS").alias("passing"),
                      F.count_distinct("model").alias("models_tested")).select(
        "tests", "passing", "models_tested",
        round_to(F.col("passing") * 100.0 / F.col("tests"), 1).alias("pass_rate"))


# ---------------------------------------------------------------- load history

RUN_TS_EARLIER = standins.RUN_TS.replace(year=2025, month=12, day=1)


def _cpi_loads(spark, sf_dir):
    """Two simulated CPI load days from one scan of ``orders``: an earlier
    full load and a later load holding only the finished orders."""
    by_status = MacroLayers(spark, sf_dir).orders_by_status
    earlier = standins.cpi_bronze_of(standins.orders_load(by_status), RUN_TS_EARLIER)
    later = standins.cpi_bronze_of(standins.orders_load(by_status, status="F"), standins.RUN_TS)
    return earlier, later


@query
def latest_snapshot(spark, sf_dir):
    """Two load days in bronze -> the latest load per (category, month) (T4, B1)."""
    earlier, later = _cpi_loads(spark, sf_dir)
    return S.latest_snapshot(earlier.unionByName(later), ["cpi_category", "time_period"])


@query
def replace_period(spark, sf_dir):
    """Stored rows before 1998-01, incoming rows from it on."""
    earlier, later = _cpi_loads(spark, sf_dir)
    period = F.to_date("time_period", "yyyy MMM")
    return S.replace_from(earlier, later, period, "1998-01-01")


@query
def incremental_months(spark, sf_dir):
    """Stored months plus incoming months after the stored maximum."""
    by_status = MacroLayers(spark, sf_dir).orders_by_status
    stored = standins.cpi_bronze_of(standins.orders_load(by_status, before="1999-01-01"), RUN_TS_EARLIER)
    incoming = standins.cpi_bronze_of(standins.orders_load(by_status), standins.RUN_TS)

    def dated(df):
        return df.select("*", F.to_date("time_period", "yyyy MMM").alias("period_date"))
    return S.incremental_append(dated(stored), dated(incoming), "period_date")


# ---------------------------------------------------------------- doc-only analyses

@query
def annual_summary(spark, sf_dir):
    """Yearly average rate and CPI, total balance."""
    return extras.annual_summary(MacroLayers(spark, sf_dir).fact)


@query
def annual_balance(spark, sf_dir):
    """Yearly exports, imports and balance."""
    return extras.annual_balance(MacroLayers(spark, sf_dir).fact)


BREAKDOWN = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium",
             "4-NOT SPECIFIED": "not_specified", "5-LOW": "low", "All Items": "all_items"}


@query
def category_breakdown(spark, sf_dir):
    """Year-on-year change per category, side by side per month."""
    return extras.category_breakdown(MacroLayers(spark, sf_dir).stg_cpi, BREAKDOWN)


@query
def rate_correlation(spark, sf_dir):
    """Correlation of each currency's rate with headline inflation."""
    p = MacroLayers(spark, sf_dir)
    return extras.rate_correlation(p.stg_fx, p.stg_cpi)


@query
def freshness(spark, sf_dir):
    """Days since the latest event per type, stale above 35 days."""
    ev = standins.read_table(spark, sf_dir, "events")
    return extras.freshness(ev, "ts", "2024-03-05", keys=("event_type",))


@query
def freshness_by_user(spark, sf_dir):
    """Days since a user's latest event: fresh and stale ones."""
    ev = standins.read_table(spark, sf_dir, "events")
    return extras.freshness(ev, "ts", "2024-02-15", keys=("user_id",))


# ---------------------------------------------------------------- landed files

def _amount_text(cents: str):
    """Cents as the decimal text a source file holds."""
    return (F.col(cents).cast("decimal(38,0)") / 100).cast("decimal(38,2)").cast("string")


@query
def landed_cpi(spark, sf_dir):
    """A nested CPI payload per category, flattened as the loader does (A1, C4).

    Each array has one entry per month, so it is bounded by the calendar.
    """
    monthly = MacroLayers(spark, sf_dir).orders_monthly
    text = F.when((F.col("cpi_category") == "5-LOW") & (F.month("month") == 12), F.lit("na")).otherwise(_amount_text("cents"))
    series = monthly.groupBy(F.col("cpi_category").alias("rowText")).agg(F.collect_list(F.struct(
        month_text("month", SPACED_MONTH).alias("key"), text.alias("value"))).alias("columns"))
    payload = series.select(F.struct(F.array(F.struct("rowText", "columns")).alias("row")).alias("Data"))
    return landed.flatten_cpi_payload(payload, standins.RUN_TS).withColumn(
        "ingested_at", F.col("ingested_at").cast("timestamp_ntz"))


@query
def landed_trade(spark, sf_dir):
    """Import and export records, one map of months each, melted as the loader does."""
    monthly = MacroLayers(spark, sf_dir).lineitem_monthly
    text = F.when((F.col("l_returnflag") == "A") & (F.month("month") == 2), F.lit("1,000")).otherwise(_amount_text("price_cents"))
    months = F.map_from_entries(F.collect_list(F.struct(month_text("month", COMPACT_MONTH), text)))
    wide = monthly.groupBy("l_returnflag", "l_linestatus").agg(months.alias("months"))
    name = F.concat(F.lit("Flag "), "l_returnflag")

    def records(status, key, trade_type):
        ids = F.create_map(F.lit(landed.RECORD_ID), F.lit("1"), F.lit(key), name)
        return wide.where(F.col("l_linestatus") == status).select(F.map_concat(ids, "months").alias("record"),
                                                                  F.lit(trade_type).alias("trade_type"))
    both = records("O", landed.SERIES_KEY, IMPORTS).unionByName(records("F", landed.SERIES_KEY_ALT, EXPORTS))
    return landed.trade_rows(both, standins.RUN_TS).withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz"))


# ---------------------------------------------------------------- branches the plain stand-ins do not reach

def _fact_gaps(p: MacroLayers) -> DataFrame:
    """The fact where the first quarter has no rates and the year's end no exports."""
    fx = p.stg_fx.where(F.month("period_date") > 3)
    trade = p.stg_trade.where((F.col("trade_type") != EXPORTS) | (F.month("period_date") < 11))
    return marts.fct_macro_monthly(p.stg_cpi, fx, trade, p.dim_calendar)


@query
def macro_fact_gaps(spark, sf_dir):
    """Months without a rate or without exports keep their row."""
    return _fact_gaps(MacroLayers(spark, sf_dir))


@query
def balance_status_gaps(spark, sf_dir):
    """A month without a balance reads as a deficit."""
    return audit.labelled_balance(_fact_gaps(MacroLayers(spark, sf_dir)))


@query
def sourcing_bands(spark, sf_dir):
    """Rates spread over all three sourcing bands."""
    export = MacroLayers(spark, sf_dir).export
    spread = round_to(F.col("usd_sgd") * (18 + F.month("period_date") % 4) / 20, 4)
    return signals.sourcing_case(export.withColumn("usd_sgd", spread), 0)


@query
def recent_scorecard(spark, sf_dir):
    """The scorecard of the latest two years: a limit that cuts."""
    return signals.annual_scorecard(MacroLayers(spark, sf_dir).export, years=2)


@query
def top_trade_lines(spark, sf_dir):
    """The two largest import lines: a limit that cuts."""
    return audit.top_trade_categories(MacroLayers(spark, sf_dir).bronze["bronze_trade_raw"], "imports", 2)


@query
def quality_bronze(spark, sf_dir):
    """Checks on bronze, where some fail (O1-O3)."""
    return Q.run_checks(MacroLayers(spark, sf_dir).bronze, (
        Q.Check("bronze_cpi_raw", "cpi_value", "not_null"), Q.Check("bronze_cpi_raw", "time_period", "unique"),
        Q.Check("bronze_fx_raw", "currency_pair", "accepted_values", KEY_CURRENCIES)))


# ---------------------------------------------------------------- catalogues, samples, ordered series

@query
def silver_catalogue(spark, sf_dir):
    """Distinct (trade type, commodity) in silver."""
    return audit.category_catalogue(MacroLayers(spark, sf_dir).stg_trade)


@query
def trade_types(spark, sf_dir):
    """Distinct trade types in bronze."""
    return MacroLayers(spark, sf_dir).bronze["bronze_trade_raw"].select("trade_type").distinct()


@query
def export_categories(spark, sf_dir):
    """Distinct export lines in bronze."""
    trade = MacroLayers(spark, sf_dir).bronze["bronze_trade_raw"]
    return trade.where(F.col("trade_type") == EXPORTS).select("commodity_category").distinct()


@query
def currency_list(spark, sf_dir):
    """Distinct currencies in bronze."""
    return MacroLayers(spark, sf_dir).bronze["bronze_fx_raw"].select("currency_pair").distinct()


@query
def load_categories(spark, sf_dir):
    """Number and names of the categories of each bronze table."""
    b = MacroLayers(spark, sf_dir).bronze
    return audit.load_categories({"bronze_cpi_raw": (b["bronze_cpi_raw"], "cpi_category"),
                                  "bronze_fx_raw": (b["bronze_fx_raw"], "currency_pair"),
                                  "bronze_trade_raw": (b["bronze_trade_raw"], "commodity_category")})


@query
def cpi_sample(spark, sf_dir):
    """Five CPI rows by key order."""
    return MacroLayers(spark, sf_dir).bronze["bronze_cpi_raw"].orderBy("cpi_category", "time_period").limit(5)


@query
def fx_sample(spark, sf_dir):
    """Five FX rows by key order."""
    return MacroLayers(spark, sf_dir).bronze["bronze_fx_raw"].orderBy("currency_pair", "rate_month").limit(5)


@query
def data_quality_score(spark, sf_dir):
    """Tests, passing, pass rate and sources with rows."""
    p = MacroLayers(spark, sf_dir)
    b = p.bronze
    profiles = audit.bronze_profiles(b["bronze_cpi_raw"], b["bronze_fx_raw"], b["bronze_trade_raw"])
    return audit.quality_score(Q.run_checks(_models(p)), profiles)


@query
def inflation_ordered(spark, sf_dir):
    """Monthly inflation in month order, with its position."""
    return signals.in_order(signals.inflation_history(MacroLayers(spark, sf_dir).export, None, name="cpi_yoy"))


@query
def fx_ordered(spark, sf_dir):
    """Monthly rates in month order, with their position."""
    return signals.in_order(signals.fx_history(MacroLayers(spark, sf_dir).export))


@query
def trade_ordered(spark, sf_dir):
    """Monthly imports in month order, with their position."""
    return signals.in_order(signals.trade_history(MacroLayers(spark, sf_dir).export))


# ---------------------------------------------------------------- releases, refreshes, page sets, load statistics

def _stamped(df: DataFrame) -> DataFrame:
    """Bronze rows with the load time as the stored tables declare it."""
    return df.withColumn("ingested_at", F.col("ingested_at").cast("timestamp"))


@query
def released_fact(spark, sf_dir):
    """The fact as a release publishes it, which a later draft with a failed test leaves as it is."""
    p, root = MacroLayers(spark, sf_dir), scratch_path(spark, "release")
    good = Releases(spark, root).draft()
    flows.draft_models(good, p.bronze, dedupe_cpi=False)
    good.publish()
    bad = Releases(spark, root).draft()
    fact = bad.base_table("fct_sg_macro_monthly")
    bad.write("fct_sg_macro_monthly", fact.unionByName(fact), checks=[Q.Check("fct_sg_macro_monthly", "period_date", "unique")])
    try:
        bad.publish()
    except Q.DataTestFailure:
        return Releases(spark, root).read("fct_sg_macro_monthly")
    raise AssertionError("a doubled fact was published")


@query
def release_report(spark, sf_dir):
    """The fifteen tests, answered by the writes of a release (O1-O3)."""
    draft = Releases(spark, scratch_path(spark, "release")).draft()
    flows.draft_models(draft, MacroLayers(spark, sf_dir).bronze, dedupe_cpi=False)
    return draft.report()


def _two_loads(spark, sf_dir):
    """A first load of the months before 2000, and a later one: of prices only the finished orders."""
    p = MacroLayers(spark, sf_dir)
    cut = F.lit("2000-01-01").cast("date")
    first = standins.cpi_bronze_of(standins.orders_load(p.orders_by_status, before="2000-01-01"), RUN_TS_EARLIER)
    later = standins.cpi_bronze_of(standins.orders_load(p.orders_by_status, status="F"), standins.RUN_TS)
    early = p.lineitem_monthly.where(F.col("month") < cut)
    return ((_stamped(first), _stamped(standins.fx_bronze_of(early)), _stamped(standins.trade_bronze_of(early))),
            (_stamped(later), _stamped(p.bronze["bronze_fx_raw"]), _stamped(p.bronze["bronze_trade_raw"])))


def _refreshed(spark, sf_dir) -> str:
    root = scratch_path(spark, "warehouse")
    for load_id, (cpi, fx, trade) in enumerate(_two_loads(spark, sf_dir)):
        warehouse.refresh(spark, root, cpi_load=cpi, load_id=str(load_id), fx=fx, trade=trade)
    return root


@query
def incremental_fact(spark, sf_dir):
    """The stored fact after a refresh that rewrote only the months a load touches."""
    return warehouse.read_current(spark, _refreshed(spark, sf_dir))


@query
def current_cpi_state(spark, sf_dir):
    """The stored CPI state after two loads were merged into it, in buckets (B1, T4)."""
    earlier, later = _cpi_loads(spark, sf_dir)
    root = scratch_path(spark, "warehouse")
    for load_id, load in enumerate((earlier, later)):
        warehouse.refresh(spark, root, cpi_load=_stamped(load), load_id=str(load_id))
    state = warehouse.read_current(spark, root, warehouse.STATE)
    return state.withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz"))


@query
def affected_months(spark, sf_dir):
    """Months whose fact rows the second load can touch, by kind of change."""
    (cpi, _, _), (later, _, _) = _two_loads(spark, sf_dir)
    dated = [df.where(F.col("cpi_category") == HEADLINE_CPI).select(
        "cpi_category", F.to_date("time_period", SPACED_MONTH).alias("period_date"), "cpi_value") for df in (cpi, S.merge_latest(
            cpi, later, ["cpi_category", "time_period"]))]
    changes = changed_rows(*dated, ["cpi_category", "period_date"], ["cpi_value"])
    touched = touched_rows(dated[1], changes, ["cpi_category"], "period_date")
    return touched.join(changes.drop("cpi_category"), "period_date", "left").select("period_date", "change")


@query
def monthly_changes_by_range(spark, sf_dir):
    """stg_cpi with the series cut into ranges of rows for their lags (H1, H2)."""
    bronze = MacroLayers(spark, sf_dir).bronze["bronze_cpi_raw"]
    return staging.stg_cpi(bronze, ranges=12)


@query
def daily_changes_by_range(spark, sf_dir):
    """Changes of daily order values per priority, one priority with a third of the rows (H1, H2, any grain)."""
    orders = standins.read_table(spark, sf_dir, "orders")
    kind = F.when(F.col("o_orderkey") % 3 == 0, F.lit("all")).otherwise(F.col("o_orderpriority"))
    daily = orders.groupBy(kind.alias("series"), F.to_date("o_orderdate").alias("day")).agg(
        unit_sum("o_totalprice", 2).alias("value"))
    return with_changes(daily, ["series"], "day", "value", mom="day_change", yoy="pct_12_days", ranges=16)


@query
def trade_report(spark, sf_dir):
    """All trade audits from one scan."""
    return audit.trade_report(MacroLayers(spark, sf_dir).bronze["bronze_trade_raw"])


@query
def load_statistics(spark, sf_dir):
    """Statistics of two loads, observed by their writes, merged."""
    bronze = MacroLayers(spark, sf_dir).bronze
    loads = None
    for load_id, early in enumerate((True, False)):
        draft = Releases(spark, scratch_path(spark, "loads")).draft()
        for table, df in bronze.items():
            month = flows.MEASURED[table][1]
            old = year_of_text(month) < 1998
            draft.write(table, df.where(old if early else ~old), metrics=flows.table_metrics(table))
        loads = load_stats.with_loads(loads, load_stats.load_rows(spark, str(load_id), draft.observed))
    merged = load_stats.merged_stats(loads)
    return merged.select("table_name", "row_count", "categories", "first_month", "last_month", "null_values",
                         F.array_join("names", ", ").alias("names"))


def _write_pages(records: DataFrame, path: str, size: int) -> None:
    """Records (dataset, record) as landed files: a folder per dataset, a document per page.

    One task writes the pages of a dataset in order, so their files are numbered from
    0. There is one record per series, so they are bounded by the series, not by the rows.
    A last page without records follows if the one before it is full.
    """
    by_flag = F.array_sort(F.collect_list("record"), lambda a, b: F.when(a["l_returnflag"] < b["l_returnflag"], -1).otherwise(1))
    every = records.groupBy("dataset").agg(by_flag.alias("all"))
    numbers = F.sequence(F.lit(0), F.floor(F.size("all") / size).cast("int"))
    pages = every.select("dataset", F.posexplode(F.transform(numbers, lambda n: F.slice("all", n * size + 1, F.lit(size)))).alias("page", "part"))
    text = F.to_json(F.struct(F.struct(F.transform("part", lambda r: r["months"]).alias("records")).alias("result")))
    (pages.select("dataset", "page", text.alias("value")).repartition("dataset").sortWithinPartitions("dataset", "page")
     .select("dataset", "value").write.partitionBy("dataset").option("maxRecordsPerFile", 1).text(path))


@query
def landed_pages(spark, sf_dir):
    """Import and export records through page files: written, counted, read, tagged and melted."""
    monthly = MacroLayers(spark, sf_dir).lineitem_monthly
    text = F.when((F.col("l_returnflag") == "A") & (F.month("month") == 2), F.lit("1,000")).otherwise(_amount_text("price_cents"))
    wide = monthly.groupBy("l_returnflag", "l_linestatus").agg(F.map_from_entries(F.collect_list(
        F.struct(month_text("month", COMPACT_MONTH), text))).alias("months"))
    key = F.when(F.col("l_linestatus") == "O", landed.SERIES_KEY).otherwise(landed.SERIES_KEY_ALT)
    ids = F.map_from_arrays(F.array(F.lit(landed.RECORD_ID), key), F.array(F.lit("1"), F.concat(F.lit("Flag "), "l_returnflag")))
    records = wide.select(F.when(F.col("l_linestatus") == "O", IMPORTS).otherwise(EXPORTS).alias("dataset"),
                          F.struct("l_returnflag", F.map_concat(ids, "months").alias("months")).alias("record"))
    path = scratch_path(spark, "pages")
    _write_pages(records, path, 2)
    both = [read_page_set(spark, f"{path}/dataset={d}", 2, 0, d) for d in (IMPORTS, EXPORTS)]
    rows = landed.trade_rows(both[0].unionByName(both[1]), standins.RUN_TS)
    return rows.withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz"))


@query
def page_sets(spark, sf_dir):
    """What is missing, repeated, short or too large among pages of orders."""
    orders = standins.read_table(spark, sf_dir, "orders")
    pages = orders.groupBy(F.col("o_orderpriority").alias("dataset"), (F.col("o_orderkey") % 60 + 1).cast("int").alias("page")).agg(
        F.count(F.lit(1)).alias("n"))
    kept = pages.where(~((F.col("page") % 7 == 3) & (F.col("dataset") != "5-LOW")))
    return page_census(kept, page_size=3, size=F.least(F.col("n"), F.lit(4)))
