import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.snapshots import incremental_append, latest_snapshot, replace_from
from tidemark.plans import marts, staging
from tidemark.plans.export import EXPORT_COLUMNS, export_projection

T1 = dt.datetime(2024, 5, 1, 8, 0)
T2 = dt.datetime(2024, 5, 2, 8, 0)


def months(start_year, n):
    out, y, m = [], start_year, 1
    for _ in range(n):
        out.append(dt.date(y, m, 1).strftime("%Y %b"))
        m += 1
        if m == 13:
            y, m = y + 1, 1
    return out


def cpi_bronze(spark, rows):
    return spark.createDataFrame(rows, "cpi_category string, time_period string, cpi_value double, ingested_at timestamp")


def test_stg_cpi_changes_and_edges(spark):
    ms = months(1998, 14)
    vals = [100.0 + i for i in range(14)]
    rows = [("All Items", m, v, T1) for m, v in zip(ms, vals)]
    rows.append(("All Items", "1999 Mar", None, T1))           # null value dropped first
    rows[1] = ("All Items", ms[1], 0.0, T1)                   # base of month 13 is 0 -> yoy null
    out = {r.period_date: r for r in staging.stg_cpi(cpi_bronze(spark, rows)).collect()}
    assert len(out) == 14
    first = out[dt.date(1998, 1, 1)]
    assert first.cpi_mom_change is None and first.cpi_yoy_pct is None
    assert out[dt.date(1998, 12, 1)].cpi_yoy_pct is None        # fewer than 12 rows back
    assert out[dt.date(1999, 1, 1)].cpi_yoy_pct == 12.0          # (112-100)/100*100
    assert out[dt.date(1999, 2, 1)].cpi_yoy_pct is None          # base is 0
    assert out[dt.date(1998, 3, 1)].cpi_mom_change == 102.0      # 102 - 0
    assert first.period_year == 1998 and first.period_month == 1


def test_lag_counts_rows_not_months(spark):
    ms = months(2000, 14)
    del ms[5]                                                     # a missing month
    rows = [("A", m, float(i + 1), T1) for i, m in enumerate(ms)]
    out = {r.period_date: r for r in staging.stg_cpi(cpi_bronze(spark, rows)).collect()}
    # 13th row (2001 Feb) looks 12 rows back = 2000 Jan (value 1): a 13-month gap
    assert out[dt.date(2001, 2, 1)].cpi_yoy_pct == round((13 - 1) / 1 * 100, 2)


def fx_bronze(spark, rows):
    return spark.createDataFrame(rows, "currency_pair string, rate_month string, exchange_rate double, ingested_at timestamp")


def test_stg_fx_filters(spark):
    rows = [("US Dollar", "2024Jan", 1.35, T1), ("US Dollar", "2024Feb", 0.0, T1),
            ("US Dollar", "2024Mar", -1.0, T1), ("Swiss Franc", "2024Jan", 1.5, T1),
            ("Renminbi", "2024Jan", None, T1), ("Euro", "2024Jan", 1.4571, T1)]
    out = staging.stg_fx(fx_bronze(spark, rows)).orderBy("currency_pair").collect()
    assert [(r.currency_pair, r.period_month_abbr) for r in out] == [("Euro", "Jan"), ("US Dollar", "Jan")]
    assert out[1].foreign_units_per_sgd == round(1 / 1.35, 4) and out[1].period_year == 2024


def trade_bronze(spark, rows):
    return spark.createDataFrame(rows, "commodity_category string, trade_type string, trade_month string, "
                                       "trade_value_sgd_million double, ingested_at timestamp")


def test_stg_trade_keeps_import_total_and_all_exports(spark):
    rows = [("Total Merchandise Imports", "imports", "2024Jan", 50.0, T1),
            ("Machinery", "imports", "2024Jan", 20.0, T1),
            ("Machinery", "exports", "2024Jan", 30.0, T1),
            ("Chemicals", "exports", "2024Jan", 10.0, T1),
            ("Chemicals", "exports", "2024Feb", 0.0, T1)]
    out = staging.stg_trade(trade_bronze(spark, rows)).collect()
    assert sorted((r.trade_type, r.commodity_category) for r in out) == [
        ("exports", "Chemicals"), ("exports", "Machinery"), ("imports", "Total Merchandise Imports")]


def _silver(spark):
    ms = months(1998, 16)
    cpi = cpi_bronze(spark, [("All Items", m, 100.0 + i, T1) for i, m in enumerate(ms)]
                     + [("Food", m, 50.0, T1) for m in ms])
    fx = fx_bronze(spark, [("US Dollar", "1999Jan", 1.7, T1), ("Renminbi", "1999Jan", 0.2, T1),
                           ("US Dollar", "1999Feb", 1.2, T1)])
    trade = trade_bronze(spark, [("Total Merchandise Imports", "imports", "1999Jan", 40.0, T1),
                                 ("A", "exports", "1999Jan", 30.0, T1), ("B", "exports", "1999Jan", 25.0, T1)])
    return staging.stg_cpi(cpi), staging.stg_fx(fx), staging.stg_trade(trade)


def test_fact_joins_and_derived_measures(spark):
    s_cpi, s_fx, s_trade = _silver(spark)
    cal = marts.dim_calendar(spark, "1999-01-01", "1999-12-01")
    fact = marts.fct_macro_monthly(s_cpi, s_fx, s_trade, cal)
    rows = {r.period_date: r for r in fact.collect()}
    assert sorted(rows) == [dt.date(1999, m, 1) for m in range(1, 5)]   # pre-1999 rows absent
    jan, mar = rows[dt.date(1999, 1, 1)], rows[dt.date(1999, 3, 1)]
    assert jan.cpi_yoy_pct is not None                                   # base from 1998 kept
    assert jan.total_exports_sgd == 55.0 and jan.trade_balance_sgd == 15.0
    assert jan.trade_openness_ratio == round(95 / 40, 2) and jan.cny_sgd_rate == 0.2
    assert jan.quarter == "Q1" and jan.month_name == "January"
    assert mar.usd_sgd_rate is None and mar.trade_balance_sgd is None    # CPI month without sides
    one = marts.fct_macro_monthly_one_pass(s_cpi, s_fx, s_trade, cal)
    assert sorted(fact.collect()) == sorted(one.collect())
    exp = export_projection(fact)
    assert tuple(exp.columns) == EXPORT_COLUMNS
    e = {r.period_date: r for r in exp.collect()}[dt.date(1999, 1, 1)]
    assert e.ge_usd_budget_m == round(50 / 1.7, 1) and e.usd_cny_ratio == 8.5


def test_latest_snapshot_removes_second_load_day(spark):
    ms = months(2000, 3)
    rows = [("All Items", m, 1.0, T1) for m in ms] + [("All Items", m, 2.0, T2) for m in ms[:2]]
    out = latest_snapshot(cpi_bronze(spark, rows), ["cpi_category", "time_period"]).collect()
    assert sorted((r.time_period, r.cpi_value) for r in out) == sorted(
        [(ms[0], 2.0), (ms[1], 2.0), (ms[2], 1.0)])


def test_replace_and_incremental(spark):
    old = spark.createDataFrame([(dt.date(2024, m, 1), float(m)) for m in (1, 2, 3)], "d date, v double")
    new = spark.createDataFrame([(dt.date(2024, m, 1), 10.0 * m) for m in (2, 3, 4)], "d date, v double")
    rep = sorted(r.v for r in replace_from(old, new, "d", "2024-02-01").collect())
    assert rep == [1.0, 20.0, 30.0, 40.0]
    inc = sorted(r.v for r in incremental_append(old, new, "d").collect())
    assert inc == [1.0, 2.0, 3.0, 40.0]
    empty = old.where(F.lit(False))
    assert incremental_append(empty, new, "d").count() == 3
