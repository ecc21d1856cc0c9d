"""Oracle SQL per registered query (see ``tidemark.oracle``)."""

from __future__ import annotations

from .. import oracle as O

ORACLE: dict[str, str] = {
    "monthly_mom_yoy": O.with_ctes([O.BRONZE_CPI, O.STG_CPI], "SELECT * FROM stg_cpi"),
    "inverse_rate": O.with_ctes([O.BRONZE_FX, O.STG_FX], "SELECT * FROM stg_fx"),
    "totals_union": O.with_ctes([O.BRONZE_TRADE, O.STG_TRADE], "SELECT * FROM stg_trade"),
    "macro_fact": O.with_ctes(O.GOLD, "SELECT * FROM fact"),
    "macro_fact_one_pass": O.with_ctes(O.GOLD, "SELECT * FROM fact"),
    "export_projection": O.with_ctes(O.SERVING, "SELECT * FROM export"),
}

W = O.with_ctes
TS1 = "TIMESTAMP '2025-12-01 00:00:00'"


def _cpi_bronze_sql(name: str, where: str, ts: str) -> str:
    return f"""
{name} AS (
  SELECT cpi_category, time_period,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(38,2))) AS DOUBLE) AS cpi_value, {ts} AS ingested_at
  FROM (SELECT UNNEST([o_orderpriority, 'All Items']) AS cpi_category,
               strftime(o_orderdate, '%Y %b') AS time_period, o_totalprice
        FROM orders WHERE {where}) s
  GROUP BY cpi_category, time_period)"""


LOADS = [_cpi_bronze_sql("earlier", "TRUE", TS1),
         _cpi_bronze_sql("later", "o_orderstatus = 'F'", O.TS)]

VALUE_TEXT = ("CASE WHEN event_type = 'error' THEN 'na' WHEN event_type = 'signup' THEN '' "
              "ELSE CAST(value AS VARCHAR) END")

REGIME = """CASE WHEN {x} > 0.04 THEN '{a}' WHEN {x} > 0.02 THEN '{b}'
                 WHEN {x} >= 0 THEN '{c}' ELSE '{d}' END"""


def _band(x, labels):
    return REGIME.format(x=x, a=labels[0], b=labels[1], c=labels[2], d=labels[3])


def _exact_avg(c):
    return f"CAST(SUM(CAST({c} AS DECIMAL(38,6))) AS DOUBLE) / COUNT({c})"


def _exact_sum(c, scale=6):
    return f"CAST(SUM(CAST({c} AS DECIMAL(38,{scale}))) AS DOUBLE)"


# The labels of the bands.
REGIMES = ("HIGH", "ELEVATED", "STABLE", "DEFLATION")
ACTIONS = ("Lock prices. Hedge FX. Accelerate orders.", "Review contracts. Monitor USD/SGD monthly.",
           "Negotiate hard. Lock multi-year deals now.", "Spot buy. Extend terms. Hold inventory light.")
SCATTER = ("High above 4pct", "Moderate 2 to 4pct", "Low 0 to 2pct", "Deflation below 0")


def _scorecard(infl_name, imp_name, years=12):
    return W(O.SERVING, f"""
SELECT CAST(period_year AS INTEGER) AS year, round(100 * inflation, 1) AS {infl_name}, round(rate, 4) AS usd_sgd,
       round(bought, 0) AS {imp_name}, {_band('inflation', REGIMES)} AS regime,
       {_band('inflation', ACTIONS)} AS prescribed_action
FROM (SELECT DISTINCT period_year, {_over('cpi_yoy_pct', 'avg')} AS inflation, {_over('usd_sgd', 'avg')} AS rate,
             {_over('imports_sgd_bn', 'sum')} AS bought,
             dense_rank() OVER (ORDER BY period_year DESC) AS age
      FROM export WHERE usd_sgd + imports_sgd_bn IS NOT NULL) y
WHERE age <= {years}""")


def _over(c, kind):
    """Yearly sum or mean as a window, exact."""
    w = "(PARTITION BY period_year)"
    total = f"CAST(sum(CAST({c} AS DECIMAL(38,6))) OVER {w} AS DOUBLE)"
    return total if kind == "sum" else f"{total} / count({c}) OVER {w}"


def _profile(table, cat, month, fmt, value):
    return f"""
SELECT '{table}' AS table_name, COUNT(*) AS row_count, COUNT(DISTINCT {cat}) AS categories,
       CAST(MIN(strptime({month}, '{fmt}')) AS DATE) AS first_month,
       CAST(MAX(strptime({month}, '{fmt}')) AS DATE) AS last_month,
       COUNT(*) FILTER (WHERE {value} IS NULL) AS null_values
FROM {table}"""


def _check_sql(model, column, test, values=()):
    if test == "not_null":
        fail = f"COUNT(*) FILTER (WHERE {column} IS NULL)"
    elif test == "rejected_values":
        vals = ", ".join(f"'{v}'" for v in values)
        fail = f"COUNT(*) FILTER (WHERE {column} IN ({vals}))"
    elif test == "accepted_values":
        vals = ", ".join(f"'{v}'" for v in values)
        fail = f"COUNT(*) FILTER (WHERE {column} IS NOT NULL AND {column} NOT IN ({vals}))"
    else:
        cols = column.split(",")
        nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
        fail = (f"(SELECT COUNT(*) FROM (SELECT {column} FROM {model} WHERE {nn} "
                f"GROUP BY {column} HAVING COUNT(*) > 1) d)")
    return (f"SELECT '{model}' AS model, '{column}' AS column_name, '{test}' AS test, "
            f"COUNT(*) AS rows_checked, CAST({fail} AS BIGINT) AS failures FROM {model}")


def _checks_sql(checks):
    body = "\nUNION ALL\n".join(_check_sql(*c) for c in checks)
    return (f"SELECT *, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status "
            f"FROM ({body}) r")


CURRENCIES = O.CURRENCIES
MODEL_CHECKS = [
    ("stg_cpi", "cpi_category", "not_null"), ("stg_cpi", "period_date", "not_null"),
    ("stg_cpi", "cpi_value", "not_null"), ("stg_fx", "currency_pair", "not_null"),
    ("stg_fx", "currency_pair", "accepted_values", CURRENCIES), ("stg_fx", "period_date", "not_null"),
    ("stg_fx", "sgd_per_foreign_unit", "not_null"), ("stg_trade", "trade_type", "not_null"),
    ("stg_trade", "trade_type", "accepted_values", ("imports", "exports")),
    ("stg_trade", "period_date", "not_null"), ("stg_trade", "trade_value_sgd_million", "not_null"),
    ("fact", "period_date", "not_null"), ("fact", "period_date", "unique"),
    ("fact", "cpi_value", "not_null"), ("fact", "period_year", "not_null"),
]
EXTRA_CHECKS = [
    ("stg_cpi", "cpi_category,period_date", "unique"), ("stg_fx", "currency_pair,period_date", "unique"),
    ("stg_trade", "commodity_category", "rejected_values", ("Total Merchandise Exports",)),
    ("dim_calendar", "period_date", "unique"), ("fact", "usd_sgd_rate", "not_null"),
]
FACT_NAME = "REPLACE(model, 'fact', 'fct_sg_macro_monthly') AS model"


def _report(checks):
    return W(O.GOLD, f"SELECT {FACT_NAME}, column_name, test, rows_checked, failures, status "
                     f"FROM ({_checks_sql(checks)}) q")


LAYERS = """
layer_counts AS (
  SELECT 'Bronze' AS layer, 'bronze_cpi_raw' AS table_name, COUNT(*) AS row_count FROM bronze_cpi_raw
  UNION ALL SELECT 'Bronze', 'bronze_fx_raw', COUNT(*) FROM bronze_fx_raw
  UNION ALL SELECT 'Bronze', 'bronze_trade_raw', COUNT(*) FROM bronze_trade_raw
  UNION ALL SELECT 'Silver', 'stg_cpi', COUNT(*) FROM stg_cpi
  UNION ALL SELECT 'Silver', 'stg_fx', COUNT(*) FROM stg_fx
  UNION ALL SELECT 'Silver', 'stg_trade', COUNT(*) FROM stg_trade
  UNION ALL SELECT 'Gold', 'fct_sg_macro_monthly', COUNT(*) FROM fact)"""

SAMPLE_SPINE = """
spine AS (
  SELECT CAST(UNNEST(generate_series(
           (SELECT CAST(date_trunc('month', MIN(o_orderdate)) AS DATE) FROM orders),
           (SELECT CAST(date_trunc('month', MAX(o_orderdate)) AS DATE) FROM orders),
           INTERVAL 1 MONTH)) AS DATE) AS period_date)"""

ORACLE.update({
    "month_parse": """
SELECT month_text, CAST(strptime(month_text, '%Y%b') AS DATE) AS period_date,
       CAST(left(month_text, 4) AS INTEGER) AS period_year,
       CAST(month(strptime(month_text, '%Y%b')) AS INTEGER) AS period_month,
       right(month_text, 3) AS period_month_abbr,
       strftime(strptime(month_text, '%Y%b'), '%B') AS month_name, order_count
FROM (SELECT strftime(o_orderdate, '%Y%b') AS month_text, COUNT(*) AS order_count
      FROM orders GROUP BY 1) m""",
    "date_spine": W([SAMPLE_SPINE], """
SELECT period_date, CAST(year(period_date) AS INTEGER) AS year,
       CAST(month(period_date) AS INTEGER) AS month_num,
       strftime(period_date, '%b') AS month_abbr, strftime(period_date, '%B') AS month_name,
       'Q' || CAST(quarter(period_date) AS VARCHAR) AS quarter,
       CASE WHEN month(period_date) BETWEEN 3 AND 5 THEN 'Asia Dry Season'
            WHEN month(period_date) BETWEEN 6 AND 9 THEN 'Monsoon Season'
            ELSE 'Year End / Q1' END AS sg_trade_season
FROM spine"""),
    "unpivot_wide": f"""
WITH wide AS (
  SELECT strftime(l_shipdate, '%Y%b') AS rate_month,
         {_exact_sum('l_quantity', 2)} AS quantity, {_exact_sum('l_extendedprice', 2)} AS extendedprice,
         {_exact_sum('l_discount', 2)} AS discount, {_exact_sum('l_tax', 2)} AS tax
  FROM lineitem GROUP BY 1)
SELECT rate_month, 'quantity' AS measure, quantity AS value FROM wide
UNION ALL SELECT rate_month, 'extendedprice', extendedprice FROM wide
UNION ALL SELECT rate_month, 'discount', discount FROM wide
UNION ALL SELECT rate_month, 'tax', tax FROM wide""",
    "json_flatten": """
SELECT event_type, COUNT(*) AS events, CAST(SUM(k) AS BIGINT) AS sum_k, MIN(k) AS min_k, MAX(k) AS max_k
FROM (SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) e
GROUP BY event_type""",
    "lenient_cast": f"""
SELECT event_id, event_type, value FROM (
  SELECT event_id, event_type, CASE WHEN event_id % 97 > 2 THEN TRY_CAST({VALUE_TEXT} AS DOUBLE) END AS value
  FROM events) e
WHERE value IS NOT NULL""",
    "strict_cast": f"""
SELECT event_id, event_type,
       CASE WHEN t IS NULL OR t IN ('', 'na') THEN NULL ELSE CAST(t AS DOUBLE) END AS value
FROM (SELECT event_id, event_type, {VALUE_TEXT} AS t FROM events) e""",
    "latest_inflation": W(O.SERVING, "SELECT * FROM export WHERE cpi_yoy_pct IS NOT NULL "
                                     "ORDER BY period_date DESC LIMIT 1"),
    "latest_fx": W(O.SERVING, "SELECT * FROM export WHERE usd_sgd IS NOT NULL ORDER BY period_date DESC LIMIT 1"),
    "latest_trade": W(O.SERVING, "SELECT * FROM export WHERE imports_sgd_bn IS NOT NULL "
                                 "ORDER BY period_date DESC LIMIT 1"),
    "latest_n": W(O.GOLD, """
SELECT period_date, cpi_value, cpi_yoy_pct, usd_sgd_rate, total_imports_sgd, total_exports_sgd,
       trade_balance_sgd
FROM fact WHERE usd_sgd_rate IS NOT NULL ORDER BY period_date DESC LIMIT 6"""),
    "top_k": f"""
SELECT t.l_partkey, t.revenue, p.p_name FROM (
  SELECT l_partkey, round({_exact_sum('l_extendedprice * (1 - l_discount)')}, 2) AS revenue
  FROM lineitem GROUP BY l_partkey ORDER BY revenue DESC, l_partkey LIMIT 5) t
LEFT JOIN part p ON t.l_partkey = p.p_partkey""",
    "top_imports": W([O.BRONZE_TRADE], f"""
SELECT commodity_category, round({_exact_sum('trade_value_sgd_million')}, 0) AS total_sgd_million
FROM bronze_trade_raw WHERE trade_type = 'imports' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"""),
    "top_exports": W([O.BRONZE_TRADE], f"""
SELECT commodity_category, round({_exact_sum('trade_value_sgd_million')}, 0) AS total_sgd_million
FROM bronze_trade_raw WHERE trade_type = 'exports' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"""),
    "annual_scorecard": _scorecard("avg_inflation", "imports_sgd_bn"),
    "annual_analysis": _scorecard("avg_cpi_yoy", "total_imports_sgd_bn"),
    "sourcing_signal": W(O.SERVING, """
SELECT period_date, round(usd_sgd, 4) AS usd_sgd, round(cny_sgd, 4) AS cny_sgd,
       round(ge_usd_budget_m, 1) AS ge_usd_m, round(mindray_cny_budget_m, 0) AS mindray_cny_m,
       CASE WHEN usd_sgd < 1.30 THEN 'Favour US' WHEN usd_sgd > 1.40 THEN 'Favour China'
            ELSE 'Neutral' END AS signal
FROM export WHERE usd_sgd IS NOT NULL AND cny_sgd IS NOT NULL AND period_year >= 2000"""),
    "scatter_regime": W(O.SERVING, f"""
SELECT period_date, round(usd_sgd, 4) AS usd_sgd, round(cpi_yoy_pct * 100, 2) AS cpi_inflation,
       {_band('cpi_yoy_pct', SCATTER)} AS inflation_regime
FROM export WHERE usd_sgd IS NOT NULL AND cpi_yoy_pct IS NOT NULL"""),
    "inflation_history": W(O.SERVING, """
SELECT period_date, round(cpi_yoy_pct * 100, 2) AS inflation FROM export
WHERE cpi_yoy_pct IS NOT NULL AND period_year >= 1999"""),
    "cpi_history": W(O.SERVING, """
SELECT period_date, round(cpi_yoy_pct * 100, 2) AS cpi_yoy FROM export WHERE cpi_yoy_pct IS NOT NULL"""),
    "fx_rate_history": W(O.SERVING, """
SELECT period_date, round(usd_sgd, 4) AS fx_rate FROM export
WHERE usd_sgd IS NOT NULL AND period_year >= 1999"""),
    "fx_history": W(O.SERVING, """
SELECT period_date, round(usd_sgd, 4) AS usd_sgd, round(cny_sgd, 4) AS cny_sgd,
       round(usd_cny_ratio, 2) AS usd_cny_ratio FROM export WHERE usd_sgd IS NOT NULL"""),
    "trade_history": W(O.SERVING, """
SELECT period_date, round(imports_sgd_bn, 1) AS imports_sgd_bn FROM export WHERE imports_sgd_bn IS NOT NULL"""),
    "log_series": W(O.SERVING, """
SELECT period_date, round(ln(imports_sgd_bn), 3) AS imports_log FROM export
WHERE imports_sgd_bn IS NOT NULL AND imports_sgd_bn > 0"""),
    "balance_status": W(O.GOLD, """
SELECT period_date, total_exports_sgd, total_imports_sgd, trade_balance_sgd,
       if(coalesce(trade_balance_sgd, 0) > 0, 'Surplus', 'Deficit') AS balance_status
FROM fact WHERE total_exports_sgd IS NOT NULL
QUALIFY row_number() OVER (ORDER BY period_date DESC) <= 6"""),
    "yearly_averages": W(O.GOLD, f"""
SELECT * EXCLUDE age FROM (
  SELECT DISTINCT period_year, round({_over('cpi_yoy_pct', 'avg')}, 2) AS avg_cpi_yoy_pct,
         round({_over('usd_sgd_rate', 'avg')}, 4) AS avg_usd_sgd,
         round({_over('total_imports_sgd', 'avg')}, 0) AS avg_monthly_imports,
         dense_rank() OVER (ORDER BY period_year DESC) AS age
  FROM fact WHERE usd_sgd_rate + total_imports_sgd IS NOT NULL) y
WHERE age <= 10"""),
    "table_profile": W([O.BRONZE_CPI, O.BRONZE_FX, O.BRONZE_TRADE],
                       _profile("bronze_cpi_raw", "cpi_category", "time_period", "%Y %b", "cpi_value")
                       + "\nUNION ALL" + _profile("bronze_fx_raw", "currency_pair", "rate_month", "%Y%b",
                                                  "exchange_rate")
                       + "\nUNION ALL" + _profile("bronze_trade_raw", "commodity_category", "trade_month",
                                                  "%Y%b", "trade_value_sgd_million")),
    "gold_coverage": W(O.GOLD, """
SELECT COUNT(*) AS total_rows, MIN(period_date) AS earliest, MAX(period_date) AS latest,
       COUNT(usd_sgd_rate) AS fx_rows, COUNT(total_imports_sgd) AS trade_rows FROM fact"""),
    "silver_cpi_sample": W([O.BRONZE_CPI, O.STG_CPI], """
SELECT cpi_category, period_date, cpi_value, cpi_mom_change, cpi_yoy_pct FROM stg_cpi
WHERE cpi_category = 'All Items' ORDER BY period_date DESC LIMIT 6"""),
    "silver_fx_sample": W([O.BRONZE_FX, O.STG_FX], """
SELECT currency_pair, period_date, sgd_per_foreign_unit, foreign_units_per_sgd FROM stg_fx
WHERE currency_pair = 'US Dollar' ORDER BY period_date DESC LIMIT 6"""),
    "silver_trade_sample": W([O.BRONZE_TRADE, O.STG_TRADE], """
SELECT trade_type, commodity_category, period_date, trade_value_sgd_million FROM stg_trade
WHERE commodity_category IN ('Total Merchandise Imports', 'Total Merchandise Exports')
ORDER BY period_date DESC, trade_type, commodity_category LIMIT 8"""),
    "distinct_pairs": W([O.BRONZE_TRADE], "SELECT DISTINCT trade_type, commodity_category FROM bronze_trade_raw"),
    "count_by_key": W([O.BRONZE_TRADE], "SELECT trade_type, COUNT(*) AS rows FROM bronze_trade_raw GROUP BY 1"),
    "quality_report": _report(MODEL_CHECKS),
    "quality_extra": _report(EXTRA_CHECKS),
    "layer_counts": W(O.GOLD + [LAYERS], "SELECT * FROM layer_counts"),
    "medallion_layers": W(O.GOLD + [LAYERS],
                          "SELECT layer, CAST(SUM(row_count) AS BIGINT) AS total_rows FROM layer_counts GROUP BY 1"),
    "test_summary": W(O.GOLD, f"""
SELECT COUNT(*) AS tests, COUNT(*) FILTER (WHERE status = 'PASS') AS passing,
       COUNT(DISTINCT model) AS models_tested,
       round(COUNT(*) FILTER (WHERE status = 'PASS') * 100.0 / COUNT(*), 1) AS pass_rate
FROM ({_checks_sql(MODEL_CHECKS)}) r"""),
    "latest_snapshot": W(LOADS, """
SELECT cpi_category, time_period, arg_max(cpi_value, ingested_at) AS cpi_value,
       MAX(ingested_at) AS ingested_at
FROM (SELECT * FROM earlier UNION ALL SELECT * FROM later) u GROUP BY 1, 2"""),
    "replace_period": W(LOADS, """
SELECT * FROM earlier WHERE CAST(strptime(time_period, '%Y %b') AS DATE) < DATE '1998-01-01'
UNION ALL
SELECT * FROM later WHERE CAST(strptime(time_period, '%Y %b') AS DATE) >= DATE '1998-01-01'"""),
    "incremental_months": W([_cpi_bronze_sql("stored0", "o_orderdate < TIMESTAMP '1999-01-01'", TS1),
                             _cpi_bronze_sql("incoming0", "TRUE", O.TS)], """
, stored AS (SELECT *, CAST(strptime(time_period, '%Y %b') AS DATE) AS period_date FROM stored0),
incoming AS (SELECT *, CAST(strptime(time_period, '%Y %b') AS DATE) AS period_date FROM incoming0)
SELECT * FROM stored
UNION ALL
SELECT * FROM incoming
WHERE (SELECT MAX(period_date) FROM stored) IS NULL OR period_date > (SELECT MAX(period_date) FROM stored)"""),
    "annual_summary": W(O.GOLD, f"""
SELECT CAST(year(period_date) AS INTEGER) AS year, round({_exact_avg('usd_sgd_rate')}, 4) AS avg_usd_sgd,
       round({_exact_avg('cpi_value')}, 3) AS avg_cpi,
       {_exact_sum('trade_balance_sgd')} AS total_trade_balance
FROM fact GROUP BY 1"""),
    "annual_balance": W(O.GOLD, f"""
SELECT period_year, {_exact_sum('total_exports_sgd')} AS exports_sgd,
       {_exact_sum('total_imports_sgd')} AS imports_sgd, {_exact_sum('trade_balance_sgd')} AS trade_balance_sgd
FROM fact GROUP BY 1"""),
    "category_breakdown": W([O.BRONZE_CPI, O.STG_CPI], """
SELECT period_date,
       MAX(cpi_yoy_pct) FILTER (WHERE cpi_category = '1-URGENT') AS urgent,
       MAX(cpi_yoy_pct) FILTER (WHERE cpi_category = '2-HIGH') AS high,
       MAX(cpi_yoy_pct) FILTER (WHERE cpi_category = '3-MEDIUM') AS medium,
       MAX(cpi_yoy_pct) FILTER (WHERE cpi_category = '4-NOT SPECIFIED') AS not_specified,
       MAX(cpi_yoy_pct) FILTER (WHERE cpi_category = '5-LOW') AS low,
       MAX(cpi_yoy_pct) FILTER (WHERE cpi_category = 'All Items') AS all_items
FROM stg_cpi
WHERE cpi_category IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW', 'All Items')
GROUP BY period_date"""),
    "rate_correlation": W([O.BRONZE_CPI, O.STG_CPI, O.BRONZE_FX, O.STG_FX], """
SELECT f.currency_pair, COUNT(*) AS months, round(corr(f.sgd_per_foreign_unit, c.cpi_yoy_pct), 4) AS correlation
FROM stg_fx f JOIN (SELECT period_date, cpi_yoy_pct FROM stg_cpi
                    WHERE cpi_category = 'All Items' AND cpi_yoy_pct IS NOT NULL) c
  ON f.period_date = c.period_date
GROUP BY f.currency_pair"""),
    "freshness": """
SELECT event_type, last_loaded, days_stale, days_stale > 35 AS is_stale FROM (
  SELECT event_type, MAX(ts) AS last_loaded,
         date_diff('day', CAST(MAX(ts) AS DATE), DATE '2024-03-05') AS days_stale
  FROM events GROUP BY event_type) f""",
})


PROFILES = ("profiles AS (" + _profile("bronze_cpi_raw", "cpi_category", "time_period", "%Y %b", "cpi_value")
            + "\nUNION ALL" + _profile("bronze_fx_raw", "currency_pair", "rate_month", "%Y%b", "exchange_rate")
            + "\nUNION ALL" + _profile("bronze_trade_raw", "commodity_category", "trade_month", "%Y%b",
                                       "trade_value_sgd_million") + ")")

ORACLE.update({
    "source_stats": W([O.BRONZE_CPI, O.BRONZE_FX, O.BRONZE_TRADE, PROFILES], """
SELECT CASE table_name WHEN 'bronze_cpi_raw' THEN 'SingStat' WHEN 'bronze_fx_raw' THEN 'MAS'
                       WHEN 'bronze_trade_raw' THEN 'Enterprise SG' END AS source,
       CASE table_name WHEN 'bronze_cpi_raw' THEN 'CPI by category'
                       WHEN 'bronze_fx_raw' THEN 'SGD exchange rates'
                       WHEN 'bronze_trade_raw' THEN 'Merchandise trade' END AS dataset,
       'Monthly' AS frequency, CAST(year(first_month) AS VARCHAR) AS since,
       row_count AS rows, categories
FROM profiles"""),
    "rows_by_source": W([O.BRONZE_CPI, O.BRONZE_FX, O.BRONZE_TRADE, PROFILES], """
SELECT CASE table_name WHEN 'bronze_cpi_raw' THEN 'CPI' WHEN 'bronze_fx_raw' THEN 'FX Rates'
                       WHEN 'bronze_trade_raw' THEN 'Trade' END AS source, row_count AS rows
FROM profiles"""),
    "test_results": W(O.GOLD, f"""
SELECT test || ' \u2014 ' || column_name AS test_name, {FACT_NAME}, status, rows_checked
FROM ({_checks_sql(MODEL_CHECKS)}) r"""),
})

ORACLE.update({
    "latest_row": W(O.GOLD, "SELECT * FROM fact WHERE cpi_yoy_pct IS NOT NULL ORDER BY period_date DESC LIMIT 1"),
    "series_history": W(O.SERVING, """
SELECT period_date, round(cpi_yoy_pct * 100, 2) AS inflation, round(usd_sgd, 4) AS usd_sgd,
       round(imports_sgd_bn, 1) AS imports_sgd_bn
FROM export WHERE cpi_yoy_pct IS NOT NULL OR usd_sgd IS NOT NULL OR imports_sgd_bn IS NOT NULL"""),
})

GAPS = """
fact_gaps AS (
  SELECT * REPLACE (if(month(period_date) <= 3, NULL, usd_sgd_rate) AS usd_sgd_rate,
                    if(month(period_date) <= 3, NULL, sgd_strength_vs_usd) AS sgd_strength_vs_usd,
                    if(month(period_date) <= 3, NULL, cny_sgd_rate) AS cny_sgd_rate,
                    if(month(period_date) >= 11, NULL, total_exports_sgd) AS total_exports_sgd,
                    if(month(period_date) >= 11, NULL, trade_balance_sgd) AS trade_balance_sgd,
                    if(month(period_date) >= 11, NULL, trade_openness_ratio) AS trade_openness_ratio)
  FROM fact)"""

ORACLE.update({
    "landed_cpi": W([O.BRONZE_CPI], """
SELECT cpi_category, time_period, ingested_at,
       CASE WHEN cpi_category = '5-LOW' AND time_period LIKE '% Dec' THEN NULL ELSE cpi_value END AS cpi_value
FROM bronze_cpi_raw WHERE cpi_category <> 'All Items'"""),
    "landed_trade": W([O.BRONZE_TRADE], """
SELECT * FROM bronze_trade_raw
WHERE commodity_category LIKE 'Flag %' AND NOT (commodity_category = 'Flag A' AND trade_month LIKE '%Feb')"""),
    "macro_fact_gaps": W(O.GOLD + [GAPS], "SELECT * FROM fact_gaps"),
    "balance_status_gaps": W(O.GOLD + [GAPS], """
SELECT period_date, total_imports_sgd, trade_balance_sgd,
       if(coalesce(trade_balance_sgd, 0) > 0, 'Surplus', 'Deficit') AS balance_status FROM fact_gaps"""),
    "sourcing_bands": W(O.SERVING, """
SELECT period_date, rate AS usd_sgd, round(cny_sgd, 4) AS cny_sgd, round(ge_usd_budget_m, 1) AS ge_usd_m,
       round(mindray_cny_budget_m, 0) AS mindray_cny_m,
       CASE WHEN rate < 1.30 THEN 'Favour US' WHEN rate > 1.40 THEN 'Favour China' ELSE 'Neutral' END AS signal
FROM (SELECT *, round(usd_sgd * (18 + month(period_date) % 4) / 20, 4) AS rate FROM export
      WHERE usd_sgd IS NOT NULL AND cny_sgd IS NOT NULL) e"""),
    "recent_scorecard": _scorecard("avg_inflation", "imports_sgd_bn", 2),
    "top_trade_lines": W([O.BRONZE_TRADE], """
SELECT commodity_category, total_sgd_million FROM (
  SELECT commodity_category, round(CAST(sum(CAST(trade_value_sgd_million AS DECIMAL(38,6))) AS DOUBLE), 0) AS total_sgd_million
  FROM bronze_trade_raw WHERE trade_type = 'imports' GROUP BY 1) t
QUALIFY row_number() OVER (ORDER BY total_sgd_million DESC, commodity_category) <= 2"""),
    "quality_bronze": W([O.BRONZE_CPI, O.BRONZE_FX], f"""
SELECT *, if(failures = 0, 'PASS', 'FAIL') AS status FROM ({" UNION ALL ".join([
        _check_sql("bronze_cpi_raw", "cpi_value", "not_null"), _check_sql("bronze_cpi_raw", "time_period", "unique"),
        _check_sql("bronze_fx_raw", "currency_pair", "accepted_values", O.CURRENCIES)])}) r"""),
    "freshness_by_user": """
SELECT user_id, max(ts) AS last_loaded, date_diff('day', CAST(max(ts) AS DATE), DATE '2024-02-15') AS days_stale,
       date_diff('day', CAST(max(ts) AS DATE), DATE '2024-02-15') > 35 AS is_stale
FROM events GROUP BY user_id""",
    "silver_catalogue": W([O.BRONZE_TRADE, O.STG_TRADE], "SELECT trade_type, commodity_category FROM stg_trade GROUP BY ALL"),
    "trade_types": W([O.BRONZE_TRADE], "SELECT trade_type FROM bronze_trade_raw GROUP BY 1"),
    "export_categories": W([O.BRONZE_TRADE], "SELECT commodity_category FROM bronze_trade_raw WHERE trade_type = 'exports' GROUP BY 1"),
    "currency_list": W([O.BRONZE_FX], "SELECT currency_pair FROM bronze_fx_raw GROUP BY 1"),
    "load_categories": W([O.BRONZE_CPI, O.BRONZE_FX, O.BRONZE_TRADE], " UNION ALL ".join(f"""
SELECT '{t}' AS table_name, count(DISTINCT {c}) AS categories, string_agg(DISTINCT {c}, ', ' ORDER BY {c}) AS names FROM {t}"""
        for t, c in (("bronze_cpi_raw", "cpi_category"), ("bronze_fx_raw", "currency_pair"),
                     ("bronze_trade_raw", "commodity_category")))),
    "cpi_sample": W([O.BRONZE_CPI], "SELECT * FROM bronze_cpi_raw QUALIFY row_number() OVER (ORDER BY cpi_category, time_period) <= 5"),
    "fx_sample": W([O.BRONZE_FX], "SELECT * FROM bronze_fx_raw QUALIFY row_number() OVER (ORDER BY currency_pair, rate_month) <= 5"),
    "data_quality_score": W(O.GOLD, f"""
SELECT count(*) AS tests, count(*) FILTER (WHERE failures = 0) AS passing,
       round(count(*) FILTER (WHERE failures = 0) * 100.0 / count(*), 1) AS pass_rate,
       (SELECT (count(*) > 0)::BIGINT FROM bronze_cpi_raw) + (SELECT (count(*) > 0)::BIGINT FROM bronze_fx_raw)
         + (SELECT (count(*) > 0)::BIGINT FROM bronze_trade_raw) AS sources_monitored
FROM ({" UNION ALL ".join(_check_sql(*c) for c in MODEL_CHECKS)}) r"""),
    **{f"{name}_ordered": W(O.SERVING, f"SELECT count(*) OVER (ORDER BY period_date) AS position, * FROM ({body}) s")
       for name, body in (
           ("inflation", "SELECT period_date, round(cpi_yoy_pct * 100, 2) AS cpi_yoy FROM export WHERE cpi_yoy_pct IS NOT NULL"),
           ("fx", "SELECT period_date, round(usd_sgd, 4) AS usd_sgd, round(cny_sgd, 4) AS cny_sgd, "
                  "round(usd_cny_ratio, 2) AS usd_cny_ratio FROM export WHERE usd_sgd IS NOT NULL"),
           ("trade", "SELECT period_date, round(imports_sgd_bn, 1) AS imports_sgd_bn FROM export WHERE imports_sgd_bn IS NOT NULL"))},
})

# The state after two loads: the later value where there is one.
STATE = """
bronze_cpi_raw AS (
  SELECT cpi_category, time_period, coalesce(later.cpi_value, first_load.cpi_value) AS cpi_value,
         coalesce(later.ingested_at, first_load.ingested_at) AS ingested_at
  FROM first_load FULL JOIN later USING (cpi_category, time_period))"""
TWO_LOADS = [_cpi_bronze_sql("first_load", "o_orderdate < TIMESTAMP '2000-01-01'", TS1),
             _cpi_bronze_sql("later", "o_orderstatus = 'F'", O.TS), STATE]

ORACLE.update({
    "released_fact": ORACLE["macro_fact"],
    "release_report": ORACLE["quality_report"],
    "incremental_fact": W([*TWO_LOADS, O.BRONZE_FX, O.BRONZE_TRADE, O.STG_CPI, O.STG_FX, O.STG_TRADE, O.FACT], "SELECT * FROM fact"),
    "current_cpi_state": ORACLE["latest_snapshot"],
    "affected_months": W(TWO_LOADS, f"""
, old AS (SELECT CAST(strptime(time_period, '%Y %b') AS DATE) AS d, cpi_value FROM first_load WHERE cpi_category = {O.HEADLINE}),
placed AS (
  SELECT d, new.cpi_value, row_number() OVER (ORDER BY d) AS place,
         CASE WHEN old.d IS NULL THEN 'inserted' WHEN old.cpi_value <> new.cpi_value THEN 'revised' END AS change
  FROM (SELECT CAST(strptime(time_period, '%Y %b') AS DATE) AS d, cpi_value FROM bronze_cpi_raw
        WHERE cpi_category = {O.HEADLINE}) new LEFT JOIN old USING (d))
SELECT a.d AS period_date, a.change FROM placed a
WHERE a.change IS NOT NULL
   OR a.place IN (SELECT place + 1 FROM placed WHERE change = 'revised')
   OR a.place IN (SELECT place + 12 FROM placed WHERE change = 'revised')
   OR a.place IN (SELECT place + unnest(range(1, 13)) FROM placed WHERE change = 'inserted')"""),
    "monthly_changes_by_range": ORACLE["monthly_mom_yoy"],
    "daily_changes_by_range": """
WITH daily AS (
  SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'all' ELSE o_orderpriority END AS series, CAST(o_orderdate AS DATE) AS day,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(38,2))) AS DOUBLE) AS value
  FROM orders GROUP BY 1, 2)
SELECT series, day, value, round(value - lag(value) OVER w, 3) AS day_change,
       CASE WHEN lag(value, 12) OVER w <> 0
            THEN round((value - lag(value, 12) OVER w) / lag(value, 12) OVER w * 100, 2) END AS pct_12_days
FROM daily WINDOW w AS (PARTITION BY series ORDER BY day)""",
    "trade_report": W([O.BRONZE_TRADE], """
, dated AS (SELECT *, CAST(strptime(trade_month, '%Y%b') AS DATE) AS month, trade_value_sgd_million AS v FROM bronze_trade_raw),
figures AS (""" + " UNION ALL ".join(f"""
  SELECT '{level}' AS level, {a} AS trade_type, {b} AS commodity_category, count(*) AS row_count,
         count(*) FILTER (WHERE v IS NULL) AS null_values, round(CAST(sum(CAST(v AS DECIMAL(38,6))) AS DOUBLE), 0) AS total_sgd_million,
         min(month) AS first_month, max(month) AS last_month
  FROM dated GROUP BY ALL HAVING count(*) > 0""" for level, a, b in (
        ("line", "trade_type", "commodity_category"), ("type", "trade_type", "CAST(NULL AS VARCHAR)"),
        ("category", "CAST(NULL AS VARCHAR)", "commodity_category"), ("table", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)"))) + """)
SELECT *, CASE WHEN level = 'line' THEN row_number() OVER (
           PARTITION BY level, trade_type ORDER BY total_sgd_million DESC NULLS LAST, commodity_category NULLS LAST) ELSE 0 END AS place
FROM figures"""),
    "load_statistics": W([O.BRONZE_CPI, O.BRONZE_FX, O.BRONZE_TRADE, PROFILES], " UNION ALL ".join(f"""
SELECT p.*, n.names FROM profiles p, (SELECT string_agg(DISTINCT {c}, ', ' ORDER BY {c}) AS names FROM {t}) n WHERE p.table_name = '{t}'"""
        for t, c in (("bronze_cpi_raw", "cpi_category"), ("bronze_fx_raw", "currency_pair"), ("bronze_trade_raw", "commodity_category")))),
    "landed_pages": ORACLE["landed_trade"],
    "page_sets": """
WITH pages AS (
  SELECT o_orderpriority AS dataset, CAST(o_orderkey % 60 + 1 AS INTEGER) AS page, least(count(*), 4) AS n FROM orders GROUP BY 1, 2),
kept AS (SELECT * FROM pages WHERE NOT (page % 7 = 3 AND dataset <> '5-LOW')),
marked AS (
  SELECT *, lead(page) OVER w AS next,
         coalesce(sum(n) OVER (PARTITION BY dataset ORDER BY page ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS after
  FROM kept WINDOW w AS (PARTITION BY dataset ORDER BY page)),
census AS (
  SELECT dataset, count(*) AS pages, CAST(sum(n) AS BIGINT) AS records, max(page) AS last_page,
         CAST(max(page) - count(DISTINCT page) AS BIGINT) AS missing, count(*) - count(DISTINCT page) AS repeated,
         count(*) FILTER (WHERE n < 3 AND after > 0) AS short, count(*) FILTER (WHERE n > 3) AS oversized,
         arg_max(n, page) >= 3 AS open_end
  FROM marked GROUP BY dataset)
SELECT *, missing + repeated + short + oversized = 0 AND NOT open_end AS complete FROM census""",
})
