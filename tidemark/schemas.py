"""Explicit schemas of the landed payloads and of every stored table."""

from pyspark.sql import types as T

S, D, I, TS, DT = T.StringType(), T.DoubleType(), T.IntegerType(), T.TimestampType(), T.DateType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Landed CPI payload: Data.row[] {rowText, columns[] {key, value}}
CPI_PAYLOAD = _struct(("Data", _struct(("row", T.ArrayType(_struct(
    ("rowText", S),
    ("columns", T.ArrayType(_struct(("key", S), ("value", S)))),
))))))

# Landed record page (FX, trade): result.records[] of {column: text}; the
# month columns vary, so a record is read as a map instead of a struct.
RECORD_PAGE = _struct(("result", _struct(("records", T.ArrayType(T.MapType(S, S))))))

BRONZE_CPI = _struct(("cpi_category", S), ("time_period", S), ("cpi_value", D), ("ingested_at", TS))
BRONZE_FX = _struct(("currency_pair", S), ("rate_month", S), ("exchange_rate", D), ("ingested_at", TS))
BRONZE_TRADE = _struct(("commodity_category", S), ("trade_type", S), ("trade_month", S),
                       ("trade_value_sgd_million", D), ("ingested_at", TS))

STG_CPI = _struct(("cpi_category", S), ("period_date", DT), ("period_year", I), ("period_month", I),
                  ("cpi_value", D), ("ingested_at", TS), ("cpi_mom_change", D), ("cpi_yoy_pct", D))
STG_FX = _struct(("currency_pair", S), ("period_date", DT), ("period_year", I), ("period_month_abbr", S),
                 ("sgd_per_foreign_unit", D), ("foreign_units_per_sgd", D), ("ingested_at", TS))
STG_TRADE = _struct(("trade_type", S), ("commodity_category", S), ("period_date", DT), ("period_year", I),
                    ("period_month_abbr", S), ("trade_value_sgd_million", D), ("ingested_at", TS))
DIM_CALENDAR = _struct(("period_date", DT), ("year", I), ("month_num", I), ("month_abbr", S),
                       ("month_name", S), ("quarter", S), ("sg_trade_season", S))
FACT = _struct(("period_date", DT), ("period_year", I), ("period_month", I), ("cpi_value", D),
               ("cpi_mom_change", D), ("cpi_yoy_pct", D), ("usd_sgd_rate", D), ("sgd_strength_vs_usd", D),
               ("cny_sgd_rate", D), ("total_imports_sgd", D), ("total_exports_sgd", D),
               ("trade_balance_sgd", D), ("trade_openness_ratio", D), ("month_name", S),
               ("month_abbr", S), ("quarter", S), ("sg_trade_season", S))
EXPORT = _struct(("period_date", DT), ("period_year", I), ("period_month", I), ("month_name", S),
                 ("quarter", S), ("sg_trade_season", S), ("cpi_index", D), ("cpi_yoy_pct", D),
                 ("cpi_mom_pct", D), ("usd_sgd", D), ("cny_sgd", D), ("usd_cny_ratio", D),
                 ("imports_sgd_bn", D), ("exports_sgd_bn", D), ("trade_balance_sgd_bn", D),
                 ("ge_usd_budget_m", D), ("mindray_cny_budget_m", D))
