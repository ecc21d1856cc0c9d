"""Sources, sinks, flows and the streaming landing loader on scratch folders."""

import datetime as dt
import json
import os

import pytest
from pyspark.errors import PySparkException

from tidemark.plans import flows
from tidemark.sinks import tables as sinks
from tidemark.sources import landed
from tidemark.streaming.landing import load_cpi_landing

T1 = dt.datetime(2024, 5, 1, 8, 0)
T1_LATER = dt.datetime(2024, 5, 1, 18, 0)
T2 = dt.datetime(2024, 5, 2, 8, 0)


def write_json(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        json.dump(obj, fh)
    return path


def cpi_payload(rows):
    return {"Data": {"row": [{"rowText": cat, "columns": [{"key": k, "value": v} for k, v in obs]}
                             for cat, obs in rows]}}


def page(records):
    return {"result": {"records": records}}


def test_cpi_payload_flatten(spark, scratch):
    p = write_json(f"{scratch}/cpi/p1.json", cpi_payload([
        ("All Items", [("2024 Jan", "99.1"), ("2024 Feb", "na"), ("2024 Mar", "")]),
        ("Food", [("2024 Jan", "101.5")])]))
    rows = landed.read_cpi_payload(spark, p, T1).collect()
    assert len(rows) == 4
    got = {(r.cpi_category, r.time_period): r.cpi_value for r in rows}
    assert got[("All Items", "2024 Jan")] == 99.1 and got[("All Items", "2024 Feb")] is None
    assert got[("All Items", "2024 Mar")] is None and got[("Food", "2024 Jan")] == 101.5
    assert all(r.ingested_at == T1 for r in rows)


def test_cpi_payload_bad_value_fails(spark, scratch):
    p = write_json(f"{scratch}/cpi/bad.json", cpi_payload([("All Items", [("2024 Jan", "x")])]))
    with pytest.raises(PySparkException):
        landed.read_cpi_payload(spark, p, T1).collect()


def test_fx_pages_melt(spark, scratch):
    p1 = write_json(f"{scratch}/fx/p1.json", page([
        {"_id": "1", "DataSeries": "US Dollar", "2024Jan": "1.34", "2024Feb": "", "2024Mar": "na"},
        {"_id": "2", "DataSeries": "Euro", "2024Jan": "1,000", "2024Feb": "1.46"}]))
    p2 = write_json(f"{scratch}/fx/p2.json", page([{"_id": "3", "DataSeries": "Renminbi", "2024Jan": "0.19"}]))
    rows = landed.read_fx_pages(spark, [p1, p2], T1).collect()
    got = sorted((r.currency_pair, r.rate_month, r.exchange_rate) for r in rows)
    assert got == [("Euro", "2024Feb", 1.46), ("Renminbi", "2024Jan", 0.19), ("US Dollar", "2024Jan", 1.34)]


def test_page_without_result_fails(spark, scratch):
    p = write_json(f"{scratch}/fx/bad.json", {"success": False})
    with pytest.raises(PySparkException):
        landed.read_fx_pages(spark, p, T1).collect()


def test_trade_pages_harmonise_headers(spark, scratch):
    imp = write_json(f"{scratch}/imp/p.json", page([
        {"_id": "1", "DataSeries": "Total Merchandise Imports", "2024Jan": "51000.5"}]))
    exp = write_json(f"{scratch}/exp/p.json", page([
        {"_id": "1", "Data Series Text": "Machinery", "2024Jan": "20000", "2024Feb": "na"}]))
    rows = landed.read_trade_pages(spark, imp, exp, T1).collect()
    assert sorted((r.commodity_category, r.trade_type, r.trade_month, r.trade_value_sgd_million)
                  for r in rows) == [("Machinery", "exports", "2024Jan", 20000.0),
                                     ("Total Merchandise Imports", "imports", "2024Jan", 51000.5)]


def test_daily_append_is_rerunnable(spark, scratch):
    path = f"{scratch}/bronze_cpi_raw"
    schema = "cpi_category string, time_period string, cpi_value double, ingested_at timestamp"
    day1 = spark.createDataFrame([("A", "2024 Jan", 1.0, T1), ("A", "2024 Feb", 2.0, T1)], schema)
    assert sinks.append_daily(day1, path)["rows"] == 2
    replay = spark.createDataFrame([("A", "2024 Jan", 1.5, T1_LATER), ("A", "2024 Feb", 2.5, T1_LATER)], schema)
    sinks.append_daily(replay, path)
    assert sinks.read_bronze(spark, path).count() == 2             # same-day replay: no extra rows
    day2 = spark.createDataFrame([("A", "2024 Jan", 1.6, T2)], schema)
    sinks.append_daily(day2, path)
    assert sorted(r.cpi_value for r in sinks.read_bronze(spark, path).collect()) == [1.5, 1.6, 2.5]


def test_export_csv_round_trip(spark, scratch):
    from tidemark.plans.layers import MacroLayers
    export = MacroLayers(spark, "/root/testdata/sf0.001").export
    sinks.write_export_csv(export, f"{scratch}/macro_monthly")
    files = [f for f in os.listdir(f"{scratch}/macro_monthly") if f.endswith(".csv")]
    assert len(files) == 1
    with open(f"{scratch}/macro_monthly/{files[0]}") as fh:
        lines = fh.read().splitlines()
    assert lines[0].split(",")[:3] == ["period_date", "period_year", "period_month"]
    dates = [ln.split(",")[0] for ln in lines[1:]]
    assert dates == sorted(dates) and len(dates) == export.count()
    back = landed.read_export_csv(spark, f"{scratch}/macro_monthly")
    assert sorted(back.collect()) == sorted(export.collect())


def test_load_build_export_flow(spark, scratch):
    ms = [dt.date(1998 + (i // 12), i % 12 + 1, 1) for i in range(20)]
    cpi = write_json(f"{scratch}/land/cpi.json", cpi_payload([
        ("All Items", [(d.strftime("%Y %b"), str(100 + i)) for i, d in enumerate(ms)])]))
    fx = write_json(f"{scratch}/land/fx.json", page([
        {"_id": "1", "DataSeries": "US Dollar", **{d.strftime("%Y%b"): "1.35" for d in ms}},
        {"_id": "2", "DataSeries": "Renminbi", **{d.strftime("%Y%b"): "0.2" for d in ms}}]))
    imp = write_json(f"{scratch}/land/imp.json", page([
        {"_id": "1", "DataSeries": "Total Merchandise Imports", **{d.strftime("%Y%b"): "40000" for d in ms}}]))
    exp = write_json(f"{scratch}/land/exp.json", page([
        {"_id": "1", "Data Series Text": "Machinery", **{d.strftime("%Y%b"): "30000" for d in ms}},
        {"_id": "2", "Data Series Text": "Chemicals", **{d.strftime("%Y%b"): "15000" for d in ms}}]))
    stats = flows.load_sources(spark, cpi_files=cpi, fx_files=fx, imports_files=imp, exports_files=exp,
                               bronze_dir=f"{scratch}/bronze", run_ts=T1)
    assert {t: s["rows"] for t, s in stats.items()} == {"bronze_cpi_raw": 20, "bronze_fx_raw": 40,
                                                        "bronze_trade_raw": 60}
    assert stats["bronze_trade_raw"]["first_month"] == dt.date(1998, 1, 1)
    assert stats["bronze_cpi_raw"]["last_month"] == dt.date(1999, 8, 1)
    # a second CPI load day: the latest snapshot keeps the fact unique
    flows.load_sources(spark, cpi_files=cpi, fx_files=fx, imports_files=imp, exports_files=exp,
                       bronze_dir=f"{scratch}/bronze", run_ts=T2)
    report = flows.build_and_export(spark, bronze_dir=f"{scratch}/bronze", gold_dir=f"{scratch}/gold",
                                    export_path=f"{scratch}/export", calendar_end="2000-12-01")
    assert report.where("status != 'PASS'").count() == 0 and report.count() == 15
    fact = flows.read_gold(spark, f"{scratch}/gold", "fct_sg_macro_monthly")
    assert fact.count() == 8                                     # 1999-01 .. 1999-08
    e = landed.read_export_csv(spark, f"{scratch}/export").orderBy("period_date").first()
    assert e.imports_sgd_bn == 0.04 and e.exports_sgd_bn == 0.05 and e.usd_sgd == 1.35


def test_build_stops_on_failed_test(spark, scratch):
    from tidemark.operators.quality import DataTestFailure
    ms = [dt.date(1999, m, 1) for m in range(1, 4)]
    cpi = write_json(f"{scratch}/land/cpi.json", cpi_payload([
        ("All Items", [(d.strftime("%Y %b"), "100") for d in ms])]))
    fx = write_json(f"{scratch}/land/fx.json", page([{"_id": "1", "DataSeries": "US Dollar", "1999Jan": "1.3"}]))
    imp = write_json(f"{scratch}/land/imp.json", page([
        {"_id": "1", "DataSeries": "Total Merchandise Imports", "1999Jan": "1"},
        {"_id": "2", "DataSeries": "Total Merchandise Imports", "1999Jan": "2"}]))   # duplicate month
    exp = write_json(f"{scratch}/land/exp.json", page([{"_id": "1", "Data Series Text": "X", "1999Jan": "1"}]))
    flows.load_sources(spark, cpi_files=cpi, fx_files=fx, imports_files=imp, exports_files=exp,
                       bronze_dir=f"{scratch}/bronze", run_ts=T1)
    with pytest.raises(DataTestFailure, match="unique"):
        flows.build_and_export(spark, bronze_dir=f"{scratch}/bronze", gold_dir=f"{scratch}/gold",
                               export_path=f"{scratch}/export", calendar_end="1999-12-01")
    assert not os.path.exists(f"{scratch}/export")


def test_streaming_landing_loads_each_file_once(spark, scratch):
    land, bronze, ckpt = f"{scratch}/landing", f"{scratch}/bronze_cpi_raw", f"{scratch}/ckpt"
    write_json(f"{land}/a.json", cpi_payload([("All Items", [("2024 Jan", "99.1"), ("2024 Feb", "99.5")])]))
    load_cpi_landing(spark, land, bronze, ckpt, run_ts=T1)
    assert sinks.read_bronze(spark, bronze).count() == 2
    load_cpi_landing(spark, land, bronze, ckpt, run_ts=T1)        # nothing new: no change
    assert sinks.read_bronze(spark, bronze).count() == 2
    write_json(f"{land}/b.json", cpi_payload([("Food", [("2024 Jan", "101.0")])]))
    load_cpi_landing(spark, land, bronze, ckpt, run_ts=T2)
    assert sinks.read_bronze(spark, bronze).count() == 3


def test_views_listing_audit_columns_and_sample(spark, scratch):
    from tidemark.plans import audit
    from tidemark.plans.layers import MacroLayers
    p = MacroLayers(spark, "/root/testdata/sf0.001")
    sinks.register_views({"stg_fx_view": p.stg_fx})
    names = {r.tableName for r in landed.list_tables(spark).collect()}
    assert "stg_fx_view" in names
    assert spark.sql("SELECT COUNT(*) AS n FROM stg_fx_view").first().n == p.stg_fx.count()
    audited = landed.with_audit_columns(p.stg_fx, source_api="fx_pages_v1", loaded_at=T1)
    rows = audited.select("loaded_at", "source_api", "batch_id").distinct().collect()
    assert len(rows) == 1 and rows[0].source_api == "fx_pages_v1" and rows[0].loaded_at == T1
    sample = audit.trade_sample(p.bronze["bronze_trade_raw"]).collect()
    assert len(sample) == 5 and all(r.trade_type == "exports" for r in sample)


def test_pipeline_on_benchmark_tables(spark, scratch):
    times = flows.run_on_benchmark_tables(spark, "/root/testdata/sf0.001", scratch)
    assert set(times) == {"load_bronze", "build_test_export", "total"}
    export = landed.read_export_csv(spark, f"{scratch}/export")
    from tidemark.plans.layers import MacroLayers
    assert sorted(export.collect()) == sorted(MacroLayers(spark, "/root/testdata/sf0.001").export.collect())


def test_models_as_sql_views(spark):
    from tidemark.plans.layers import MacroLayers, register_views
    p = MacroLayers(spark, "/root/testdata/sf0.001")
    names = register_views(p)
    assert {"stg_cpi", "fct_sg_macro_monthly", "macro_monthly", "bronze_trade_raw"} <= set(names)
    by_sql = spark.sql("""
        SELECT period_year, COUNT(*) AS months, MAX(usd_sgd) AS top_rate
        FROM macro_monthly WHERE usd_sgd IS NOT NULL GROUP BY period_year""").collect()
    from pyspark.sql import functions as F
    by_df = (p.export.where("usd_sgd IS NOT NULL").groupBy("period_year")
             .agg(F.count("*").alias("months"), F.max("usd_sgd").alias("top_rate")).collect())
    assert sorted(tuple(r) for r in by_sql) == sorted(tuple(r) for r in by_df)
    n = spark.sql("SELECT COUNT(*) AS n FROM fct_sg_macro_monthly f JOIN dim_calendar c "
                  "ON f.period_date = c.period_date").first().n
    assert n == p.fact.count()


def test_cpi_payload_null_value_fails(spark, scratch):
    p = write_json(f"{scratch}/cpi/null.json",
                   {"Data": {"row": [{"rowText": "All Items", "columns": [{"key": "2024 Jan", "value": None}]}]}})
    with pytest.raises(PySparkException):
        landed.read_cpi_payload(spark, p, T1).collect()
    q = write_json(f"{scratch}/cpi/nokey.json",
                   {"Data": {"row": [{"rowText": "All Items", "columns": [{"value": "99.1"}]}]}})
    with pytest.raises(PySparkException):
        landed.read_cpi_payload(spark, q, T1).collect()


def test_stored_tables_match_declared_schemas(spark, scratch):
    from tidemark import schemas
    from tidemark.plans import flows as fl
    ms = [dt.date(1998 + (i // 12), i % 12 + 1, 1) for i in range(14)]
    cpi = write_json(f"{scratch}/l/cpi.json", cpi_payload([("All Items", [(d.strftime("%Y %b"), "100") for d in ms])]))
    fx = write_json(f"{scratch}/l/fx.json", page([{"_id": "1", "DataSeries": "US Dollar",
                                                   **{d.strftime("%Y%b"): "1.3" for d in ms}}]))
    imp = write_json(f"{scratch}/l/imp.json", page([{"_id": "1", "DataSeries": "Total Merchandise Imports",
                                                     **{d.strftime("%Y%b"): "5" for d in ms}}]))
    exp = write_json(f"{scratch}/l/exp.json", page([{"_id": "1", "Data Series Text": "X",
                                                     **{d.strftime("%Y%b"): "6" for d in ms}}]))
    fl.load_sources(spark, cpi_files=cpi, fx_files=fx, imports_files=imp, exports_files=exp,
                    bronze_dir=f"{scratch}/bronze", run_ts=T1)
    fl.build_and_export(spark, bronze_dir=f"{scratch}/bronze", gold_dir=f"{scratch}/gold",
                        export_path=f"{scratch}/export", calendar_end="1999-12-01")

    def shape(df_or_schema):
        schema = getattr(df_or_schema, "schema", df_or_schema)
        return [(f.name, f.dataType.simpleString()) for f in schema.fields]

    for table, declared in (("bronze_cpi_raw", schemas.BRONZE_CPI), ("bronze_fx_raw", schemas.BRONZE_FX),
                            ("bronze_trade_raw", schemas.BRONZE_TRADE)):
        assert shape(sinks.read_bronze(spark, f"{scratch}/bronze/{table}")) == shape(declared), table
    assert shape(fl.read_gold(spark, f"{scratch}/gold", "fct_sg_macro_monthly")) == shape(schemas.FACT)
    assert shape(fl.read_gold(spark, f"{scratch}/gold", "dim_calendar")) == shape(schemas.DIM_CALENDAR)
    bronze = {t: sinks.read_bronze(spark, f"{scratch}/bronze/{t}") for t in fl.BRONZE_TABLES}
    silver = fl.silver_models(bronze)
    for name, declared in (("stg_cpi", schemas.STG_CPI), ("stg_fx", schemas.STG_FX), ("stg_trade", schemas.STG_TRADE)):
        assert shape(silver[name]) == shape(declared), name


def test_landing_keeps_every_file_of_a_day(spark, scratch):
    for per_trigger in (None, 1, 2):
        land, bronze, ckpt = (f"{scratch}/{per_trigger}/{n}" for n in ("landing", "bronze", "ckpt"))
        write_json(f"{land}/a.json", cpi_payload([("All Items", [("2024 Jan", "99.1"), ("2024 Feb", "99.5")])]))
        write_json(f"{land}/b.json", cpi_payload([("Food", [("2024 Jan", "101.0")])]))
        load_cpi_landing(spark, land, bronze, ckpt, run_ts=T1, max_files_per_trigger=per_trigger)
        write_json(f"{land}/c.json", cpi_payload([("Fuel", [("2024 Jan", "7")])]))
        load_cpi_landing(spark, land, bronze, ckpt, run_ts=T1_LATER, max_files_per_trigger=per_trigger)
        assert sorted(r.cpi_value for r in sinks.read_bronze(spark, bronze).collect()) == [7, 99.1, 99.5, 101]


def test_a_retried_batch_replaces_itself_only(spark, scratch):
    schema = "cpi_category string, time_period string, cpi_value double, ingested_at timestamp"
    one, two = (spark.createDataFrame([(c, "2024 Jan", 1.0, T1)], schema) for c in "AB")
    for batch, df in (("s-0", one), ("s-1", two), ("s-1", two)):
        sinks.append_daily(df, f"{scratch}/b", batch=batch)
    assert sorted(r.cpi_category for r in sinks.read_bronze(spark, f"{scratch}/b").collect()) == ["A", "B"]


def test_landing_stops_at_a_truncated_file(spark, scratch):
    from pyspark.errors import StreamingQueryException
    os.makedirs(f"{scratch}/landing")
    with open(f"{scratch}/landing/a.json", "w") as fh:
        fh.write('{"Data": {"row": [{"rowText": "All Items", "colu')
    with pytest.raises(StreamingQueryException):
        load_cpi_landing(spark, f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/ckpt", run_ts=T1)


@pytest.mark.parametrize("payload", [{}, {"Data": {}}, {"Data": {"row": [{"rowText": "A"}]}}])
def test_incomplete_cpi_payload_fails(spark, scratch, payload):
    with pytest.raises(PySparkException):
        landed.read_cpi_payload(spark, write_json(f"{scratch}/p.json", payload), T1).collect()


@pytest.mark.parametrize("payload", [{"result": {}}, page([{"_id": "1", "2024Jan": "1"}]), page([{"_id": "1", "2024Jan": "na"}])])
def test_incomplete_record_page_fails(spark, scratch, payload):
    path = write_json(f"{scratch}/p.json", payload)
    with pytest.raises(PySparkException):
        landed.read_fx_pages(spark, path, T1).collect()
    with pytest.raises(PySparkException):
        landed.read_trade_pages(spark, path, path, T1).select("trade_month").collect()


def test_empty_replay_clears_the_day(spark, scratch):
    schema = "cpi_category string, time_period string, cpi_value double, ingested_at timestamp"
    sinks.append_daily(spark.createDataFrame([("A", "2024 Jan", 1.0, T1)], schema), f"{scratch}/b", run_ts=T1)
    sinks.append_daily(spark.createDataFrame([("A", "2024 Jan", 2.0, T2)], schema), f"{scratch}/b", run_ts=T2)
    assert sinks.append_daily(spark.createDataFrame([], schema), f"{scratch}/b", run_ts=T1_LATER)["rows"] == 0
    assert [r.cpi_value for r in sinks.read_bronze(spark, f"{scratch}/b").collect()] == [2.0]


def test_load_day_is_the_utc_day(spark, scratch):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Singapore")
    try:
        df = spark.sql("select 'A' cpi_category, '2024 Jan' time_period, 1D cpi_value, timestamp'2024-05-01 20:00:00Z' ingested_at")
        sinks.append_daily(df, f"{scratch}/b")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [d for d in os.listdir(f"{scratch}/b") if "=" in d] == ["ingest_date=2024-05-01"]


def test_conflicting_rows_of_one_load_stay(spark):
    from tidemark.operators.snapshots import latest_snapshot
    rows = [("A", "2024 Jan", 1.0, T2), ("A", "2024 Jan", 9.0, T2), ("A", "2024 Jan", 5.0, T1), (None, "x", 3.0, None), ("B", "y", 4.0, T1)]
    df = spark.createDataFrame(rows, "k string, m string, v double, ingested_at timestamp")
    assert sorted(r.v for r in latest_snapshot(df, ["k", "m"]).collect()) == [1.0, 3.0, 4.0, 9.0]
