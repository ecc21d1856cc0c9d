"""File metadata, load statistics and the one-scan trade report."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import load_stats
from tidemark.plans import audit, flows, standins
from tidemark.plans.layers import MacroLayers
from tidemark.sinks import tables as sinks
from tidemark.sinks.releases import Releases
from tidemark.sources.files import file_freshness, listed_files, with_source

SF = "/root/testdata/sf0.001"
T1, T2 = dt.datetime(2024, 5, 1, 8), dt.datetime(2024, 6, 20, 8)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---------------------------------------------------------------- file metadata

def test_rows_know_their_file(spark, scratch):
    for n in (1, 2):
        spark.range(n * 10, n * 10 + 5).repartition(1).write.parquet(f"{scratch}/day={n}")
    df = with_source(spark.read.parquet(f"{scratch}/day=1", f"{scratch}/day=2"))
    got = {(r.id // 10, r.source_file.rsplit("/", 2)[1]) for r in df.collect()}
    assert got == {(1, "day=1"), (2, "day=2")}
    times = {r.source_modified.timestamp() for r in df.collect()}
    assert all(abs(t - os.stat(f"{scratch}/day=1").st_mtime) < 100 for t in times)


def test_freshness_without_reading_rows(spark, scratch):
    schema = "cpi_category string, time_period string, cpi_value double, ingested_at timestamp"
    for t in (T1, T2):
        sinks.append_daily(spark.createDataFrame([("A", "2024 Jan", 1.0, t)], schema), f"{scratch}/bronze")
    for day, t in (("2024-05-01", T1), ("2024-06-20", T2)):
        folder = f"{scratch}/bronze/ingest_date={day}/load_batch=daily"
        for name in os.listdir(folder):
            if name.endswith(".parquet"):
                with open(f"{folder}/{name}", "wb") as out:
                    out.write(b"no table at all")      # never opened
                stamp = t.replace(tzinfo=dt.timezone.utc).timestamp()
                os.utime(f"{folder}/{name}", (stamp, stamp))
    files = listed_files(spark, f"{scratch}/bronze", "*.parquet")
    got = {r.source: (r.files, r.bytes, r.days_stale, r.is_stale) for r in file_freshness(
        files, "2024-06-25", group=r"ingest_date=([^/]+)").collect()}
    assert got == {"2024-05-01": (1, 15, 55, True), "2024-06-20": (1, 15, 5, False)}
    (one,) = file_freshness(files, "2024-06-25").collect()
    assert one.source == "load_batch=daily" and one.files == 2 and one.days_stale == 5


# ---------------------------------------------------------------- load statistics

def bronze(spark, rows):
    return spark.createDataFrame(rows, "c string, m string, v double")


def stats(spark, scratch, loads, tracked=None):
    out = None
    for n, rows in enumerate(loads):
        draft = Releases(spark, f"{scratch}/{n}").draft()
        draft.write("t", bronze(spark, rows).repartition(3), metrics=load_stats.load_metrics("c", F.to_date("m", "yyyyMMM"), "v"))
        out = load_stats.with_loads(out, load_stats.load_rows(spark, str(n), draft.observed))
    return out


def test_merged_statistics_are_those_of_all_rows(spark, scratch):
    loads = [[("a", "2024Jan", 1.0), ("b", "2024Feb", None), (None, "2024Mar", 2.0)],
             [("b", "2023Dec", 1.0), ("c", "2024Apr", None), ("b", "2024Jan", None)], []]
    (got,) = load_stats.merged_stats(stats(spark, scratch, loads)).collect()
    assert (got.loads, got.row_count, got.null_values, got.categories, got.names, got.listed) == (3, 6, 3, 3, ["a", "b", "c"], True)
    assert (got.first_month, got.last_month) == (dt.date(2023, 12, 1), dt.date(2024, 4, 1))


def test_a_load_that_is_recorded_again_replaces_its_rows(spark, scratch):
    first = stats(spark, f"{scratch}/a", [[("a", "2024Jan", 1.0)], [("b", "2024Feb", 1.0)]])
    again = stats(spark, f"{scratch}/b", [[("x", "2024Mar", 1.0)] * 4])
    (got,) = load_stats.merged_stats(load_stats.with_loads(first, again)).collect()
    assert (got.loads, got.row_count, got.names) == (2, 5, ["b", "x"])


def test_many_categories_are_estimated(spark, scratch):
    rows = [(f"category {i}", "2024Jan", 1.0) for i in range(3 * load_stats.TRACKED)]
    (got,) = load_stats.merged_stats(stats(spark, scratch, [rows[:5000], rows[4000:]])).collect()
    assert not got.listed and got.names is None and got.row_count == len(rows) + 1000
    assert abs(got.categories - len(rows)) < 0.05 * len(rows)
    few = [(f"category {i}", "2024Jan", 1.0) for i in range(load_stats.TRACKED - 1)]
    (got,) = load_stats.merged_stats(stats(spark, f"{scratch}/few", [few, few])).collect()
    assert got.listed and got.categories == len(few) and got.names == sorted(c for c, _, _ in few)


def test_loads_keep_their_statistics(spark, scratch):
    b = {t: df.withColumn("ingested_at", F.col("ingested_at").cast("timestamp")) for t, df in MacroLayers(spark, SF).bronze.items()}
    observed = {t: sinks.replace_table(df, f"{scratch}/{t}", metrics=flows.table_metrics(t)) for t, df in b.items()}
    flows.record_load(spark, f"{scratch}/{flows.LOADS}", "1", observed)
    flows.record_load(spark, f"{scratch}/{flows.LOADS}", "1", observed)
    got = {r.table_name: r for r in flows.load_history(spark, scratch).collect()}
    want = audit.bronze_profiles(b["bronze_cpi_raw"], b["bronze_fx_raw"], b["bronze_trade_raw"]).collect()
    for w in want:
        r = got[w.table_name]
        assert (r.row_count, r.categories, r.first_month, r.last_month, r.null_values) == (
            w.row_count, w.categories, w.first_month, w.last_month, w.null_values)


# ---------------------------------------------------------------- the trade report

def test_report_is_the_single_audits(spark):
    trade = MacroLayers(spark, SF).bronze["bronze_trade_raw"]
    extra = spark.createDataFrame([("Flag A", "imports", "1996Mar", None, standins.RUN_TS), ("Paper", "exports", "2003Mar", 5.0, standins.RUN_TS)],
                                  "commodity_category string, trade_type string, trade_month string, trade_value_sgd_million double, ingested_at timestamp_ntz")
    for df in (trade, trade.unionByName(extra)):
        got = audit.of_report(audit.trade_report(df), 2)
        want = {"top_imports": audit.top_trade_categories(df, "imports", 2), "top_exports": audit.top_trade_categories(df, "exports", 2),
                "catalogue": audit.category_catalogue(df), "rows_by_trade_type": audit.rows_by_trade_type(df)}
        profile = audit.table_profile(df, table="bronze_trade_raw", category="commodity_category", month="trade_month",
                                      value="trade_value_sgd_million", month_format="yyyyMMM")
        for name in ("top_imports", "top_exports", "catalogue", "rows_by_trade_type"):
            assert rows_of(got[name]) == rows_of(want[name]), name
        assert [r.asDict() for r in got["profile"].collect()] == [r.asDict() for r in profile.collect()]


def test_report_scans_once(spark):
    import re
    df = audit.trade_report(spark.read.parquet(f"{SF}/lineitem.parquet").select(
        F.col("l_returnflag").alias("commodity_category"), F.col("l_linestatus").alias("trade_type"),
        F.date_format("l_shipdate", "yyyyMMM").alias("trade_month"), F.col("l_tax").alias("trade_value_sgd_million")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("FileScan parquet", plan)) == 1
    assert audit.trade_report(df.limit(0).select(
        "commodity_category", "trade_type", F.lit("2024Jan").alias("trade_month"),
        F.lit(1.0).alias("trade_value_sgd_million"))).count() == 0


@pytest.mark.parametrize("rows", [[], [("a", "exports", "2024Jan", 1.0)]])
def test_report_of_few_rows(spark, rows):
    df = spark.createDataFrame(rows, "commodity_category string, trade_type string, trade_month string, trade_value_sgd_million double")
    (profile,) = audit.of_report(audit.trade_report(df))["profile"].collect()
    assert profile.row_count == profile.categories == len(rows)
