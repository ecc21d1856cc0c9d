"""Plan-shape checks: pushdown, pruning, window sharing, no Python in the hot path."""

import re

import pytest

from tidemark.plans.catalog import QUERIES
from tidemark.plans.layers import MacroLayers

SF_SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def built(spark):
    """Every registered query's frame, built once."""
    return {name: q(spark, SF_SMALL) for name, q in QUERIES.items()}


def test_no_python_udfs_or_cartesian_products(built):
    for name, df in built.items():
        p = plan(df)
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in p, (name, bad)


def test_scan_prunes_columns(spark):
    p = plan(MacroLayers(spark, SF_SMALL).stg_cpi)
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>" in p


def test_two_lags_share_one_window(spark):
    p = optimized(MacroLayers(spark, SF_SMALL).stg_cpi)
    assert p.count("Window [") == 1


def test_series_filter_moves_below_window_date_filter_stays(spark):
    fact = MacroLayers(spark, SF_SMALL).fact
    p = optimized(fact)
    # the headline filter reaches the aggregate input, below the Window
    window_at = p.index("Window [")
    assert "All Items" in p[window_at:]
    # the date bound is applied above the window (January keeps its base)
    assert "1999-01-01" in p[:window_at]


def test_top_k_is_take_ordered(spark):
    p = plan(QUERIES["top_k"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


def test_top_k_names_come_from_a_semi_join_over_part(spark):
    p = plan(QUERIES["top_k"](spark, SF_SMALL))
    assert "LeftSemi" in p
    # part is streamed through the semi-join; what gets broadcast above it is the
    # semi-join output (at most k rows), never a bare scan of part
    for block in p.split("BroadcastExchange")[1:]:
        first_op = block.split("\n")[1].strip(" :+-")
        assert not first_op.startswith("FileScan parquet [p_partkey"), first_op


def _indent(line):
    return len(line) - len(line.lstrip(" :+-"))


def _raw_exchange_inputs(p):
    """For each hash shuffle fed by a file scan with no other shuffle or
    cache in between, the operator directly below the shuffle."""
    lines = p.splitlines()
    out = []
    for i, ln in enumerate(lines):
        if "Exchange hashpartitioning" not in ln or i + 1 >= len(lines):
            continue
        depth, raw = _indent(ln), False
        for below in lines[i + 1:]:
            if _indent(below) <= depth:
                break
            op = below.strip(" :+-")
            if op.startswith(("Exchange", "InMemoryTableScan", "ReusedExchange")):
                break
            if op.startswith("FileScan"):
                raw = True
                break
        if raw:
            # drop a whole-stage-codegen marker such as "*(1) "
            out.append(re.sub(r"^\*\(\d+\) ", "", lines[i + 1].strip(" :+-")))
    return out


def test_raw_rows_are_combined_before_every_hash_shuffle(spark):
    # a key holding a third of all rows is reduced per task before the shuffle
    for name in ("monthly_mom_yoy", "inverse_rate", "totals_union", "top_k", "unpivot_wide",
                 "json_flatten", "month_parse"):
        spark.catalog.clearCache()
        found = _raw_exchange_inputs(plan(QUERIES[name](spark, SF_SMALL)))
        assert found, name
        for below in found:
            assert below.startswith("HashAggregate") and "partial_" in below, (name, below)


def test_latest_snapshot_hashes_raw_rows(spark):
    from tidemark.operators.snapshots import latest_snapshot
    raw = spark.range(1000).selectExpr("cast(id % 7 as string) k", "cast(id % 5 as string) m", "id v",
                                       "timestamp_seconds(id) ingested_at")
    out = latest_snapshot(raw, ["k", "m"])
    out.collect()
    p = plan(out)
    assert "SortAggregate" not in p and "Window" not in p and "HashAggregate" in p
    assert "Sort [" not in p.split("== Initial Plan ==")[0]


def _scans(df, table):
    """Scans of a table that a finished query ran: reused exchanges are not run again."""
    df.collect()
    return len(re.findall(rf"FileScan parquet .*?/{table}\.parquet", plan(df).split("== Initial Plan ==")[0]))


def test_large_tables_are_scanned_once_and_nothing_is_cached(spark, built):
    for name, df in built.items():
        assert _scans(df, "orders") <= 1 and _scans(df, "lineitem") <= 1, name
        assert "InMemoryRelation" not in plan(df) and "InMemoryTableScan" not in plan(df), name
    assert _scans(QUERIES["macro_fact"](spark, SF_SMALL), "lineitem") == 1


def test_answers_follow_the_files(spark, scratch):
    import shutil
    shutil.copy(f"{SF_SMALL}/lineitem.parquet", f"{scratch}/lineitem.parquet")
    shutil.copy("/root/testdata/sf0.01/orders.parquet", f"{scratch}/orders.parquet")
    first = QUERIES["monthly_mom_yoy"](spark, scratch).agg({"cpi_value": "sum"}).first()[0]
    shutil.copy(f"{SF_SMALL}/orders.parquet", f"{scratch}/orders.parquet")
    spark.catalog.refreshByPath(scratch)
    second = QUERIES["monthly_mom_yoy"](spark, scratch).agg({"cpi_value": "sum"}).first()[0]
    want = QUERIES["monthly_mom_yoy"](spark, SF_SMALL).agg({"cpi_value": "sum"}).first()[0]
    assert second == want != first
