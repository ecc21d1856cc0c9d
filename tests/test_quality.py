import datetime as dt

import pytest

from tidemark.operators.quality import Check, DataTestFailure, gate, run_checks


def test_checks_pass_and_fail(spark):
    good = spark.createDataFrame([("US Dollar", dt.date(2024, 1, 1), 1.3)], "currency_pair string, period_date date, v double")
    bad = spark.createDataFrame([("Peso", dt.date(2024, 1, 1), None), (None, dt.date(2024, 1, 1), 1.0),
                                 ("Euro", None, 1.0), ("Euro", None, 2.0)],
                                "currency_pair string, period_date date, v double")
    checks = [Check("t", "currency_pair", "not_null"), Check("t", "v", "not_null"),
              Check("t", "currency_pair", "accepted_values", ("US Dollar", "Euro")),
              Check("t", "period_date", "unique")]
    ok = run_checks({"t": good}, checks)
    assert [r.status for r in ok.collect()] == ["PASS"] * 4
    gate(ok)
    rep = {(r.column_name, r.test): r for r in run_checks({"t": bad}, checks).collect()}
    assert rep[("currency_pair", "not_null")].failures == 1
    assert rep[("v", "not_null")].failures == 1
    assert rep[("currency_pair", "accepted_values")].failures == 1      # null left to not_null
    assert rep[("period_date", "unique")].failures == 1                 # 2024-01-01 twice; nulls ignored
    assert rep[("period_date", "unique")].rows_checked == 4
    with pytest.raises(DataTestFailure):
        gate(run_checks({"t": bad}, checks))


def test_checks_on_an_empty_model(spark):
    empty = spark.createDataFrame([], "period_date date, cpi_value double")
    checks = [Check("f", "period_date", "not_null"), Check("f", "period_date", "unique"),
              Check("f", "cpi_value", "not_null")]
    rows = run_checks({"f": empty}, checks).collect()
    assert [(r.test, r.rows_checked, r.failures, r.status) for r in rows] == [
        ("not_null", 0, 0, "PASS"), ("not_null", 0, 0, "PASS"), ("unique", 0, 0, "PASS")]


def test_composite_unique_and_second_unique(spark):
    df = spark.createDataFrame([("A", 1), ("A", 1), ("A", 2), ("B", 1), (None, 3), (None, 3)], "k string, m int")
    checks = [Check("t", ("k", "m"), "unique"), Check("t", "m", "unique")]
    rep = {r.column_name: r.failures for r in run_checks({"t": df}, checks).collect()}
    assert rep == {"k,m": 1, "m": 2}          # (A,1) twice; m = 1 and 3 repeat


def test_rejected_values(spark):
    df = spark.createDataFrame([("Machinery",), ("Total Merchandise Exports",), (None,)], "commodity_category string")
    rep = run_checks({"t": df}, [Check("t", "commodity_category", "rejected_values", ("Total Merchandise Exports",))])
    assert [(r.failures, r.status) for r in rep.collect()] == [(1, "FAIL")]


def test_gate_names_every_failure(spark):
    from tidemark.operators.quality import DataTestFailure, gate
    rows = [("m", f"c{i}", "not_null", 5, 1, "FAIL") for i in range(25)]
    report = spark.createDataFrame(rows, "model string, column_name string, test string, rows_checked bigint, failures bigint, status string")
    with pytest.raises(DataTestFailure) as error:
        gate(report)
    assert all(f"m.c{i} " in str(error.value) for i in range(25))
