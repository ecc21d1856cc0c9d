import os
import datetime as dt

import duckdb
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions import (balance_status, inflation_band, lenient_double, parse_month,
                                round_to, sourcing_signal, strict_double, quarter_label, trade_season)
from tidemark.functions.labels import ACTION_LABELS


def test_round_to_matches_duckdb_on_ties(spark):
    values = [0.125, 0.135, 2.675, 1.005, -0.125, -2.675, 12345.6785, 0.5, 1.5, 2.5, -0.5, 1e-9]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for n in range(0, 6):
        got = [r[0] for r in df.select(round_to("x", n)).collect()]
        want = [duckdb.sql(f"SELECT round({v!r}::DOUBLE, {n})").fetchall()[0][0] for v in values]
        assert got == want, n


def test_parse_month_layouts(spark):
    df = spark.createDataFrame([("2024 Jan", "2024Feb")], "a string, b string")
    row = df.select(parse_month("a", "yyyy MMM"), parse_month("b")).first()
    assert row[0] == dt.date(2024, 1, 1) and row[1] == dt.date(2024, 2, 1)


def test_bad_month_text_fails(spark):
    df = spark.createDataFrame([("2024Foo",)], "a string")
    with pytest.raises(PySparkException):
        df.select(parse_month("a")).collect()


def test_lenient_and_strict_parse(spark):
    texts = ["1.5", "", "na", "1,000", " 2 ", "inf", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    lenient = [r[0] for r in df.select(lenient_double("t")).collect()]
    assert lenient[0] == 1.5 and lenient[1] is None and lenient[2] is None and lenient[3] is None
    assert lenient[6] is None
    strict = spark.createDataFrame([("1.5",), ("",), ("na",), (None,)], "t string")
    assert [r[0] for r in strict.select(strict_double("t")).collect()] == [1.5, None, None, None]
    with pytest.raises(PySparkException):
        spark.createDataFrame([("x",)], "t string").select(strict_double("t")).collect()


def test_threshold_labels_at_bounds(spark):
    df = spark.createDataFrame([(0.04,), (0.02,), (0.0,), (-0.001,), (0.0401,), (None,)], "x double")
    got = [r[0] for r in df.select(inflation_band("x")).collect()]
    assert got == ["ELEVATED", "STABLE", "STABLE", "DEFLATION", "HIGH", "DEFLATION"]
    acts = [r[0] for r in df.select(inflation_band("x", ACTION_LABELS)).collect()]
    assert acts[-1] == ACTION_LABELS[3]
    rates = spark.createDataFrame([(1.30,), (1.40,), (1.29,), (1.41,), (None,)], "x double")
    assert [r[0] for r in rates.select(sourcing_signal("x")).collect()] == [
        "Neutral", "Neutral", "Favour US", "Favour China", "Neutral"]
    bal = spark.createDataFrame([(1.0,), (0.0,), (None,)], "x double")
    assert [r[0] for r in bal.select(balance_status("x")).collect()] == ["Surplus", "Deficit", "Deficit"]


def test_calendar_labels(spark):
    months = [dt.date(2024, m, 1) for m in range(1, 13)]
    df = spark.createDataFrame([(d,) for d in months], "d date")
    rows = df.select(quarter_label("d"), trade_season("d")).collect()
    assert [r[0] for r in rows] == ["Q1"] * 3 + ["Q2"] * 3 + ["Q3"] * 3 + ["Q4"] * 3
    assert rows[2][1] == "Asia Dry Season" and rows[5][1] == "Monsoon Season"
    assert rows[8][1] == "Monsoon Season" and rows[9][1] == "Year End / Q1" and rows[0][1] == "Year End / Q1"


def test_number_grammar(spark):
    from pyspark.errors import PySparkException
    from tidemark.functions.numeric import lenient_double, strict_double
    good = {"1": 1.0, " -1.5 ": -1.5, ".5": 0.5, "5.": 5.0, "+1e3": 1000.0, "inf": float("inf"), "-Infinity": float("-inf")}
    bad = ["1.5d", "1.5f", "1f", "0x1p3", "1,000", "x", "1 2", "--1", "e5", ".", "na"]
    df = spark.createDataFrame([(t,) for t in [*good, *bad, None, "", "nan"]], "t string")
    got = {r.t: r.v for r in df.select("t", lenient_double("t").alias("v")).collect()}
    assert {t: got[t] for t in good} == good and all(got[t] is None for t in [*bad, None, "", "nan"])
    for t in bad[:-1]:
        with pytest.raises(PySparkException):
            spark.createDataFrame([(t,)], "t string").select(strict_double("t")).collect()


def test_session_takes_the_submitted_master():
    import subprocess
    import sys
    code = ("import sys; sys.path.insert(0, %r); from tidemark.session import build_session; s = build_session(); "
            "print(s.sparkContext.master); s.stop()" % os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = dict(os.environ, PYSPARK_SUBMIT_ARGS="--master local[3] pyspark-shell")
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    assert out.stdout.strip().splitlines()[-1] == "local[3]", out.stderr[-1500:]
