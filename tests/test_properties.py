"""Property tests: Spark operators against small brute-force implementations."""

import datetime as dt
import json
import math
import os
from decimal import ROUND_HALF_UP, Decimal

import duckdb
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.functions import round_to
from tidemark.operators.snapshots import latest_snapshot
from tidemark.operators.timeseries import with_changes
from tidemark.sources import landed

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

finite = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False)


@SETTINGS
@given(values=st.lists(finite, min_size=1, max_size=40), digits=st.integers(0, 5))
def test_round_to_matches_sql_round(spark, values, digits):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(round_to("x", digits)).collect()]
    want = [duckdb.execute("SELECT round(?::DOUBLE, ?)", [v, digits]).fetchall()[0][0] for v in values]
    assert [g + 0.0 for g in got] == [w + 0.0 for w in want]


def _half_up(x, digits):
    s = 10.0 ** digits
    q = Decimal(repr(x * s)).quantize(Decimal(1), rounding=ROUND_HALF_UP)
    return float(q) / s


series = st.lists(
    st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 40),
              st.one_of(st.just(0.0), st.floats(min_value=1, max_value=500, allow_nan=False))),
    min_size=1, max_size=80)


@SETTINGS
@given(rows=series)
def test_with_changes_matches_row_lags(spark, rows):
    # one row per (key, month): later duplicates dropped
    seen, uniq = set(), []
    for k, m, v in rows:
        if (k, m) not in seen:
            seen.add((k, m))
            uniq.append((k, dt.date(2000 + m // 12, m % 12 + 1, 1), float(round(v, 2))))
    df = spark.createDataFrame(uniq, "k string, d date, v double")
    got = {(r.k, r.d): (r.mom, r.yoy) for r in
           with_changes(df, ["k"], "d", "v", mom="mom", yoy="yoy").collect()}
    pdf = pd.DataFrame(uniq, columns=["k", "d", "v"]).sort_values(["k", "d"])
    for k, g in pdf.groupby("k"):
        vals = list(g["v"])
        for i, (d, v) in enumerate(zip(g["d"], vals)):
            mom = None if i < 1 else _half_up(v - vals[i - 1], 3)
            base = vals[i - 12] if i >= 12 else None
            yoy = None if base in (None, 0.0) else _half_up((v - base) / base * 100, 2)
            gm, gy = got[(k, d)]
            assert (gm is None and mom is None) or math.isclose(gm, mom, rel_tol=0, abs_tol=1e-9)
            assert (gy is None and yoy is None) or math.isclose(gy, yoy, rel_tol=0, abs_tol=1e-9)


loads = st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(1, 6), st.integers(1, 5),
                           st.floats(min_value=0, max_value=100, allow_nan=False)),
                 min_size=1, max_size=40)


@SETTINGS
@given(rows=loads)
def test_latest_snapshot_matches_brute_force(spark, rows):
    # one row per (key, month, load day)
    seen, uniq = set(), []
    for k, m, day, v in rows:
        if (k, m, day) not in seen:
            seen.add((k, m, day))
            uniq.append((k, f"2024 M{m}", v, dt.datetime(2024, 6, day, 9, 0)))
    df = spark.createDataFrame(uniq, "cpi_category string, time_period string, cpi_value double, ingested_at timestamp")
    got = sorted(tuple(r) for r in latest_snapshot(df, ["cpi_category", "time_period"]).collect())
    pdf = pd.DataFrame(uniq, columns=["cpi_category", "time_period", "cpi_value", "ingested_at"])
    best = pdf.loc[pdf.groupby(["cpi_category", "time_period"])["ingested_at"].idxmax()]
    want = sorted((a, b, c, d.to_pydatetime()) for a, b, c, d in best.itertuples(index=False))
    assert got == want


cells = st.one_of(st.just(""), st.just("na"), st.just("1,000"),
                  st.floats(min_value=-1e4, max_value=1e4, allow_nan=False).map(lambda f: repr(round(f, 3))))


@SETTINGS
@given(records=st.lists(st.dictionaries(st.sampled_from(["2024Jan", "2024Feb", "2024Mar", "2023Dec"]), cells,
                                        min_size=0, max_size=4), min_size=1, max_size=8))
def test_record_melt_matches_pandas_melt(spark, scratch, records):
    recs = [{"_id": str(i), "DataSeries": f"S{i % 3}", **r} for i, r in enumerate(records)]
    path = os.path.join(scratch, "page.json")
    with open(path, "w") as fh:
        json.dump({"result": {"records": recs}}, fh)
    got = sorted((r.currency_pair, r.rate_month, r.exchange_rate)
                 for r in landed.read_fx_pages(spark, path, dt.datetime(2024, 1, 1)).collect())
    pdf = pd.DataFrame(recs).drop(columns=["_id"], errors="ignore")
    month_cols = [c for c in pdf.columns if c != "DataSeries"]
    if month_cols:
        long = pdf.melt(id_vars=["DataSeries"], value_vars=month_cols, var_name="m", value_name="v")
        long["v"] = pd.to_numeric(long["v"], errors="coerce")
        long = long.dropna(subset=["v"])
        want = sorted((a, b, float(c)) for a, b, c in long.itertuples(index=False))
    else:
        want = []
    assert got == want


from tidemark.operators.quality import Check, run_checks  # noqa: E402
from tidemark.operators.reshape import unpivot_columns  # noqa: E402
from tidemark.operators.timeseries import month_spine_of  # noqa: E402

num = st.one_of(st.none(), st.floats(min_value=-1e3, max_value=1e3, allow_nan=False))


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), num, num, num), min_size=1, max_size=20))
def test_unpivot_matches_pandas_melt(spark, rows):
    df = spark.createDataFrame(rows, "id string, m1 double, m2 double, m3 double")
    got = [(r.id, r.var, r.val) for r in unpivot_columns(df, ["id"], "var", "val").collect()]
    pdf = pd.DataFrame(rows, columns=["id", "m1", "m2", "m3"]).melt(id_vars=["id"], var_name="var",
                                                                     value_name="val")
    want = [(a, b, None if pd.isna(c) else float(c)) for a, b, c in pdf.itertuples(index=False)]
    key = lambda t: (t[0], t[1], (t[2] is None, t[2] or 0.0))
    assert sorted(got, key=key) == sorted(want, key=key)


@SETTINGS
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(1, 5)),
                               st.one_of(st.none(), st.sampled_from(["x", "y", "z"]))),
                     min_size=0, max_size=30))
def test_data_tests_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k int, v string")
    checks = [Check("t", "k", "unique"), Check("t", "v", "not_null"),
              Check("t", "v", "accepted_values", ("x", "y"))]
    got = {r.test: (r.rows_checked, r.failures) for r in run_checks({"t": df}, checks).collect()}
    keys = [k for k, _ in rows if k is not None]
    dup = len({k for k in keys if keys.count(k) > 1})
    assert got["unique"] == (len(rows), dup)
    assert got["not_null"] == (len(rows), sum(v is None for _, v in rows))
    assert got["accepted_values"] == (len(rows), sum(v == "z" for _, v in rows))


@SETTINGS
@given(days=st.lists(st.integers(0, 2000), min_size=1, max_size=15))
def test_month_spine_matches_date_range(spark, days):
    base = dt.datetime(1999, 1, 1)
    rows = [(base + dt.timedelta(days=d, hours=5),) for d in days]
    df = spark.createDataFrame(rows, "ts timestamp")
    got = [r.period_date for r in month_spine_of(df, "ts").orderBy("period_date").collect()]
    lo, hi = min(r[0] for r in rows), max(r[0] for r in rows)
    want = [d.date() for d in pd.date_range(lo.replace(day=1, hour=0), hi.replace(day=1, hour=0), freq="MS")]
    assert got == want
