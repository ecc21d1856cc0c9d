"""The warehouse load by load: state, closure of changed months, parts of the fact."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.revisions import changed_rows, touched_rows
from tidemark.operators.snapshots import latest_snapshot, merge_latest
from tidemark.operators.timeseries import with_changes
from tidemark.plans import marts, staging, warehouse
from tidemark.sinks.releases import DATA, Releases

T = [dt.datetime(2024, 5, day, 8) for day in range(1, 29)]


def month(i):
    return dt.date(1998 + i // 12, i % 12 + 1, 1)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---------------------------------------------------------------- changed and touched rows

SERIES = "k string, m date, v double"


def series(spark, table):
    return spark.createDataFrame([(k, month(i), v) for (k, i), v in table.items()], SERIES)


def figures(spark, table):
    df = with_changes(series(spark, table), ["k"], "m", "v")
    return {(r.k, r.m): (r.v, r.mom_change, r.yoy_pct) for r in df.collect()}


def test_changed_rows(spark):
    old = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, None), (None, 1, 5.0), ("c", 1, 1.0), ("c", 1, 2.0), ("d", 1, 1.0)], "k string, m int, v double")
    new = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.5), ("b", 1, 3.0), (None, 1, 5.0), ("c", 1, 2.0), ("c", 1, 1.0), ("d", 1, 1.0), ("d", 1, 1.0), (None, 2, 1.0)], "k string, m int, v double")
    got = {(r.k, r.m): r.change for r in changed_rows(old, new, ["k", "m"], ["v"]).collect()}
    assert got == {("a", 2): "revised", ("b", 1): "revised", ("d", 1): "inserted", (None, 2): "inserted"}
    back = {(r.k, r.m): r.change for r in changed_rows(new, old, ["k", "m"], ["v"]).collect()}
    assert back == {("a", 2): "revised", ("b", 1): "revised", ("d", 1): "removed", (None, 2): "removed"}
    assert changed_rows(old, old, ["k", "m"], ["v"]).count() == 0


def test_touched_rows_cover_every_figure_that_differs(spark):
    rng = random.Random(1)
    for trial in range(6):
        old = {(k, i): float(rng.randint(1, 50)) for k in (["a", "b", None][: 1 + trial % 3]) for i in range(60) if rng.random() < 0.85}
        new = dict(old)
        for key in rng.sample(sorted(old, key=str), rng.randint(0, 4)):
            if rng.random() < 0.4:
                del new[key]
            else:
                new[key] = new[key] + rng.choice([0.0, 7.0])
        for _ in range(rng.randint(0, 2)):
            new.setdefault(("a", rng.randint(0, 70)), 3.0)
        a, b = series(spark, old), series(spark, new)
        changes = changed_rows(a, b, ["k", "m"], ["v"])
        got = {(r.k, r.m) for r in touched_rows(b, changes, ["k"], "m").collect()}
        before, after = figures(spark, old), figures(spark, new)
        differ = {key for key in {*before, *after} if before.get(key) != after.get(key)}
        assert differ <= got
        # ... and no more than the rows that a change reaches
        changed = [(r.k, r.m) for r in changes.collect()]
        for k, m in got:
            place = sorted({*[x for kk, x in before if kk == k], *[x for kk, x in after if kk == k]})
            assert any(kk == k and mm <= m and place.index(m) - place.index(mm) <= 12 + len(changed) for kk, mm in changed)
        if not changed:
            assert not got


def test_a_revision_touches_three_rows(spark):
    old = {("a", i): float(i + 1) for i in range(40)}
    new = {**old, ("a", 20): 99.0}
    changes = changed_rows(series(spark, old), series(spark, new), ["k", "m"], ["v"])
    got = {r.m for r in touched_rows(series(spark, new), changes, ["k"], "m").collect()}
    assert got == {month(20), month(21), month(32)}
    del new["a", 20]
    changes = changed_rows(series(spark, old), series(spark, new), ["k", "m"], ["v"])
    got = {r.m for r in touched_rows(series(spark, new), changes, ["k"], "m").collect()}
    assert got == {month(i) for i in range(20, 33)}


# ---------------------------------------------------------------- the state

BRONZE = schemas.BRONZE_CPI


def load(spark, table, at):
    return spark.createDataFrame([(c, f"{month(i):%Y %b}", v, at) for (c, i), v in table], BRONZE)


@pytest.mark.parametrize("buckets", [None, 4])
def test_merged_loads_are_the_latest_snapshot(spark, buckets):
    rng = random.Random(2)
    loads = []
    for n in range(6):
        table = [((rng.choice("abc"), rng.randint(0, 9)), rng.choice([None, 1.0, 2.0])) for _ in range(25)]
        # several times a day, also none, and loads out of order or at equal times
        rows = [(c, f"{month(i):%Y %b}", v, rng.choice([T[n], T[n], T[(n * 5) % 7], None])) for (c, i), v in table]
        loads.append(spark.createDataFrame(rows, BRONZE))
    state, every = latest_snapshot(loads[0], warehouse.CPI_KEYS), loads[0]
    for one in loads[1:]:
        state, every = merge_latest(state, one, warehouse.CPI_KEYS, buckets=buckets), every.unionByName(one)
        state = spark.createDataFrame(state.collect(), BRONZE)
        assert rows_of(state) == rows_of(latest_snapshot(every, warehouse.CPI_KEYS))


def test_only_the_load_is_shuffled(spark, scratch):
    store = Releases(spark, scratch)
    draft = store.draft()
    rows = load(spark, [(("a", i), 1.0) for i in range(30)], T[0]).repartition(4, *warehouse.CPI_KEYS)
    state = draft.write("state", rows, buckets=(4, warehouse.CPI_KEYS))
    draft.publish()
    assert rows_of(store.read("state")) == rows_of(rows) == rows_of(state)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        merged = merge_latest(store.read("state"), load(spark, [(("a", 3), 2.0)], T[1]), warehouse.CPI_KEYS, buckets=4)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
        scans = [n for n, x in enumerate(lines) if "Bucketed: true" in x]
        assert len(scans) == 2                       # the state is read twice, never shuffled
        for n in scans:
            above, d = [], depth[n]
            for i in range(n - 1, -1, -1):
                if depth[i] < d:
                    above.append(lines[i])
                    d = depth[i]
            assert not any("Exchange" in x for x in above)
        assert merged.count() == 30 and merged.where("cpi_value = 2").count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("release_")]


# ---------------------------------------------------------------- the fact

def cpi(values, at, spark):
    return load(spark, [(("All Items", i), v) for i, v in values.items()] + [(("Food", i), 5.0) for i in values], at)


def fx(spark, values):
    return spark.createDataFrame([(c, f"{month(i):%Y%b}", v, T[0]) for (c, i), v in values.items()], schemas.BRONZE_FX)


def trade(spark, values):
    return spark.createDataFrame([(c, t, f"{month(i):%Y%b}", v, T[0]) for (c, t, i), v in values.items()], schemas.BRONZE_TRADE)


def fact_files(spark, root):
    """Files and times of every part of the current fact."""
    folders = Releases(spark, root).release().tables[warehouse.FACT]["folders"]
    return {p: sorted((f, os.stat(f"{root}/{d}/{f}").st_mtime_ns) for f in os.listdir(f"{root}/{d}")) for p, d in folders.items()}


def whole_fact(spark, loads, fx_rows, trade_rows):
    every = loads[0]
    for one in loads[1:]:
        every = every.unionByName(one)
    s = staging.stg_cpi(latest_snapshot(every, warehouse.CPI_KEYS))
    return marts.fct_macro_monthly(s, staging.stg_fx(fx_rows), staging.stg_trade(trade_rows), marts.calendar_upto(s))


def test_every_refresh_equals_a_rebuild(spark, scratch):
    rng = random.Random(3)
    base = {i: float(100 + i) for i in range(60) if i not in (25, 40)}
    rates = {(c, i): 1.3 + i / 100 for c in ("US Dollar", "Renminbi", "Euro") for i in range(60)}
    lines = {("Total Merchandise Imports", "imports", i): 400.0 + i for i in range(60)}
    lines.update({(c, "exports", i): 100.0 + i for c in ("Machinery", "Chemicals") for i in range(60)})
    loads = [cpi(base, T[0], spark)]
    warehouse.refresh(spark, scratch, cpi_load=loads[0], load_id="0", fx=fx(spark, rates), trade=trade(spark, lines))
    assert rows_of(warehouse.read_current(spark, scratch)) == rows_of(whole_fact(spark, loads, fx(spark, rates), trade(spark, lines)))

    def step(n, values=None, new_rates=None, new_lines=None, expect=None):
        before = fact_files(spark, scratch)
        if values is not None:
            loads.append(cpi(values, T[n], spark))
        release = warehouse.refresh(spark, scratch, cpi_load=loads[-1] if values is not None else None, load_id=str(n),
                                    fx=fx(spark, new_rates) if new_rates else None,
                                    trade=trade(spark, new_lines) if new_lines else None)
        after = fact_files(spark, scratch)
        got = rows_of(warehouse.read_current(spark, scratch))
        assert got == rows_of(whole_fact(spark, loads, fx(spark, rates), trade(spark, lines)))
        assert got == rows_of(warehouse.rebuilt_fact(spark, scratch))
        untouched = {p for p in before if before[p] == after.get(p)}
        assert len(before) - len(untouched & set(before)) <= release.notes["months"]
        if expect is not None:
            assert {p for p in {*before, *after} if p not in untouched} == expect
        return untouched

    # a revision: itself, the next row, and the 12th after it (one month is missing between)
    step(1, {30: 777.0}, expect={"2000-07", "2000-08", "2001-08"})
    # a month that was missing comes in: the 12 rows after it move
    step(2, {40: 5.0}, expect={f"{month(i):%Y-%m}" for i in range(40, 53)})
    # new months at the end
    step(3, {60: 1.0, 61: 2.0}, expect={"2003-01", "2003-02"})
    # the same values again: nothing is written
    step(4, {i: base[i] for i in (50, 51)}, expect=set())
    # a currency's rate, a trade line, and one that the fact does not use
    rates["US Dollar", 33] = 9.9
    rates["Euro", 34] = 9.9
    step(5, new_rates=rates, expect={"2000-10"})
    lines["Chemicals", "exports", 35] = 1.0
    del lines["Total Merchandise Imports", "imports", 37]
    lines["Paper", "imports", 39] = 8.0
    step(6, new_lines=lines, expect={"2000-12", "2001-02"})
    for n in range(7, 9):
        months = rng.sample(range(64), 3)
        step(n, {i: float(rng.randint(1, 99)) for i in months})
    # the last load again, with other rows: what it had brought is taken back
    loads[-1] = cpi({20: 4.0}, T[8], spark)
    warehouse.refresh(spark, scratch, cpi_load=loads[-1], load_id="8")
    assert rows_of(warehouse.read_current(spark, scratch)) == rows_of(whole_fact(spark, loads, fx(spark, rates), trade(spark, lines)))
    # an earlier load again needs the history
    with pytest.raises(ValueError, match="cpi_history"):
        warehouse.refresh(spark, scratch, cpi_load=loads[1], load_id="1")
    loads[1] = cpi({31: 1.5}, T[1], spark)
    every = loads[0]
    for one in loads[1:]:
        every = every.unionByName(one)
    warehouse.refresh(spark, scratch, cpi_history=every, load_ids=[str(n) for n in range(9)])
    assert rows_of(warehouse.read_current(spark, scratch)) == rows_of(whole_fact(spark, loads, fx(spark, rates), trade(spark, lines)))
    with pytest.raises(ValueError, match="cpi_history"):
        warehouse.refresh(spark, scratch, cpi_load=loads[-1], load_id="8")


def test_a_failed_test_leaves_fact_and_state(spark, scratch):
    from tidemark.operators.quality import DataTestFailure
    warehouse.refresh(spark, scratch, cpi_load=cpi({i: 1.0 + i for i in range(24)}, T[0], spark), load_id="0",
                      fx=fx(spark, {("US Dollar", 13): 1.3}), trade=trade(spark, {("Machinery", "exports", 13): 1.0}))
    before, files = rows_of(warehouse.read_current(spark, scratch)), fact_files(spark, scratch)
    double = trade(spark, {("Machinery", "exports", 13): 1.0, ("Total Merchandise Imports", "imports", 13): 2.0})
    with pytest.raises(DataTestFailure, match="unique"):       # two import totals of a month double its row
        warehouse.refresh(spark, scratch, trade=double.unionByName(double))
    assert rows_of(warehouse.read_current(spark, scratch)) == before and fact_files(spark, scratch) == files
    with pytest.raises(DataTestFailure, match="not_null"):     # a load without its keys
        warehouse.refresh(spark, scratch, cpi_load=load(spark, [(("All Items", 3), 1.0)], T[1]).withColumn(
            "cpi_category", F.lit(None).cast("string")), load_id="1")
    assert Releases(spark, scratch).numbers() == [1]
    assert len(os.listdir(f"{scratch}/{DATA}")) > len(Releases(spark, scratch).release().tables)


def test_a_first_load_without_rates(spark, scratch):
    warehouse.refresh(spark, scratch, cpi_load=cpi({i: 1.0 + i for i in range(20)}, T[0], spark), load_id="0")
    fact = warehouse.read_current(spark, scratch)
    assert fact.count() == 8 and fact.where("usd_sgd_rate IS NOT NULL").count() == 0
    assert [f.name for f in fact.schema] == list(marts.FACT_COLUMNS)
