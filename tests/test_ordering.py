"""Positions and lags by range partitions, against plain windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import RANGE, dealt_by_range, with_lags, with_position
from tidemark.operators.timeseries import with_changes
from tidemark.sinks.tables import write_ordered_csv

SCHEMA = "k string, j int, d int, v double, extra string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def table(spark, seed, hot):
    """Series with gaps, one of them with most rows, others with few, and keys that are null."""
    rng = random.Random(seed)
    rows = [("hot", 1, d, float(rng.randint(0, 99)), "x") for d in rng.sample(range(10 * hot), hot)]
    for n in range(30):
        k = rng.choice(["a", "b", "c", None])
        rows += [(k, n, d, rng.choice([None, 1.0, float(d)]), None) for d in rng.sample(range(100), rng.randint(1, 15))]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("ranges", [1, 3, 7, 40])
@pytest.mark.parametrize("hot", [30, 600])
def test_lags_equal_a_window(spark, ranges, hot):
    df = table(spark, ranges, hot)
    w = Window.partitionBy("k", "j").orderBy("d")
    want = df.select("*", F.lag("v", 1).over(w).alias("one"), F.lag("v", 12).over(w).alias("year"))
    assert rows_of(with_lags(df, ["k", "j"], "d", "v", {"one": 1, "year": 12}, ranges)) == rows_of(want)


def test_a_series_that_is_the_whole_table(spark):
    """More ranges than rows of a lag: values come from several ranges before."""
    df = spark.range(100).select(F.lit("s").alias("k"), F.col("id").alias("d"), (F.col("id") * 3 % 17).cast("double").alias("v"))
    for ranges in (20, 60):
        got = with_changes(df, ["k"], "d", "v", ranges=ranges)
        assert rows_of(got) == rows_of(with_changes(df, ["k"], "d", "v"))


def test_no_range_holds_a_long_series(spark):
    df = table(spark, 1, 3000)
    dealt = dealt_by_range(df, [F.col("k"), F.col("j"), F.col("d")], 10)
    assert max(r["count"] for r in dealt.groupBy(RANGE).count().collect()) < 800
    assert rows_of(dealt.drop(RANGE)) == rows_of(df)
    # no window of the result has the series as its key alone, but for that over its ranges
    plan = with_lags(df, ["k"], "d", "v", {"one": 1}, 10)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [lag(" in line]
    assert len(windows) == 1 and RANGE in windows[0].split("], [")[1]


def test_empty_table_and_single_row(spark):
    df = table(spark, 1, 10)
    assert with_lags(df.limit(0), ["k"], "d", "v", {"one": 1}, 4).collect() == []
    assert [r.one for r in with_lags(df.limit(1), ["k"], "d", "v", {"one": 1}, 4).collect()] == [None]
    assert with_position(df.limit(0), ["d"]).collect() == []


@pytest.mark.parametrize("ranges", [1, 6, 30])
def test_positions_equal_a_window(spark, ranges):
    df = spark.range(500).select((F.col("id") * 7919 % 500).alias("d"), F.col("id").alias("x")).repartition(4)
    w = Window.orderBy("d")
    want = df.select(F.row_number().over(w).cast("bigint").alias("position"), "*")
    assert rows_of(with_position(df, ["d"], ranges=ranges)) == rows_of(want)
    down = with_position(df, [F.col("d").desc()], "place", ranges)
    assert {(r.place, r.d) for r in down.collect()} == {(500 - d, d) for d in range(500)}


def test_positions_with_ties_are_a_numbering(spark):
    df = spark.range(300).select((F.col("id") % 3).alias("d"))
    got = [(r.position, r.d) for r in with_position(df, ["d"], ranges=5).collect()]
    assert sorted(p for p, _ in got) == list(range(1, 301)) and [d for _, d in sorted(got)] == [0] * 100 + [1] * 100 + [2] * 100


def test_ordered_csv(spark, scratch):
    import os
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("d"))
    assert write_ordered_csv(df, f"{scratch}/out", ["d"], 5) == {"rows": 1000}
    rows = []
    names = sorted(n for n in os.listdir(f"{scratch}/out") if n.endswith(".csv"))
    for name in names:
        with open(f"{scratch}/out/{name}") as lines:
            rows += [int(x) for x in lines.read().splitlines()[1:]]
    assert len(names) == 5 and rows == list(range(1000))
