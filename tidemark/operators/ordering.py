"""Order at scale: positions, and windows over long series, by range partitions.

A window without a key, or with a key that holds a large share of the rows, sorts
them in one task. Here rows are dealt out by ranges of their order, many to a
series if it is long, and each range is handled by itself; what a range has to
know of the ones before it (how many rows they hold, or their last few rows) is small
and is handed on.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sinks.scratch import stored

RANGE = "__range"


def dealt_by_range(df: DataFrame, order: Sequence[Column], ranges: int) -> DataFrame:
    """The rows with the number of their range (rising with the order), stored so that it stays."""
    return stored(df.repartitionByRange(ranges, *order).withColumn(RANGE, F.spark_partition_id()))


def _ranges(df: DataFrame, ranges: int | None) -> int:
    return ranges or max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def with_position(df: DataFrame, order: Sequence[Column | str], name: str = "position", ranges: int | None = None) -> DataFrame:
    """Add each row's place (1, 2, ...) in the order of all rows.

    Rows are numbered within ranges of the order, and a range starts after all
    rows of the ranges before it. Only one count per range reaches the driver. Rows
    that are equal in the order are in one range; their places are arbitrary among them.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    dealt = dealt_by_range(df, order, _ranges(df, ranges))
    sizes = sorted(tuple(r) for r in dealt.groupBy(RANGE).count().collect())  # one row per range
    starts = list(accumulate((n for _, n in sizes), initial=0))
    offsets = df.sparkSession.createDataFrame([(r, s) for (r, _), s in zip(sizes, starts)], f"{RANGE} int, __start bigint")
    place = F.row_number().over(Window.partitionBy(RANGE).orderBy(*order))
    placed = dealt.withColumn("__place", place).join(F.broadcast(offsets), RANGE)
    return placed.select((F.col("__start") + F.col("__place")).cast("bigint").alias(name), *df.columns)


def with_lags(df: DataFrame, keys: Sequence[str], order: str, value: str, lags: dict[str, int],
              ranges: int | None = None) -> DataFrame:
    """Add, per series, the value of the row so many rows before: ``lags`` maps new columns to distances.

    Equal to ``lag`` over a window by the keys, but a series is cut into ranges:
    each range is a window of its own, which begins with the last rows of the
    series before it, as many as the longest lag. No task holds a whole series.
    Rows of one series and order value stay in one range.
    """
    most = max(lags.values())
    dealt = dealt_by_range(df, [*[F.col(k) for k in keys], F.col(order)], _ranges(df, ranges))

    def same(a: DataFrame, b: DataFrame):
        cond = F.lit(True)
        for k in keys:
            cond = cond & a[k].eqNullSafe(b[f"__{k}"])
        return cond

    # Per series, its ranges in order: a row per (series, range), far fewer than rows.
    counts = dealt.groupBy(*keys, RANGE).agg(F.count(F.lit(1)).alias("__n"))
    along = Window.partitionBy(*keys).orderBy(RANGE)
    parts = stored(counts.withColumn("__nth", F.row_number().over(along)).withColumn(
        "__end", F.sum("__n").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    split = parts.groupBy(*keys).agg(F.count(F.lit(1)).alias("__ranges")).where(F.col("__ranges") > 1)
    split = split.select(*[F.col(k).alias(f"__{k}") for k in keys])

    # The last rows of each range of a split series, and where they are needed: in the
    # next range, or further on if the ranges between are short.
    back = F.row_number().over(Window.partitionBy(RANGE, *keys).orderBy(F.col(order).desc()))
    long = dealt.select(*keys, order, value, RANGE)
    tails = (long.join(split, same(long, split), "left_semi").withColumn("__back", back).where(F.col("__back") <= most))
    here = parts.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(RANGE).alias("__own"), "__nth", F.col("__end").alias("__upto"))
    tails = tails.join(here, same(tails, here) & (tails[RANGE] == here["__own"])).select(
        *keys, order, value, "__back", "__upto", F.explode(F.sequence(F.col("__nth") + 1, F.col("__nth") + most)).alias("__to"))
    there = parts.select(*[F.col(k).alias(f"__{k}") for k in keys], RANGE, F.col("__nth").alias("__at"),
                         (F.col("__end") - F.col("__n")).alias("__before"))
    handed = tails.join(there, same(tails, there) & (tails["__to"] == there["__at"])).where(
        F.col("__before") - F.col("__upto") + F.col("__back") <= most).select(*keys, order, value, RANGE)

    own = dealt.withColumn("__own", F.lit(True))
    both = own.unionByName(handed.withColumn("__own", F.lit(False)), allowMissingColumns=True)
    window = Window.partitionBy(RANGE, *keys).orderBy(order)
    out = both.select("*", *[F.lag(value, n).over(window).alias(c) for c, n in lags.items()])
    return out.where("__own").select(*df.columns, *lags)
