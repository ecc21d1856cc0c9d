"""Month-grain series operators: lagged changes and generated month spines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import month_abbr, month_name, month_start, quarter_label, trade_season
from ..functions.numeric import nullif_zero, round_to
from .ordering import with_lags


def with_changes(df: DataFrame, keys: Sequence[str], order: str, value: str, *,
                 mom: str | None = "mom_change", yoy: str | None = "yoy_pct",
                 mom_digits: int = 3, yoy_digits: int = 2, periods: int = 12,
                 ranges: int | None = None) -> DataFrame:
    """Add the change on the previous row and the percent change on the row
    ``periods`` back, per series.

    ``lag`` counts rows, not months: a missing month shifts the base, as in the
    SQL model. Both lags share one sort and one Window node, and the lagged
    value is computed once.

    Scale: the window partitions by the series keys. It is meant for month
    grain (one row per key and month, see ``snapshots.latest_snapshot``), so a
    partition holds at most one row per month of history, however many raw
    rows fed that series upstream; raw rows are aggregated (with map-side
    partial aggregation) before they reach this operator. At a finer grain, or
    where one series holds a large share of the rows, ``ranges`` cuts the series
    into that many ranges of rows (see ``ordering.with_lags``).
    """
    prev, base = "__prev", "__base"
    if ranges is None:
        w = Window.partitionBy(*keys).orderBy(F.col(order))
        out = df.select("*", F.lag(value, 1).over(w).alias(prev),
                        F.lag(value, periods).over(w).alias(base))
    else:
        out = with_lags(df, keys, order, value, {prev: 1, base: periods}, ranges)
    exprs = []
    if mom:
        exprs.append(round_to(F.col(value) - F.col(prev), mom_digits).alias(mom))
    if yoy:
        exprs.append(round_to((F.col(value) - F.col(base)) / nullif_zero(base) * 100,
                              yoy_digits).alias(yoy))
    return out.select(*[F.col(c) for c in df.columns], *exprs)


def calendar_columns(date_col: Column | str = "period_date") -> list[Column]:
    """Calendar attributes of a month date, named as in ``dim_calendar``."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    return [
        F.year(d).alias("year"),
        F.month(d).alias("month_num"),
        month_abbr(d).alias("month_abbr"),
        month_name(d).alias("month_name"),
        quarter_label(d).alias("quarter"),
        trade_season(d).alias("sg_trade_season"),
    ]


def _spine(bounds: DataFrame, start: Column, end: Column, name: str) -> DataFrame:
    return bounds.select(
        F.explode(F.sequence(start, end, F.expr("interval 1 month"))).alias(name))


def month_series(spark: SparkSession, start: str, end: str | None = None,
                 name: str = "period_date") -> DataFrame:
    """One DATE row per month from ``start`` to ``end`` inclusive.

    ``end`` defaults to today's month, as the SQL model's ``current_date``.
    The spine has one row per month, so its size is bounded by the calendar.
    """
    end_col = F.lit(end).cast("date") if end else F.current_date()
    return _spine(spark.range(1), F.lit(start).cast("date"), end_col, name)


def month_spine_of(df: DataFrame, date_col: str, name: str = "period_date",
                   start: str | None = None) -> DataFrame:
    """Month spine covering the months present in ``df[date_col]``.

    The bounds come from one global ``min``/``max`` aggregate (partial per
    task, one row to merge), so the data is never collected to the driver.
    """
    bounds = df.agg(F.min(month_start(date_col)).cast("date").alias("lo"),
                    F.max(month_start(date_col)).cast("date").alias("hi"))
    lo = F.lit(start).cast("date") if start else F.col("lo")
    return _spine(bounds.where(F.col("hi") >= lo), lo, F.col("hi"), name)


def dim_calendar_of(spine: DataFrame, date_col: str = "period_date") -> DataFrame:
    """Calendar dimension over a month spine."""
    return spine.select(F.col(date_col).alias("period_date"), *calendar_columns(date_col))
