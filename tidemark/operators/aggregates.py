"""Aggregate, latest-row and top-k operators.

All aggregates here use Spark's two-phase hash aggregation (a partial
aggregate per task before the shuffle), so a key holding a large share of the
rows is reduced on the map side and never lands whole on one reducer.
Ordered limits plan as ``TakeOrderedAndProject``: each task keeps its own
top ``n`` and only those reach the final merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._cols import col
from ..functions.dates import month_start
from ..functions.numeric import exact_sum, round_to, unit_sum


def latest_rows(df: DataFrame, order: str, n: int = 1, *, present: Sequence[str] = (),
                tie_break: Sequence[str] = ()) -> DataFrame:
    """Rows with the ``n`` largest ``order`` values among rows where every
    ``present`` column is not null (``where x is not null order by d desc limit n``).
    ``tie_break`` columns make the choice deterministic when ``order`` ties.
    """
    cond = F.lit(True)
    for c in present:
        cond = cond & F.col(c).isNotNull()
    keys = [F.col(order).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in tie_break]
    return df.where(cond).orderBy(*keys).limit(n)


def top_k(df: DataFrame, keys: Sequence[str], value, k: int, *, name: str = "total",
          digits: int | None = None, where: Column | None = None,
          value_scale: int | None = None) -> DataFrame:
    """``group by keys order by sum(value) desc limit k``; ties broken by the
    keys ascending so the cut is deterministic. With ``value_scale`` the sum
    runs on whole units of 10^-scale (fast and exact for such values)."""
    src = df if where is None else df.where(where)
    total = exact_sum(value) if value_scale is None else unit_sum(value, value_scale)
    if digits is not None:
        total = round_to(total, digits)
    agg = src.groupBy(*keys).agg(total.alias(name))
    return agg.orderBy(F.col(name).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in keys]).limit(k)


def table_profile(df: DataFrame, *, table: str, category: str, month, value: str,
                  month_format: str | None = None) -> DataFrame:
    """One row: rows, distinct categories, first and last month, null values.

    One pass instead of a query per figure. The month range is taken over the
    parsed month: the maximum of month *text* is alphabetical ('Sep' > 'Oct').
    """
    m = col(month)
    if month_format is not None:
        m = F.to_date(m, month_format)
    else:
        m = month_start(m)
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(F.col(category)).alias("categories"),
        F.min(m).alias("first_month"),
        F.max(m).alias("last_month"),
        F.count_if(F.col(value).isNull()).alias("null_values"),
    ).select(F.lit(table).alias("table_name"), "*")


def coverage(df: DataFrame, date_col: str, counted: Sequence[str]) -> DataFrame:
    """``count(*), min(date), max(date), count(c)...`` in one pass."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.min(date_col).alias("earliest"), F.max(date_col).alias("latest"),
                  *[F.count(F.col(c)).alias(f"{c}_rows") for c in counted])
