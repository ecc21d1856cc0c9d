"""What a load changed, and which rows of a lagged series that touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

INSERTED, REMOVED, REVISED = "inserted", "removed", "revised"


def changed_rows(old: DataFrame, new: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """(keys, change): keys whose rows differ between two states of a table.

    ``inserted``: rows came to be or became more; ``removed``: all went, or
    they became fewer; ``revised``: as many rows, with other values. Rows of a
    key are compared as a set with repetitions, by their number and the sum of
    their hashes. Nulls are values like any other.
    """
    def summed(df: DataFrame, side: str) -> DataFrame:
        digest = F.sum(F.xxhash64(*values).cast("decimal(38,0)"))
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"n_{side}"), digest.alias(f"h_{side}"))

    a, b = summed(old, "old"), summed(new, "new")
    a = a.select(*[F.col(k).alias(f"__{k}") for k in keys], "n_old", "h_old")
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__{k}"))
    both = b.join(a, cond, "full_outer")
    n_old, n_new = F.coalesce("n_old", F.lit(0)), F.coalesce("n_new", F.lit(0))
    change = (F.when(n_new > n_old, INSERTED).when(n_new < n_old, REMOVED)
              .when(F.col("h_old") != F.col("h_new"), REVISED))
    # A key of one side only is taken from that side, also where it is null.
    return both.select(*[F.when(F.col("n_new").isNotNull(), F.col(k)).otherwise(F.col(f"__{k}")).alias(k) for k in keys],
                       change.alias("change")).where(F.col("change").isNotNull())


def touched_rows(new: DataFrame, changes: DataFrame, keys: Sequence[str], order: str, periods: int = 12) -> DataFrame:
    """(keys, order): rows of a series whose change figures a load touches, and those that are gone.

    The figures of a row come from itself, the row before and the row ``periods``
    before. So a revised row touches itself, the next row and the one ``periods``
    on; a row that came or went moves the ``periods`` rows after it one place. Only
    series with a change are looked at, from the first change on.

    ``changes``: (keys, order, change) of ``changed_rows``.
    """
    marked = changes.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(order).alias("__at"), "change")
    first = marked.groupBy(*[f"__{k}" for k in keys]).agg(F.min("__at").alias("__first"))
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__{k}"))
    rows = new.select(*keys, order).join(first, cond & (F.col(order) >= F.col("__first")), "left_semi")
    rows = rows.join(marked, cond & (F.col(order) == F.col("__at")), "left").select(*keys, order, "change", F.lit(1).alias("__real"))
    # Rows that are gone keep their place in the order, but are not counted.
    gone = marked.join(rows.select(*keys, order), cond & (F.col(order) == F.col("__at")), "left_anti").select(
        *[F.col(f"__{k}").alias(k) for k in keys], F.col("__at").alias(order), "change", F.lit(0).alias("__real"))
    along = Window.partitionBy(*keys).orderBy(F.col(order), "__real")
    place = F.sum("__real").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    moved = F.col("change").isin(INSERTED, REMOVED)
    placed = rows.unionByName(gone).withColumn("__place", place)
    before = F.max(F.when(moved, F.col("__place"))).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    revised = F.coalesce(F.col("change") == REVISED, F.lit(False))
    touched = (F.col("change").isNotNull() | F.coalesce(F.lag(revised, 1).over(along), F.lit(False))
               | F.coalesce(F.lag(revised, periods).over(along), F.lit(False))
               | F.coalesce(F.col("__place") - before <= periods, F.lit(False)))
    return placed.withColumn("__touched", touched).where("__touched").select(*keys, order).distinct()
