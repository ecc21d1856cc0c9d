"""Statistics of a load that are taken while it is written, and merged over loads.

A load's row says how many rows and nulls it wrote, its months, and which categories:
as a HyperLogLog sketch, whose size does not depend on their number, and as a
frequent-items sketch of bounded size, which lists them exactly while there are
fewer than ``TRACKED``. Rows of several loads merge into the figures that one pass
over all their rows would give: categories that occur in several loads count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TRACKED = 4096                # categories that are listed; beyond, their number is estimated
_LG = 12                      # registers of the estimate, as a power of two
_TRACKED_TYPE = "struct<sketch: binary, maxItemsTracked: int, itemDataType: string, itemDataTypeDDL: string>"
SCHEMA = ("table_name string, load_id string, row_count bigint, named bigint, null_values bigint, first_month date, last_month date, "
          f"sketch binary, tracked {_TRACKED_TYPE}")


def load_metrics(category: str, month: Column, value: str) -> list[Column]:
    """Aggregates for the write of a load (``metrics`` of the sinks, besides its rows)."""
    return [F.count(category).alias("named"), F.count_if(F.col(value).isNull()).alias("null_values"), F.min(month).alias("first_month"),
            F.max(month).alias("last_month"), F.hll_sketch_agg(category, F.lit(_LG)).alias("sketch"),
            F.expr(f"approx_top_k_accumulate(`{category}`, {TRACKED})").alias("tracked")]


def load_rows(spark: SparkSession, load_id: str, observed: dict[str, dict]) -> DataFrame:
    """A row per table from what its write observed."""
    rows = [(table, load_id, seen["rows"], seen["named"], seen["null_values"], seen["first_month"], seen["last_month"],
             seen["sketch"], seen["tracked"]) for table, seen in observed.items()]
    return spark.createDataFrame(rows, SCHEMA)


def with_loads(stored: DataFrame | None, new: DataFrame) -> DataFrame:
    """The rows of all loads; a load that is recorded again replaces its rows."""
    if stored is None:
        return new
    again = new.select(F.col("table_name").alias("__t"), F.col("load_id").alias("__l"))
    return stored.join(F.broadcast(again), (F.col("table_name") == F.col("__t")) & (F.col("load_id") == F.col("__l")),
                       "left_anti").unionByName(new)


def merged_stats(loads: DataFrame) -> DataFrame:
    """Per table, over the rows of ``loads``: loads, rows, nulls, months, and its categories.

    ``categories`` is exact, and ``names`` lists them, while ``listed``; else it is
    the sketch's estimate and ``names`` is null.
    """
    merged = loads.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("loads"), F.sum("row_count").alias("row_count"), F.sum("named").alias("named"), F.sum("null_values").alias("null_values"),
        F.min("first_month").alias("first_month"), F.max("last_month").alias("last_month"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"),
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(tracked, {TRACKED}), {TRACKED})").alias("found"))
    found = F.filter("found", lambda x: x["item"].isNotNull())
    items = F.array_sort(F.transform(found, lambda x: x["item"]))
    # The sketch has dropped nothing if what it lists makes up all rows that have a category.
    listed = F.aggregate(found, F.lit(0).cast("bigint"), lambda n, x: n + x["count"]) == F.col("named")
    return merged.select("table_name", "loads", "row_count", "null_values", "first_month", "last_month", listed.alias("listed"),
                         F.when(listed, F.size(items).cast("bigint")).otherwise(F.col("estimate")).alias("categories"),
                         F.when(listed, items).alias("names"))
