"""The whole chain over the benchmark tables: bronze -> silver -> gold -> export."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import marts, staging, standins
from .export import export_projection


READ_BUCKETS = 64             # arrays that a shared aggregate is held in


def read_once(grouped: DataFrame) -> DataFrame:
    """The same rows, in a form that every reader of a query shares.

    The models read an aggregate several times under different filters. Pushed
    below the aggregate, each filter would make a scan of the large table of its own;
    held in arrays first, the readers have one and the same exchange, which runs
    once. Rows are dealt into ``READ_BUCKETS`` arrays by their hash, so that no
    task and no row holds the whole aggregate.
    """
    bucket = F.pmod(F.xxhash64(*grouped.columns), F.lit(READ_BUCKETS)).alias("bucket")
    held = grouped.groupBy(bucket).agg(F.collect_list(F.struct(*grouped.columns)).alias("rows"))
    return held.select(F.inline("rows"))


@dataclass(eq=False)
class MacroLayers:
    """Lazy frames of every layer; nothing runs, and nothing is kept, until a query acts on one.

    ``calendar_end``: last month of the calendar; by default that of the data.
    """

    spark: SparkSession
    sf_dir: str
    calendar_end: str | None = None

    def table(self, name: str) -> DataFrame:
        return standins.read_table(self.spark, self.sf_dir, name)

    @cached_property
    def orders_monthly(self) -> DataFrame:
        return read_once(standins.orders_monthly(self.table("orders")))

    @cached_property
    def lineitem_monthly(self) -> DataFrame:
        return read_once(standins.lineitem_monthly(self.table("lineitem")))

    @cached_property
    def orders_by_status(self) -> DataFrame:
        """Orders by (priority, month, status): the source of simulated load days."""
        return read_once(standins.orders_monthly_by_status(self.table("orders")))

    @cached_property
    def bronze(self) -> dict[str, DataFrame]:
        return {
            "bronze_cpi_raw": standins.cpi_bronze_of(self.orders_monthly),
            "bronze_fx_raw": standins.fx_bronze_of(self.lineitem_monthly),
            "bronze_trade_raw": standins.trade_bronze_of(self.lineitem_monthly),
        }

    @cached_property
    def stg_cpi(self) -> DataFrame:
        return staging.stg_cpi(self.bronze["bronze_cpi_raw"])

    @cached_property
    def stg_fx(self) -> DataFrame:
        return staging.stg_fx(self.bronze["bronze_fx_raw"])

    @cached_property
    def stg_trade(self) -> DataFrame:
        return staging.stg_trade(self.bronze["bronze_trade_raw"])

    @cached_property
    def dim_calendar(self) -> DataFrame:
        return marts.calendar_upto(self.orders_monthly, "month", end=self.calendar_end)

    @cached_property
    def fact(self) -> DataFrame:
        return marts.fct_macro_monthly(self.stg_cpi, self.stg_fx, self.stg_trade, self.dim_calendar)

    @cached_property
    def fact_one_pass(self) -> DataFrame:
        return marts.fct_macro_monthly_one_pass(self.stg_cpi, self.stg_fx, self.stg_trade,
                                                self.dim_calendar)

    @cached_property
    def export(self) -> DataFrame:
        return export_projection(self.fact)


def register_views(layers: MacroLayers) -> list[str]:
    """Publish every layer as a temp view under the model names, so SQL
    written against the warehouse tables (``stg_cpi``, ``fct_sg_macro_monthly``,
    ``macro_monthly``, ...) runs unchanged through ``spark.sql``. Views are
    lazy: each query runs the chain."""
    frames = {**layers.bronze, "stg_cpi": layers.stg_cpi, "stg_fx": layers.stg_fx,
              "stg_trade": layers.stg_trade, "dim_calendar": layers.dim_calendar,
              "fct_sg_macro_monthly": layers.fact, "macro_monthly": layers.export}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)
