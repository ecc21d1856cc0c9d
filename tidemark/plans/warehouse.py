"""A warehouse that is brought up to date load by load.

One release (see ``sinks.releases``) holds the current inputs and the monthly fact,
kept in parts by month:

* the CPI state: the latest rows per category and month, in buckets by both. A load
  day is merged into it (``snapshots.merge_latest``); the days before are not read.
* FX and trade as they were last replaced, or carried over.
* the fact. What changed between the inputs of the release before and the new ones
  names the months whose rows can differ: changed months of rates and trade lines,
  and for prices those that a changed row touches through its lags
  (``revisions.touched_rows``). Only these parts are computed and written; the
  files of all other months are carried over. A month that lost its row loses its part.

All of it becomes visible together, after the declared tests of the new rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.labels import CNY, EXPORTS, HEADLINE_CPI, IMPORT_TOTAL, IMPORTS, USD
from ..operators import quality
from ..operators.reshape import union_all
from ..operators.revisions import changed_rows, touched_rows
from ..operators.snapshots import latest_snapshot, merge_latest
from ..sinks.releases import Draft, Release, Releases
from ..sinks.scratch import stored
from . import marts, staging

STATE, BEFORE = "bronze_cpi_state", "bronze_cpi_state_before"
FX, TRADE, FACT, CALENDAR = "bronze_fx_raw", "bronze_trade_raw", "fct_sg_macro_monthly", "dim_calendar"
CPI_KEYS = ("cpi_category", "time_period")
LOADS = "cpi_loads"           # the loads that the state holds, in the order they were merged
_MONTH = "yyyy-MM"
_SCHEMAS = {STATE: schemas.BRONZE_CPI, FX: schemas.BRONZE_FX, TRADE: schemas.BRONZE_TRADE}


def _checks(table: str) -> list[quality.Check]:
    return [c for c in quality.MODEL_CHECKS if c.model == table]


def _silver(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {"stg_cpi": staging.stg_cpi(tables[STATE]), "stg_fx": staging.stg_fx(tables[FX]),
            "stg_trade": staging.stg_trade(tables[TRADE])}


def _fact(tables: dict[str, DataFrame], calendar: DataFrame) -> DataFrame:
    s = _silver(tables)
    return marts.fct_macro_monthly(s["stg_cpi"], s["stg_fx"], s["stg_trade"], calendar)


def _observations(tables: dict[str, DataFrame], kinds: Sequence[str]) -> DataFrame:
    """(kind, series, period_date, value, year): all that the fact's rows are made of."""
    silver = _silver(tables)
    cpi, fx, trade = silver["stg_cpi"], silver["stg_fx"], silver["stg_trade"]
    kept = (F.col("trade_type") == EXPORTS) | ((F.col("trade_type") == IMPORTS) & (F.col("commodity_category") == IMPORT_TOTAL))
    parts = {STATE: (cpi.where(F.col("cpi_category") == HEADLINE_CPI), "cpi_category", "cpi_value"),
             FX: (fx.where(F.col("currency_pair").isin(USD, CNY)), "currency_pair", "sgd_per_foreign_unit"),
             TRADE: (trade.where(kept), "trade_type", "trade_value_sgd_million")}
    return union_all(*[df.select(F.lit(kind).alias("kind"), F.col(series).alias("series"), "period_date",
                                 F.col(value).alias("value"), F.col("period_year").alias("year"))
                       for kind, (df, series, value) in parts.items() if kind in kinds])


def affected_months(old: dict[str, DataFrame], new: dict[str, DataFrame], kinds: Sequence[str] = (STATE, FX, TRADE)) -> DataFrame:
    """(period_date): months whose fact rows can differ between two sets of inputs, which differ in the tables ``kinds``."""
    keys, after = ["kind", "series", "period_date"], _observations(new, kinds)
    changes = stored(changed_rows(_observations(old, kinds), after, keys, ["value", "year"]))
    months = changes.select("period_date")
    if STATE in kinds:
        prices = after.where(F.col("kind") == STATE)
        touched = touched_rows(prices, changes.where(F.col("kind") == STATE), ["series"], "period_date")
        months = months.unionByName(touched.select("period_date"))
    return months.distinct()


def _merged(draft: Draft, load: DataFrame, load_id: str, buckets: int) -> None:
    """Merge a load into the state; the last load again replaces itself."""
    base = draft.base
    loads = list(base.notes.get(LOADS, [])) if base else []
    state = None
    if load_id in loads and (load_id != loads[-1] or (len(loads) > 1 and BEFORE not in base.tables)):
        raise ValueError(f"the state before load {load_id} is not kept: give all loads as cpi_history")
    if load_id in loads:
        state = BEFORE
    elif loads:
        state = STATE
    entry = base.tables.get(state) if base and state else None
    held = draft.releases._frame(entry) if entry else None
    if held is None:
        rows = latest_snapshot(load, list(CPI_KEYS)).repartition(buckets, *CPI_KEYS)
    else:
        buckets = entry["buckets"][0]
        rows = merge_latest(held, load, list(CPI_KEYS), buckets=buckets)
    _write_state(draft, rows, buckets)
    if entry:
        draft.tables[BEFORE] = entry
    draft.notes[LOADS] = loads if load_id in loads else [*loads, load_id]


def _write_state(draft: Draft, rows: DataFrame, buckets: int) -> None:
    draft.write(STATE, rows.select(*schemas.BRONZE_CPI.names), buckets=(buckets, CPI_KEYS),
                checks=[quality.Check(STATE, c, "not_null") for c in CPI_KEYS])


def refresh(spark: SparkSession, root: str, *, cpi_load: DataFrame | None = None, load_id: str | None = None,
            cpi_history: DataFrame | None = None, load_ids: Sequence[str] = (), fx: DataFrame | None = None,
            trade: DataFrame | None = None, buckets: int | None = None, calendar_end: str | None = None) -> Release:
    """Publish a release with new inputs and an equal fact to that of a full rebuild.

    ``cpi_load``: the rows of one load, known as ``load_id``; the last load given
    again replaces itself, an earlier one needs ``cpi_history``, all loads from which
    the state is made anew. ``fx``, ``trade``: whole new datasets. What is not given
    stays. ``buckets`` of a new state: by default the session's shuffle partitions.
    """
    releases = Releases(spark, root)
    draft = releases.draft()
    base = draft.base
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    empty = {t: spark.createDataFrame([], s) for t, s in _SCHEMAS.items()}
    old = {t: releases.read(t, base) if base and t in base.tables else empty[t] for t in _SCHEMAS}
    if cpi_history is not None:
        _write_state(draft, latest_snapshot(cpi_history, list(CPI_KEYS)).repartition(buckets, *CPI_KEYS), buckets)
        draft.notes[LOADS] = list(load_ids)
    elif cpi_load is not None:
        if load_id is None:
            raise ValueError("a load needs its load_id")
        _merged(draft, cpi_load, load_id, buckets)
    for table, df in ((FX, fx), (TRADE, trade)):
        if df is not None:
            draft.write(table, df.select(*_SCHEMAS[table].names))
    for table in (STATE, BEFORE, FX, TRADE, FACT):
        if table not in draft.tables and base and table in base.tables and not (table == BEFORE and cpi_history is not None):
            draft.carry(table)
    new = {t: releases._frame(draft.tables[t]) if t in draft.tables else empty[t] for t in _SCHEMAS}

    # Months are bounded by the calendar, and are the names of the parts.
    given = [t for t in _SCHEMAS if t in draft.tables and (not base or draft.tables[t] != base.tables.get(t))]
    months = [r.period_date for r in affected_months(old, new, given).where(
        F.col("period_date") >= F.lit(marts.FACT_START).cast("date")).collect()] if given else []
    calendar = draft.write(CALENDAR, marts.calendar_upto(staging.stg_cpi(new[STATE]), end=calendar_end), checks=_checks(CALENDAR))
    if months or FACT not in draft.tables:
        rows = _fact(new, calendar).where(F.col("period_date").isin(months))
        draft.patch(FACT, rows, [f"{m:%Y-%m}" for m in months], part=F.date_format("period_date", _MONTH), checks=_checks(FACT))
    return draft.publish(months=len(months))


def read_current(spark: SparkSession, root: str, table: str = FACT) -> DataFrame:
    """A table of the current release."""
    return Releases(spark, root).read(table)


def rebuilt_fact(spark: SparkSession, root: str) -> DataFrame:
    """The fact computed whole from the inputs of the current release."""
    releases = Releases(spark, root)
    current = releases.release()
    return _fact({t: releases.read(t, current) for t in _SCHEMAS}, releases.read(CALENDAR, current))
