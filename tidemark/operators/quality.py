"""Declared data tests (not_null, unique, accepted_values) and the gate.

Tests are data: a list of ``Check``s. All checks of one model are answered
by a single aggregate pass (``count_if`` per check); ``unique`` adds one
grouped count on its key. The report is a DataFrame with one row per check.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import KEY_CURRENCIES, TRADE_TYPES

REPORT_COLUMNS = ("model", "column_name", "test", "rows_checked", "failures", "status")


@dataclass(frozen=True)
class Check:
    model: str
    column: str | tuple[str, ...]
    test: str                      # 'not_null' | 'unique' | 'accepted_values' | 'rejected_values'
    values: tuple = field(default=())

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.column,) if isinstance(self.column, str) else tuple(self.column)

    @property
    def label(self) -> str:
        return ",".join(self.columns)


# The fifteen declared tests of the silver and gold models.
MODEL_CHECKS: tuple[Check, ...] = (
    Check("stg_cpi", "cpi_category", "not_null"),
    Check("stg_cpi", "period_date", "not_null"),
    Check("stg_cpi", "cpi_value", "not_null"),
    Check("stg_fx", "currency_pair", "not_null"),
    Check("stg_fx", "currency_pair", "accepted_values", KEY_CURRENCIES),
    Check("stg_fx", "period_date", "not_null"),
    Check("stg_fx", "sgd_per_foreign_unit", "not_null"),
    Check("stg_trade", "trade_type", "not_null"),
    Check("stg_trade", "trade_type", "accepted_values", TRADE_TYPES),
    Check("stg_trade", "period_date", "not_null"),
    Check("stg_trade", "trade_value_sgd_million", "not_null"),
    Check("fct_sg_macro_monthly", "period_date", "not_null"),
    Check("fct_sg_macro_monthly", "period_date", "unique"),
    Check("fct_sg_macro_monthly", "cpi_value", "not_null"),
    Check("fct_sg_macro_monthly", "period_year", "not_null"),
)

# Extra checks named in the docs (composite grain, calendar key), plus a
# guard for export total lines, which the fact would add on top of the
# commodity lines it sums. Report only.
EXTRA_CHECKS: tuple[Check, ...] = (
    Check("stg_cpi", ("cpi_category", "period_date"), "unique"),
    Check("stg_fx", ("currency_pair", "period_date"), "unique"),
    Check("stg_trade", "commodity_category", "rejected_values", ("Total Merchandise Exports",)),
    Check("dim_calendar", "period_date", "unique"),
    Check("fct_sg_macro_monthly", "usd_sgd_rate", "not_null"),
)


def failure_count(check: Check):
    """Rows that fail a check of single rows, as an aggregate."""
    c = F.col(check.columns[0])
    if check.test == "not_null":
        return F.count_if(c.isNull())
    if check.test == "accepted_values":
        # nulls are left to not_null
        return F.count_if(c.isNotNull() & ~c.isin(*check.values))
    if check.test == "rejected_values":
        return F.count_if(c.isin(*check.values))
    raise ValueError(check.test)


def _keyed(cols) -> "F.Column":
    cond = F.lit(True)
    for k in cols:           # rows with a null key are left out of `unique`
        cond = cond & F.col(k).isNotNull()
    return cond


def duplicated_keys(df: DataFrame, columns: Sequence[str], salts: int = 1024) -> tuple[DataFrame, Column]:
    """Rows dealt out by a key, and a column that is true at the second row of every key.

    One exchange deals rows of one key to one task, where a window over the
    sorted rows numbers them; what is written next is laid out by the key. Rows
    with a null in the key, which ``unique`` leaves out, are dealt to ``salts`` tasks.
    """
    keyed, by = _keyed(columns), [F.col(c) for c in columns]
    dealt = df
    if any(df.schema[c].nullable for c in columns):
        salt = F.when(keyed, F.lit(0)).otherwise(F.pmod(F.xxhash64(*df.columns), F.lit(salts)) + 1)
        dealt, by = df.withColumn("__salt", salt), [*by, F.col("__salt")]
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.col(columns[0])))
    return dealt.repartition(*by).withColumn("__place", place), keyed & (F.col("__place") == 2)


def _model_report(model: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check for one model, reading the model once.

    Without a ``unique`` check: one global aggregate (partial per task).
    With one: the model is grouped by that key once; the row-level checks are
    counted per group and summed, and the duplicated keys are the groups
    with more than one row. Further ``unique`` checks on other keys of the
    same model are scalar subqueries.
    """
    row_checks = [c for c in checks if c.test != "unique"]
    uniques = [c for c in checks if c.test == "unique"]
    if uniques:
        first = uniques[0]
        groups = df.groupBy(*first.columns).agg(
            F.count(F.lit(1)).alias("n"),
            *[failure_count(c).cast("bigint").alias(f"f{i}") for i, c in enumerate(row_checks)])
        one = groups.agg(F.sum("n").alias("rows_checked"),
                         *[F.sum(f"f{i}").alias(f"f{i}") for i in range(len(row_checks))],
                         F.count_if((F.col("n") > 1) & _keyed(first.columns)).cast("bigint").alias("u0"))
        one = one.select(F.coalesce("rows_checked", F.lit(0)).cast("bigint").alias("rows_checked"),
                         *[F.coalesce(f"f{i}", F.lit(0)).alias(f"f{i}") for i in range(len(row_checks))],
                         "u0")
    else:
        one = df.agg(F.count(F.lit(1)).alias("rows_checked"),
                     *[failure_count(c).cast("bigint").alias(f"f{i}") for i, c in enumerate(row_checks)])
    extra = []
    for i, c in enumerate(uniques[1:], start=1):
        # number of duplicated key values, as an uncorrelated scalar subquery
        dup = (df.where(_keyed(c.columns)).groupBy(*c.columns).count().where(F.col("count") > 1)
               .select(F.count(F.lit(1))).scalar())
        extra.append(dup.cast("bigint").alias(f"u{i}"))
    if extra:
        one = one.select("*", *extra)
    rows = []
    for i, c in enumerate(row_checks):
        rows.append(F.struct(F.lit(c.label).alias("column_name"), F.lit(c.test).alias("test"),
                             F.col(f"f{i}").alias("failures")))
    for i, c in enumerate(uniques):
        rows.append(F.struct(F.lit(c.label).alias("column_name"), F.lit(c.test).alias("test"),
                             F.col(f"u{i}").alias("failures")))
    return (one.select(F.lit(model).alias("model"), "rows_checked", F.inline(F.array(*rows)))
            .select("model", "column_name", "test", "rows_checked", "failures",
                    F.when(F.col("failures") == 0, F.lit("PASS")).otherwise(F.lit("FAIL"))
                    .alias("status")))


def run_checks(models: Mapping[str, DataFrame], checks: Sequence[Check] = MODEL_CHECKS) -> DataFrame:
    """Report frame: model, column_name, test, rows_checked, failures, status."""
    out = None
    for model in dict.fromkeys(c.model for c in checks):
        part = _model_report(model, models[model], [c for c in checks if c.model == model])
        out = part if out is None else out.unionByName(part)
    return out


class DataTestFailure(RuntimeError):
    pass


def gate(report: DataFrame) -> None:
    """Raise if any check failed, naming each (run before the export is written).

    The report has one row per declared check, so its failures are bounded by
    the code that declares them.
    """
    failed = report.where(F.col("status") != "PASS").select("model", "column_name", "test", "failures")
    bad = failed.collect()
    if bad:
        raise DataTestFailure("; ".join(f"{r.model}.{r.column_name} {r.test}: {r.failures}" for r in bad))
