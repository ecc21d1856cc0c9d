"""Month parsing and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import col

# The month-text layouts of the landed sources.
SPACED_MONTH = "yyyy MMM"    # '2024 Jan' (CPI payload)
COMPACT_MONTH = "yyyyMMM"    # '2024Jan'  (FX and trade records)


def parse_month(c, fmt: str = COMPACT_MONTH) -> Column:
    """Month text -> DATE (first of month). ANSI mode: unknown months fail."""
    return F.to_date(col(c), fmt)


def month_text(c, fmt: str = COMPACT_MONTH) -> Column:
    """DATE/TIMESTAMP -> month text in one of the landed layouts."""
    return F.date_format(col(c), fmt)


def year_of_text(c) -> Column:
    """``left(text, 4)::integer``."""
    return F.substring(col(c), 1, 4).cast("int")


def abbr_of_text(c) -> Column:
    """``right(text, 3)``: the month abbreviation of a compact month."""
    return F.right(col(c), F.lit(3))


def month_start(c) -> Column:
    """Truncate a date or timestamp to the first day of its month (DATE)."""
    return F.trunc(F.to_date(col(c)), "month")


def month_abbr(c) -> Column:
    return F.date_format(col(c), "MMM")


def month_name(c) -> Column:
    return F.date_format(col(c), "MMMM")


def quarter_label(c) -> Column:
    """'Q1'..'Q4'."""
    return F.concat(F.lit("Q"), F.quarter(col(c)).cast("string"))


# Trade seasons by calendar month.
SEASONS = (
    (3, 5, "Asia Dry Season"),
    (6, 9, "Monsoon Season"),
)
SEASON_OTHER = "Year End / Q1"


def trade_season(c) -> Column:
    m = F.month(col(c))
    out = None
    for lo, hi, label in SEASONS:
        cond = m.between(lo, hi)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(SEASON_OTHER))
