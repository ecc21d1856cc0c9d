"""Numeric column helpers (all JVM-side expressions, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import col


def round_to(c, digits: int) -> Column:
    """Round half away from zero at ``digits`` places: ``round(x * 10^n) / 10^n``.

    Spark's ``round(double, n)`` rounds the decimal text of the double, which
    differs on ties from engines that scale first; scaling explicitly gives the
    same result as the SQL models' ``round(x, n)``.
    """
    scale = float(10 ** digits)
    return F.round(col(c) * F.lit(scale)) / F.lit(scale)


def nullif_zero(c) -> Column:
    """``nullif(x, 0)``: a zero divisor becomes null instead of raising."""
    return F.nullif(col(c), F.lit(0))


def exact_sum(c, scale: int = 6) -> Column:
    """Sum of a double column as a decimal, returned as double (for small,
    month-grain inputs; ``unit_sum`` is the fast path for large scans).

    A double sum depends on the order rows arrive in, which changes with the
    partitioning of the cluster; the decimal sum does not, so a rerun on any
    number of executors returns the same bits. Values are exact to ``scale``
    places.
    """
    return F.sum(col(c).cast(f"decimal(38,{scale})")).cast("double")


def unit_sum(c, scale: int = 2) -> Column:
    """Exact sum for large scans of values with at most ``scale`` decimals.

    Each value becomes a whole number of 1/10^scale units (``rint``, long),
    so the sum runs on the fast long aggregation path (no per-row decimal
    arithmetic) and is exact and order-independent; ANSI mode raises on
    overflow instead of wrapping. Equals ``exact_sum`` for such values.
    """
    units = F.rint(col(c) * float(10 ** scale)).cast("long")
    return F.sum(units) / float(10 ** scale)


def exact_avg(c, scale: int = 6) -> Column:
    """Mean computed as ``exact_sum / count`` (nulls ignored, like ``avg``)."""
    return exact_sum(c, scale) / F.count(col(c))


def nan_to_null(c) -> Column:
    """NaN -> null. Bronze loads do this so NaN never passes ``> 0`` later."""
    c = col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


# Fixed value: the numbers that the loaders accept, plain or with an exponent,
# plus infinity and NaN. The engine's own cast also takes type suffixes (1.5f)
# and hexadecimal forms, which are footnote marks or errors in a source file.
NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def lenient_double(c) -> Column:
    """Parse text to double; anything that is no number becomes null (coerce)."""
    c = col(c)
    return nan_to_null(F.when(c.rlike(NUMBER), F.trim(c).try_cast("double")))


def strict_double(c, null_marks=("", "na")) -> Column:
    """Parse text to double; the null marks become null, other bad text fails,
    so a malformed payload stops the load instead of being loaded as nulls.
    """
    c = col(c)
    bad = F.raise_error(F.concat(F.lit("not a number: "), c)).cast("double")
    return (F.when(c.isNull() | c.isin(*null_marks), F.lit(None).cast("double"))
            .when(c.rlike(NUMBER), F.trim(c).cast("double")).otherwise(bad))
