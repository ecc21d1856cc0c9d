"""Threshold labels used by the signal queries, and the fixed source labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import col

# Series labels of the landed sources.
HEADLINE_CPI = "All Items"
USD = "US Dollar"
CNY = "Renminbi"
KEY_CURRENCIES = (
    "US Dollar",
    "Renminbi",
    "Euro",
    "Malaysian Ringgit",
    "Japanese Yen",
    "Sterling Pound",
    "Australian Dollar",
)
IMPORTS = "imports"
EXPORTS = "exports"
TRADE_TYPES = (IMPORTS, EXPORTS)
IMPORT_TOTAL = "Total Merchandise Imports"

# Inflation bands (year-on-year change as a fraction).
HIGH_ABOVE = 0.04
ELEVATED_ABOVE = 0.02
STABLE_FROM = 0.0
REGIME_LABELS = ("HIGH", "ELEVATED", "STABLE", "DEFLATION")
ACTION_LABELS = (
    "Lock prices. Hedge FX. Accelerate orders.",
    "Review contracts. Monitor USD/SGD monthly.",
    "Negotiate hard. Lock multi-year deals now.",
    "Spot buy. Extend terms. Hold inventory light.",
)
SCATTER_LABELS = (
    "High above 4pct",
    "Moderate 2 to 4pct",
    "Low 0 to 2pct",
    "Deflation below 0",
)

# Sourcing bands on the USD rate.
FAVOUR_US_BELOW = 1.30
FAVOUR_CHINA_ABOVE = 1.40
SIGNAL_LABELS = ("Favour US", "Favour China", "Neutral")

# Trade balance status.
BALANCE_LABELS = ("Surplus", "Deficit")


def inflation_band(c, labels=REGIME_LABELS) -> Column:
    """> 0.04, > 0.02, >= 0, else. A null input falls to the last label."""
    c = col(c)
    return (F.when(c > HIGH_ABOVE, F.lit(labels[0]))
            .when(c > ELEVATED_ABOVE, F.lit(labels[1]))
            .when(c >= STABLE_FROM, F.lit(labels[2]))
            .otherwise(F.lit(labels[3])))


def sourcing_signal(c) -> Column:
    """< 1.30 favour US, > 1.40 favour China, else neutral (bounds neutral)."""
    c = col(c)
    return (F.when(c < FAVOUR_US_BELOW, F.lit(SIGNAL_LABELS[0]))
            .when(c > FAVOUR_CHINA_ABOVE, F.lit(SIGNAL_LABELS[1]))
            .otherwise(F.lit(SIGNAL_LABELS[2])))


def balance_status(c) -> Column:
    """> 0 surplus, else deficit (a null balance reads deficit)."""
    return F.when(col(c) > 0, F.lit(BALANCE_LABELS[0])).otherwise(F.lit(BALANCE_LABELS[1]))
