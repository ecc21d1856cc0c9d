"""Attaching attributes of a large table to a small, bounded frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_attributes(small: DataFrame, large: DataFrame, key: str, attrs: Sequence[str],
                      large_key: str | None = None) -> DataFrame:
    """``small LEFT JOIN large`` for a ``small`` frame whose size is bounded
    by construction (a top-k result, a month spine).

    A left outer join can only build its right side, so joining the large
    table directly would broadcast it (or shuffle it whole). Instead the
    small frame's keys go into a semi-join that streams the large table once
    and keeps only matching rows; the few matches are then joined back. AQE
    broadcasts the keys if their measured size allows it.
    """
    lk = large_key or key
    keys = small.select(F.col(key).alias(lk)).distinct()
    matched = large.select(lk, *attrs).join(keys, lk, "left_semi")
    if lk != key:
        matched = matched.withColumnRenamed(lk, key)
    return small.join(matched, key, "left")
