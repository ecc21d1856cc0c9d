"""Wide <-> long reshaping of month-by-column source tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_columns(df: DataFrame, ids: Sequence[str], var: str, value: str,
                    values: Sequence[str] | None = None,
                    exclude: Sequence[str] = ()) -> DataFrame:
    """Wide -> long (``melt``): one output row per id row and value column.

    Value columns default to every column that is not an id or excluded, as
    the loaders discover month columns at run time. Runs row-parallel (an
    Expand node), no shuffle. Value columns of mixed types are cast to string
    first so the long column has one type; casts to numbers come after.
    """
    if values is None:
        values = [c for c in df.columns if c not in set(ids) | set(exclude)]
    types = {t for n, t in df.dtypes if n in values}
    if len(types) > 1:
        df = df.select(*ids, *[F.col(f"`{v}`").cast("string").alias(v) for v in values])
    return df.unpivot(list(ids), list(values), var, value)


def union_all(*frames: DataFrame) -> DataFrame:
    """``UNION ALL`` by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
