"""Set operations and reshaping (SET-1..3, RSH-1..2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    """SET-1: UNION ALL by column name (missing columns → NULL)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def except_pairs(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SET-2: EXCEPT on key pairs (anti-join keeps duplicates out of the shuffle)."""
    return a.select(*keys).distinct().join(b.select(*keys), list(keys), "left_anti")


def union_distinct(*frames: DataFrame) -> DataFrame:
    """SET-3: distinct union."""
    return union_all(*frames).distinct()


def wide_to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], var: str = "feature",
                 value: str = "value") -> DataFrame:
    """RSH-1: unpivot."""
    return df.unpivot(list(ids), list(values), var, value)


def long_to_wide(df: DataFrame, row: str, col: str, value: str, levels: Sequence | None = None) -> DataFrame:
    """RSH-2: pivot with one value per cell (``first``)."""
    return df.groupBy(row).pivot(col, list(levels) if levels is not None else None).agg(F.first(value))
