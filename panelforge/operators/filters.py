"""Row filters and column housekeeping (FLT-1..5)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def where(df: DataFrame, eq: Mapping | None = None, between: Mapping | None = None,
          isin: Mapping | None = None, not_in: Mapping | None = None,
          not_null: Iterable[str] = ()) -> DataFrame:
    """FLT-1: conjunction of equality, range, IN, NOT IN and non-null predicates.

    Built as one Catalyst predicate so it reaches the parquet scan.
    """
    conds: list[Column] = []
    for c, v in (eq or {}).items():
        conds.append(F.col(c) == F.lit(v))
    for c, (lo, hi) in (between or {}).items():
        if lo is not None:
            conds.append(F.col(c) >= F.lit(lo))
        if hi is not None:
            conds.append(F.col(c) <= F.lit(hi))
    for c, vs in (isin or {}).items():
        conds.append(F.col(c).isin(list(vs)))
    for c, vs in (not_in or {}).items():
        conds.append(~F.col(c).isin(list(vs)))
    for c in not_null:
        conds.append(F.col(c).isNotNull())
    if not conds:
        return df
    pred = conds[0]
    for c in conds[1:]:
        pred = pred & c
    return df.filter(pred)


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """FLT-2: drop rows with NULL in any of ``subset``."""
    return df.dropna(how="any", subset=list(subset))


def latest_snapshot(df: DataFrame, period: str, at: int | None = None) -> DataFrame:
    """FLT-3: rows of the latest period (scalar subquery, no join) or of a fixed one."""
    if at is not None:
        return df.filter(F.col(period) == F.lit(at))
    return df.filter(F.col(period) == df.select(F.max(period)).scalar())


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def select_features(df: DataFrame, numeric_only: bool = True, drop_suffixes: Sequence[str] = (),
                    drop_substrings: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """FLT-4: schema-driven selection: numeric columns, minus suffix and substring exclusions."""
    cols = numeric_columns(df) if numeric_only else list(df.columns)
    out = [c for c in cols
           if not any(c.endswith(s) for s in drop_suffixes)
           and not any(s.lower() in c.lower() for s in drop_substrings)]
    keep = [k for k in keep if k not in out]
    return df.select(*keep, *out)


def housekeeping(df: DataFrame, rename: Mapping[str, str] | None = None, drop: Sequence[str] = (),
                 cast: Mapping[str, str] | None = None) -> DataFrame:
    """FLT-5: rename / drop / cast in one projection."""
    rename = dict(rename or {})
    cast = dict(cast or {})
    exprs = []
    for c in df.columns:
        if c in drop:
            continue
        e = F.col(c)
        if c in cast:
            e = e.cast(cast[c])
        exprs.append(e.alias(rename.get(c, c)))
    return df.select(*exprs)
