"""Missing data (MIS-1..8).

Per-column statistics are fused into one aggregate (one scan for all columns).
Per-key ordered fills use a window by key; for very large keys pass ``bucket``
(a coarse order bucket, e.g. the day of a timestamp): the window then runs per
(key, bucket) and a small per-bucket carry table bridges bucket borders, so a
key holding a third of all rows is still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.quantile import grouped_quantiles, quantile_scalars


def null_profile(df: DataFrame, columns: Sequence[str] | None = None, threshold_pct: float = 50.0) -> DataFrame:
    """MIS-1: (column_name, n_null, null_pct, above_threshold), sorted by null_pct desc."""
    cols = list(columns or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    long = wide.unpivot("_n", cols, "column_name", "n_null")
    return (long.select("column_name", F.col("n_null").cast("long").alias("n_null"),
                        (F.try_divide(F.col("n_null") * 100.0, F.col("_n"))).alias("null_pct"))
            .withColumn("above_threshold", (F.col("null_pct") > threshold_pct).cast("int")))


def drop_high_missing(df: DataFrame, threshold: float = 0.6) -> DataFrame:
    """MIS-2: drop columns whose NULL fraction exceeds ``threshold``.

    One aggregate row (one number per column) reaches the driver; the data does not.
    """
    fractions = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns]).first()
    keep = [c for c in df.columns if fractions[c] is None or fractions[c] <= threshold]
    return df.select(*keep)


def _bucket_table(df: DataFrame, keys: list[str], bucket: str, order: str, c: str) -> DataFrame:
    nn_order = F.when(F.col(c).isNotNull(), F.col(order))
    return df.groupBy(*keys, bucket).agg(F.max_by(c, nn_order).alias(f"_last_{c}"),
                                         F.min_by(c, nn_order).alias(f"_first_{c}"))


def ffill_bfill(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str],
                bucket: Column | None = None) -> DataFrame:
    """MIS-3: per key, in order: forward fill, then backward fill the leading gap."""
    keys = list(keys)
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(order)
        fw = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        bw = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        return df.withColumns({c: F.coalesce(F.last(c, True).over(fw), F.first(c, True).over(bw))
                               for c in columns})
    b = "_bucket"
    data = df.withColumn(b, bucket)
    w = Window.partitionBy(*keys, b).orderBy(order)
    fw = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bw = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    inner = data.withColumns({f"_ff_{c}": F.last(c, True).over(fw) for c in columns}
                             | {f"_bf_{c}": F.first(c, True).over(bw) for c in columns})
    carry = None
    for c in columns:
        t = _bucket_table(data, keys, b, order, c)
        carry = t if carry is None else carry.join(t, [*keys, b])
    wb = Window.partitionBy(*keys).orderBy(b)
    carry = carry.select(*keys, b, *[
        e for c in columns for e in (
            F.last(f"_last_{c}", True).over(wb.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_cf_{c}"),
            F.first(f"_first_{c}", True).over(wb.rowsBetween(1, Window.unboundedFollowing)).alias(f"_cb_{c}"))])
    out = inner.join(carry, [*keys, b], "left")
    return out.select(*[
        F.coalesce(F.col(f"_ff_{c}"), F.col(f"_cf_{c}"), F.col(f"_bf_{c}"), F.col(f"_cb_{c}")).alias(c)
        if c in columns else F.col(c) for c in df.columns])


def fill_global_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """MIS-4: remaining NULL → the column's global median (one aggregate, scalar subquery)."""
    med = quantile_scalars(df, columns, [0.5])
    return df.withColumns({c: F.coalesce(F.col(c), med[c][0]) for c in columns})


def fill_key_median(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """MIS-5: NULL → median of the key's own values.

    Exact per-key medians from distributed order statistics joined back on the key;
    the per-key table is broadcast by AQE when small.
    """
    keys = list(keys)
    # exact medians from distributed order statistics (hot keys spread over tasks), all columns in one pass
    own = F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_v")) for c in columns])
    long = df.select(*keys, F.explode(own).alias("_s")).select(*keys, "_s._col", "_s._v")
    meds = grouped_quantiles(long, "_v", [0.5], [*keys, "_col"]).groupBy(*keys).agg(
        *[F.max(F.when(F.col("_col") == c, F.col("q0"))).alias(f"_med_{c}") for c in columns])
    out = df.join(meds, keys, "left")
    return out.select(*[F.coalesce(F.col(c), F.col(f"_med_{c}")).alias(c) if c in columns else F.col(c)
                        for c in df.columns])


def fill_constant(df: DataFrame, value, columns: Sequence[str] | None = None) -> DataFrame:
    """MIS-6: NULL → constant."""
    return df.na.fill(value, subset=list(columns) if columns else None)


def missing_matrix(df: DataFrame, id_columns: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """MIS-7: cell-level 0/1 NULL map beside the id columns."""
    return df.select(*id_columns, *[F.col(c).isNull().cast("int").alias(f"{c}_missing") for c in columns])


def null_cells(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    cols = list(columns or df.columns)
    total = F.lit(0).cast("long")
    for c in cols:
        total = total + F.sum(F.col(c).isNull().cast("long"))
    return total


def missing_before_after(before: DataFrame, after: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """MIS-8: total NULL cells before and after cleaning, as one row."""
    cols = list(columns or before.columns)
    b = before.agg(null_cells(before, cols).alias("missing_before"))
    a_cols = [c for c in cols if c in after.columns]
    return b.select("missing_before", F.lit(after.agg(null_cells(after, a_cols)).scalar()).alias("missing_after"))
