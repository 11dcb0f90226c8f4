"""Ordered per-key windows (WIN-1..13).

Every function takes the key and order columns.  Where a window would need the
whole of one very large key, the ``bucket`` variants split the key by a coarse
order bucket and bridge the borders with a small per-bucket table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions import scalar as S
from panelforge.functions.quantile import grouped_quantiles
from panelforge.operators.ordered import attach, carry_over, earlier, positions, ranges
from panelforge.operators.spectral import SHORT_SERIES, lagged_products
from panelforge.session import materialize

#: Rows per block of a spread window.
BLOCK_ROWS = 1 << 16


def spec(keys: Sequence[str], order: str | Column) -> Window:
    return Window.partitionBy(*keys).orderBy(order)


def lag(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], n: int = 1,
        suffix: str = "_lag", bucket: Column | None = None) -> DataFrame:
    """WIN-1: previous row's value per key (n rows back).

    With ``bucket`` (n = 1): lag inside (key, bucket), the first row of a bucket
    takes the last value of the key's previous non-empty bucket.
    """
    keys = list(keys)
    if bucket is None:
        w = spec(keys, order)
        return df.withColumns({f"{c}{suffix}{n}": F.lag(c, n).over(w) for c in columns})
    if n != 1:
        raise ValueError("bucketed lag supports n = 1")
    data = df.withColumn("_bucket", bucket)
    w = spec([*keys, "_bucket"], order)
    inner = data.withColumns({"_is_first": F.lag(F.lit(1), 1).over(w).isNull(),
                              **{f"_in_{c}": F.lag(c, 1).over(w) for c in columns}})
    last = data.groupBy(*keys, "_bucket").agg(*[F.max_by(c, order).alias(f"_last_{c}") for c in columns])
    wb = spec(keys, "_bucket")
    carry = last.select(*keys, "_bucket", *[F.lag(f"_last_{c}", 1).over(wb).alias(f"_carry_{c}") for c in columns])
    out = inner.join(carry, [*keys, "_bucket"], "left")
    return out.select(*df.columns, *[
        F.when(F.col("_is_first"), F.col(f"_carry_{c}")).otherwise(F.col(f"_in_{c}")).alias(f"{c}{suffix}1")
        for c in columns])


def growth(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str],
           suffix: str = "_growth") -> DataFrame:
    """WIN-2: (x − lag x)/lag x · 100 per key; first row and zero lag → NULL."""
    w = spec(keys, order)
    return df.withColumns({f"{c}{suffix}": S.safe_ratio(F.col(c) - F.lag(c).over(w), F.lag(c).over(w), 100.0)
                           for c in columns})


def rolling_mean(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], size: int = 3,
                 suffix: str = "_roll", spread: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """WIN-3: trailing ``size``-row mean (min_periods = 1, NULL skipped).

    With ``spread`` rows are numbered across tasks and the window runs per (key, block of
    positions); the last ``size`` - 1 rows of a block are copied to the next one as its border,
    so no task holds a hot key and every frame has the same rows as in the plain window.
    """
    if not spread:
        w = spec(keys, order).rowsBetween(-(size - 1), Window.currentRow)
        return df.withColumns({f"{c}{suffix}{size}": F.avg(c).over(w) for c in columns})
    rows = max(block_rows, size)
    at = F.col("_pos") - 1
    own, border = F.floor(at / rows), at % rows > rows - size
    homes = F.when(border, F.array(own, own + 1)).otherwise(F.array(own))
    placed = positions(df, keys, order).select("*", F.posexplode(homes).alias("_copy", "_block"))
    w = Window.partitionBy(*keys, "_block").orderBy("_pos").rowsBetween(-(size - 1), Window.currentRow)
    means = {f"{c}{suffix}{size}": F.avg(c).over(w) for c in columns}
    return placed.withColumns(means).where("_copy = 0").drop("_pos", "_copy", "_block")


def first_difference(df: DataFrame, keys: Sequence[str], order: str, column: str, name: str = "diff") -> DataFrame:
    """WIN-4: x − lag(x)."""
    return df.withColumn(name, F.col(column) - F.lag(column).over(spec(keys, order)))


def nth_from_end(df: DataFrame, keys: Sequence[str], order: str, column: str, n: int) -> DataFrame:
    """WIN-5: per key, the value ``n`` rows before the last one (and the last value)."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    ranked = df.withColumn("_rn", F.row_number().over(w))
    return ranked.groupBy(*keys).agg(
        F.max(F.when(F.col("_rn") == 1, F.col(column))).alias("last_value"),
        F.max(F.when(F.col("_rn") == n + 1, F.col(column))).alias(f"value_{n}_before"),
        F.count(F.lit(1)).alias("n_points"))


def holdout_split(df: DataFrame, keys: Sequence[str], order: str, test_n: int) -> DataFrame:
    """WIN-6: last ``test_n`` rows per key are test, the rest train (``split`` column)."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return df.withColumn("split", F.when(F.row_number().over(w) <= test_n, "test").otherwise("train"))


def lag_matrix(df: DataFrame, keys: Sequence[str], order: str, column: str, lookback: int) -> DataFrame:
    """WIN-7: each row with its previous ``lookback`` values; incomplete rows dropped."""
    w = spec(keys, order)
    lags = {f"{column}_l{i}": F.lag(column, i).over(w) for i in range(1, lookback + 1)}
    return df.withColumns(lags).dropna(subset=list(lags))


def average_rank(df: DataFrame, column: str, name: str = "avg_rank", keys: Sequence[str] = ()) -> DataFrame:
    """WIN-8: rank with ties sharing the mean rank (Spearman, Kruskal–Wallis).

    Pre-aggregates to distinct values (one row per value and key), ranks the
    distinct values by a cumulative count and joins the rank back: the window
    only sees distinct values.  ``global_average_rank`` spreads even that over
    range partitions.
    """
    keys = list(keys)
    counts = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_t"))
    w = Window.partitionBy(*keys).orderBy(column).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranks = counts.select(*keys, column, (F.sum("_t").over(w) - (F.col("_t") - 1) / 2.0).alias(name))
    return df.join(ranks, [*keys, column], "left")


def global_average_rank(df: DataFrame, column: str, name: str = "avg_rank", n_ranges: int | None = None) -> DataFrame:
    """WIN-8 without any single-task window: distinct values are range-partitioned,
    ranked within their range, and shifted by the counts of all lower ranges."""
    spark = df.sparkSession
    n_ranges = n_ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_t"))
    # checkpoint: partition ids must be the same for both uses below
    ranged = counts.repartitionByRange(n_ranges, column).withColumn("_pid", F.spark_partition_id()).checkpoint()
    totals = ranged.groupBy("_pid").agg(F.sum("_t").alias("_pt"))
    wt = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", F.coalesce(F.sum("_pt").over(wt), F.lit(0)).alias("_off"))
    w = Window.partitionBy("_pid").orderBy(column).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select(column, "_pid", "_t", F.sum("_t").over(w).alias("_cum"))
    ranks = (local.join(F.broadcast(offsets), "_pid")
             .select(column, (F.col("_off") + F.col("_cum") - (F.col("_t") - 1) / 2.0).alias(name)))
    return df.join(ranks, column, "left")


def top_rank(df: DataFrame, order: Column, name: str = "rank", keys: Sequence[str] = ()) -> DataFrame:
    """WIN-9: 1..N after sort (row_number)."""
    w = Window.partitionBy(*keys).orderBy(order) if keys else Window.orderBy(order)
    return df.withColumn(name, F.row_number().over(w))


def running_best(df: DataFrame, order: str, value: str, keys: Sequence[str] = (), name: str = "best_so_far",
                 maximize: bool = True, spread: bool = False) -> DataFrame:
    """WIN-10: cumulative max (or min) over the order.

    With ``spread`` it runs inside ranges of (key, order); a range that continues a key takes
    the best of the key's earlier ranges.
    """
    f, better = (F.max, F.greatest) if maximize else (F.min, F.least)
    upto = (Window.unboundedPreceding, Window.currentRow)
    if not spread:
        base = Window.partitionBy(*keys).orderBy(order) if keys else Window.orderBy(order)
        return df.withColumn(name, f(value).over(base.rowsBetween(*upto)))
    ranged = ranges(df, keys, [order])
    per_range = ranged.groupBy(*keys, "_range").agg(f(value).alias("_best"))
    inside = f(value).over(Window.partitionBy(*keys, "_range").orderBy(order).rowsBetween(*upto))
    return (carry_over(ranged.withColumn("_inside", inside), per_range, keys, _carry=f("_best").over(earlier(keys)))
            .withColumn(name, better("_inside", "_carry")).drop("_range", "_inside", "_carry"))


def group_transform(df: DataFrame, keys: Sequence[str], column: str, how: str = "avg", name: str | None = None) -> DataFrame:
    """WIN-11: per-key statistic beside each row (grouped aggregate joined back)."""
    keys = list(keys)
    name = name or f"{column}_{how}"
    if how == "median":
        stats = grouped_quantiles(df, column, [0.5], keys).withColumnRenamed("q0", name)
    else:
        agg = {"avg": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "count": F.count, "std": F.stddev_samp}[how]
        stats = df.groupBy(*keys).agg(agg(column).alias(name))
    return df.join(stats, keys, "left")


def acf(df: DataFrame, keys: Sequence[str], order: str, column: str, max_lag: int | None = None,
        short: int = SHORT_SERIES) -> DataFrame:
    """WIN-12: sample autocorrelation per key at lags 1..L (L = n/2 − 1 by default, below n always).

    r_k = Σ (x_t − x̄)(x_{t+k} − x̄) / Σ (x_t − x̄)²; rows (key…, lag, acf).  All lags come from the
    power spectrum (``spectral``): n log n operations, and a series of more than ``short`` points
    is spread over many tasks.  A constant series has NULL at every lag.
    """
    keys = list(keys)
    x = df.where(F.col(column).isNotNull()).select(*keys, F.col(order).alias("_order"),
                                                   F.col(column).cast("double").alias("_x"))
    placed = materialize(positions(x, keys, "_order").drop("_order"))
    lim = F.lit(max_lag) if max_lag is not None else F.floor(F.col("_n") / 2) - 1
    size = placed.groupBy(*keys).agg(F.avg("_x").alias("_mu"), F.count(F.lit(1)).alias("_n"))
    size = size.withColumn("_lim", F.least(lim, F.col("_n") - 1).cast("long"))
    centred = attach(placed, size, keys).select(*keys, "_pos", (F.col("_x") - F.col("_mu")).alias("_d"), "_n", "_lim")
    spread = centred.groupBy(*keys).agg(F.sum(F.col("_d") * F.col("_d")).alias("_ss"))
    return (attach(lagged_products(centred, keys, short), spread, keys)
            .select(*keys, F.col("lag").cast("int").alias("lag"), F.try_divide(F.col("num"), F.col("_ss")).alias("acf")))


def pacf_from_acf(acf_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """WIN-13: partial autocorrelation (Yule–Walker / Durbin–Levinson) from the ACF rows.

    One small row per key (its ACF vector) goes through ``applyInPandas``.
    """
    import pandas as pd  # noqa: F401  (executed on workers)
    keys = list(keys)
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in acf_df.schema.fields if f.name in keys]
                       + ["lag int", "pacf double"])

    def durbin_levinson(pdf):
        import numpy as np
        import pandas as pd
        pdf = pdf.sort_values("lag")
        r = np.concatenate([[1.0], pdf["acf"].to_numpy(dtype=float)])
        L = len(r) - 1
        out = []
        phi_prev = np.zeros(0)
        for k in range(1, L + 1):
            if k == 1:
                phi_kk = r[1]
                phi = np.array([phi_kk])
            else:
                num = r[k] - np.dot(phi_prev, r[1:k][::-1])
                den = 1.0 - np.dot(phi_prev, r[1:k])
                phi_kk = num / den if den != 0 else np.nan
                phi = np.concatenate([phi_prev - phi_kk * phi_prev[::-1], [phi_kk]])
            out.append(phi_kk)
            phi_prev = phi
        res = pd.DataFrame({"lag": np.arange(1, L + 1, dtype="int32"), "pacf": out})
        for kcol in keys:
            res.insert(0, kcol, pdf[kcol].iloc[0])
        return res[[*keys, "lag", "pacf"]]

    return acf_df.groupBy(*keys).applyInPandas(durbin_levinson, schema)
