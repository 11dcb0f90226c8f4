"""Aggregations (AGG-1..20).  All are hash aggregates with map-side partial combine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions import scalar as S
from panelforge.functions.quantile import grouped_quantiles, median, quantile_scalars

_AGG = {"mean": F.avg, "avg": F.avg, "sum": F.sum, "count": F.count, "min": F.min, "max": F.max,
        "std": F.stddev_samp, "var": F.var_samp, "nunique": F.countDistinct, "median": median}


def grouped(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """AGG-1 / AGG-2 / AGG-12: named aggregates ``{out_name: (how, column)}`` per key."""
    return df.groupBy(*keys).agg(*[_AGG[how](c).alias(name) for name, (how, c) in aggs.items()])


def ordered_labels(df: DataFrame, column: str, order: Sequence[str], name: str = "_ord") -> DataFrame:
    """AGG-2: fixed row order of labels as a sort key column."""
    return df.withColumn(name, S.recode(column, {v: i for i, v in enumerate(order)}, len(order)))


def mean_sem(df: DataFrame, keys: Sequence[str], value: str, z: float = 1.96) -> DataFrame:
    """AGG-3: mean, standard error s/√n (sample s) and the ±z·sem bar per group."""
    n = F.count(value)
    sem = F.stddev_samp(value) / F.sqrt(n)
    return df.groupBy(*keys).agg(F.avg(value).alias("mean"), sem.alias("sem"), (F.lit(z) * sem).alias("ci95"),
                                 n.alias("n"))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """AGG-4: number of distinct values per column (one row)."""
    return df.agg(*[F.countDistinct(c).alias(f"n_{c}") for c in columns])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """AGG-5: frequency per value, descending (ties by value)."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col(column))


def pivot_mean(df: DataFrame, row: str, col: str, value: str, how: str = "mean",
               values: Sequence | None = None) -> DataFrame:
    """AGG-6 / RSH-2: row × col matrix (pass ``values`` to skip the distinct pass)."""
    g = df.groupBy(row).pivot(col, list(values) if values is not None else None)
    return g.agg(_AGG[how](value))


def conditional_means(df: DataFrame, value: str, conds: Mapping[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    """AGG-9 / AGG-11 / JN-6: ``avg(when(cond, value))`` per named condition, optionally per key."""
    exprs = [F.avg(F.when(c, F.col(value))).alias(n) for n, c in conds.items()]
    return df.groupBy(*keys).agg(*exprs) if keys else df.agg(*exprs)


def arg_extremes(df: DataFrame, key: str, value: str) -> DataFrame:
    """AGG-10: key with the highest and the lowest mean of ``value`` (ties → smallest key)."""
    means = df.groupBy(key).agg(F.avg(value).alias("_m"))
    return means.agg(F.max_by(key, F.struct(F.col("_m"), -F.col(key) if _is_num(means, key) else F.lit(0)))
                     .alias("best_key"), F.max("_m").alias("best_mean"),
                     F.min_by(key, F.struct(F.col("_m"), F.col(key) if _is_num(means, key) else F.lit(0)))
                     .alias("worst_key"), F.min("_m").alias("worst_mean"))


def _is_num(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.typeName() in ("integer", "long", "short", "byte", "double", "float")


def entity_vs_total(df: DataFrame, key: str, period: str, value: str, entity) -> DataFrame:
    """AGG-13: yearly sum for one key beside the yearly total, as a union of tagged rows."""
    one = (df.filter(F.col(key) == F.lit(entity)).groupBy(period).agg(F.sum(value).alias("total"))
           .withColumn("series", F.lit(str(entity))))
    allk = df.groupBy(period).agg(F.sum(value).alias("total")).withColumn("series", F.lit("ALL"))
    return one.unionByName(allk)


def histogram(df: DataFrame, column: str, bins: int = 10, keys: Sequence[str] = ()) -> DataFrame:
    """AGG-14: equal-width bin counts over [min, max] (the max falls in the last bin)."""
    st = df.agg(F.struct(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))).scalar()
    lo, hi = st["lo"], st["hi"]
    width = (hi - lo) / bins
    b = F.when(hi == lo, F.lit(0)).otherwise(F.least(F.floor((F.col(column) - lo) / width), F.lit(bins - 1)))
    out = (df.filter(F.col(column).isNotNull()).groupBy(*keys, b.cast("int").alias("bin"))
           .agg(F.count(F.lit(1)).alias("n")))
    return out.select(*keys, "bin", (lo + F.col("bin") * width).alias("bin_lo"),
                      (lo + (F.col("bin") + 1) * width).alias("bin_hi"), "n")


def box_stats(df: DataFrame, keys: Sequence[str], value: str, k: float = 1.5) -> DataFrame:
    """AGG-15: Q1, median, Q3, whiskers (most extreme points within the fences) and outlier count."""
    keys = list(keys)
    q = grouped_quantiles(df, value, [0.25, 0.5, 0.75], keys).select(
        *keys, F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    j = df.join(q, keys)
    lo = F.col("q1") - k * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + k * (F.col("q3") - F.col("q1"))
    x = F.col(value)
    return j.groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(x >= lo, x)).alias("whisker_lo"), F.max(F.when(x <= hi, x)).alias("whisker_hi"),
        F.sum(S.flag((x < lo) | (x > hi))).cast("long").alias("n_outliers"))


def eda_overview(df: DataFrame, key: str, value: str, period_label: str, pre: str, post: str) -> DataFrame:
    """AGG-16: one-row overview: rows, columns, mean, median, std, min, max, pre/post means, best/worst key."""
    base = df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_cols"),
                  F.avg(value).alias("mean"), quantile_scalars(df, [value], [0.5])[value][0].alias("median"),
                  F.stddev_samp(value).alias("std"),
                  F.min(value).alias("min"), F.max(value).alias("max"),
                  F.avg(F.when(F.col(period_label) == pre, F.col(value))).alias("pre_mean"),
                  F.avg(F.when(F.col(period_label) == post, F.col(value))).alias("post_mean"))
    ext = arg_extremes(df, key, value)
    s = ext.select(F.struct("best_key", "worst_key")).scalar()
    return base.withColumns({"best_key": s["best_key"], "worst_key": s["worst_key"]})


def coverage_filter(df: DataFrame, key: str, slack: int = 1) -> DataFrame:
    """AGG-17: keep keys with at least max(count) − slack rows (HAVING + semi-join)."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    keep = counts.filter(F.col("_n") >= counts.select(F.max("_n")).scalar() - slack).select(key)
    return df.join(keep, key, "left_semi")


def dataset_summary(df: DataFrame, key: str, period: str, target: str, totals: Sequence[str] = ()) -> DataFrame:
    """AGG-18: rows, keys, period range, target mean/std and column totals (one row)."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.countDistinct(key).alias("n_keys"),
                  F.min(period).alias("first_period"), F.max(period).alias("last_period"),
                  F.avg(target).alias("target_mean"), F.stddev_samp(target).alias("target_std"),
                  *[F.sum(c).alias(f"total_{c}") for c in totals])


def variance_decomposition(df: DataFrame, group: str, value: str) -> DataFrame:
    """AGG-20: per group (group mean − grand mean)² / total sample variance · 100 (unweighted)."""
    st = df.agg(F.struct(F.avg(value).alias("mu"), F.var_samp(value).alias("var"))).scalar()
    g = df.groupBy(group).agg(F.avg(value).alias("group_mean"))
    return g.select(group, "group_mean",
                    F.try_divide(F.pow(F.col("group_mean") - st["mu"], 2) * 100.0, st["var"]).alias("share_pct"))


def window_rank_desc(order: Column, keys: Sequence[str] = ()) -> Column:
    w = Window.partitionBy(*keys).orderBy(order) if keys else Window.orderBy(order)
    return F.row_number().over(w)
