"""Sorts, limits and top-k (TOP-1..7).

Global top-k uses ``orderBy(...).limit(k)``: Spark plans it as
TakeOrderedAndProject (a per-partition heap of k rows, then one merge of
partitions × k rows), never a full sort.  Ties are broken by a key column so
results are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nlargest(df: DataFrame, k: int, column: str, tie: Sequence[str] = ()) -> DataFrame:
    """TOP-1."""
    return df.orderBy(F.col(column).desc_nulls_last(), *[F.col(t) for t in tie]).limit(k)


def top_keys_history(df: DataFrame, key: str, value: str, k: int, how: str = "mean") -> DataFrame:
    """TOP-2: rank keys by mean (or sum) of ``value`` and keep every row of the best k."""
    agg = F.avg(value) if how == "mean" else F.sum(value)
    best = df.groupBy(key).agg(agg.alias("_s")).orderBy(F.col("_s").desc_nulls_last(), key).limit(k).select(key)
    return df.join(best, key, "left_semi")


def top_and_bottom(df: DataFrame, key: str, value: str, k: int = 5) -> DataFrame:
    """TOP-3: both ends of a ranked per-key mean, tagged ``top``/``bottom`` with their rank."""
    means = df.groupBy(key).agg(F.avg(value).alias("mean_value")).filter(F.col("mean_value").isNotNull())
    top = (means.orderBy(F.col("mean_value").desc(), key).limit(k)
           .withColumn("end", F.lit("top")))
    bottom = (means.orderBy(F.col("mean_value").asc(), key).limit(k)
              .withColumn("end", F.lit("bottom")))
    return top.unionByName(bottom)


def by_absolute(df: DataFrame, column: str, tie: Sequence[str] = ()) -> DataFrame:
    """TOP-4: sort by |value| descending."""
    return df.orderBy(F.abs(F.col(column)).desc_nulls_last(), *[F.col(t) for t in tie])


def top_abs(df: DataFrame, column: str, k: int, tie: Sequence[str] = ()) -> DataFrame:
    """TOP-5: k rows with the largest |value|."""
    return by_absolute(df, column, tie).limit(k)


def recommend(df: DataFrame, key: str, value: str, top_n: int = 5, extra: Sequence[Column] = ()) -> DataFrame:
    """TOP-6: keys by mean historical ``value``, ranked 1..n (1 ≤ n ≤ 15 in the reference API)."""
    if not 1 <= top_n <= 15:
        raise ValueError("top_n must be within 1..15")
    means = df.groupBy(key).agg(F.avg(value).alias("mean_growth"), *extra)
    best = means.filter(F.col("mean_growth").isNotNull()).orderBy(F.col("mean_growth").desc(), key).limit(top_n)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.col("mean_growth").desc(), key)))


def most_variable(df: DataFrame, key: str, features: Sequence[str], k: int) -> DataFrame:
    """TOP-7: features with the largest sample variance of their per-key means."""
    means = df.groupBy(key).agg(*[F.avg(c).alias(c) for c in features])
    long = means.unpivot([key], list(features), "feature", "value")
    return (long.groupBy("feature").agg(F.var_samp("value").alias("variance"))
            .orderBy(F.col("variance").desc_nulls_last(), "feature").limit(k))
