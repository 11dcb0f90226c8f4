"""Order over many tasks: rows dealt to ranges of (key, order), numbered inside a range and
shifted by the counts of the ranges before.

A range holds about the same number of rows whatever the keys' sizes, so a key with a third
of all rows is spread over a third of the ranges.  Ranges ascend with the keys, so at most one
key crosses each border: what is carried over borders has fewer rows than there are ranges
and is broadcast, however many keys there are.  Rows that are equal in key and order share a
range: an order that names each row once is what lets a hot key spread.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.session import materialize


def attach(rows: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``table`` to ``rows`` on columns of equal names where null equals null."""
    if not on:
        one = F.broadcast(table.withColumn("_one", F.lit(0)))  # without keys the table has one row
        return rows.withColumn("_one", F.lit(0)).join(one, "_one", how).drop("_one")
    right = table.select(*[F.col(c).alias(f"_on_{c}") for c in on], *[c for c in table.columns if c not in on])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on])
    return rows.join(right, same, how).drop(*[f"_on_{c}" for c in on])


def ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], n_ranges: int | None = None) -> DataFrame:
    """``df`` with ``_range``: ranges ascend with (keys, order).  Written once, so every use sees the same ranges."""
    n = n_ranges or max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return materialize(df.repartitionByRange(n, *keys, *order).withColumn("_range", F.spark_partition_id()))


def earlier(keys: Sequence[str]) -> Window:
    """Over a table of one row per key and range: the key's ranges before."""
    return Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)


def carry_over(rows: DataFrame, per_range: DataFrame, keys: Sequence[str], **carried: Column) -> DataFrame:
    """Add ``carried`` columns, taken over ``earlier``, to the rows of ranges that continue a key; null elsewhere.

    ``per_range`` has one row per key and range.  Only ranges that continue a key are joined: one per border at most.
    """
    table = (per_range.withColumns({**carried, "_first": F.count(F.lit(1)).over(earlier(keys)) == 0})
             .where("not _first").select(*keys, "_range", *carried))
    return attach(rows, F.broadcast(table), [*keys, "_range"])


def positions(df: DataFrame, keys: Sequence[str], order: str, name: str = "_pos", n_ranges: int | None = None) -> DataFrame:
    """Add ``name``: the row's place in its key's order, gapless from 1.  Null keys are a key; null orders come first.

    Rows of equal key and order get different places in any order.
    """
    keys = list(keys)
    ranged = ranges(df, keys, [order], n_ranges)
    per_range = ranged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    inside = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(order))
    out = carry_over(ranged.withColumn("_inside", inside), per_range, keys, _before=F.sum("_rows").over(earlier(keys)))
    return (out.withColumn(name, (F.col("_inside") + F.coalesce("_before", F.lit(0))).cast("long"))
            .drop("_range", "_inside", "_before"))


def average_ranks(counts: DataFrame, keys: Sequence[str], value: str, n: str, name: str = "avg_rank",
                  n_ranges: int | None = None) -> DataFrame:
    """Average rank of each value among its key's, from distinct (keys, value) rows with ``n`` copies.

    All keys are ranked by one range partition; the number of sorts does not grow with the keys.
    """
    keys = list(keys)
    ranged = ranges(counts, keys, [value], n_ranges)
    per_range = ranged.groupBy(*keys, "_range").agg(F.sum(n).alias("_rows"))
    upto = F.sum(n).over(Window.partitionBy(*keys, "_range").orderBy(value)
                         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = carry_over(ranged.withColumn("_upto", upto), per_range, keys, _before=F.sum("_rows").over(earlier(keys)))
    return (out.withColumn(name, F.coalesce("_before", F.lit(0)) + F.col("_upto") - (F.col(n) - 1) / 2.0)
            .drop("_range", "_upto", "_before"))
