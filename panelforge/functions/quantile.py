"""Exact quantiles with linear interpolation (pandas/numpy default, DuckDB quantile_cont).

``percentile`` is Spark's exact, mergeable aggregate: map-side partial buffers
hold (value → count) maps that are merged after the shuffle, so rows are not
collected per group; its memory is bounded by the number of *distinct* values
of a group.  ``approx=True`` switches to the fixed-size sketch
(``percentile_approx``) for groups whose distinct values do not fit a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelforge.functions.scalar import ColumnOrName, col


def quantile(c: ColumnOrName, p: float, approx: bool = False, accuracy: int = 100000) -> Column:
    x = col(c).cast("double")
    if approx:
        return F.percentile_approx(x, F.lit(p), F.lit(accuracy))
    return F.percentile(x, F.lit(p))


def quantiles(c: ColumnOrName, ps: Sequence[float], approx: bool = False, accuracy: int = 100000) -> Column:
    """Array of quantiles, one aggregate buffer for all probabilities."""
    x = col(c).cast("double")
    arr = F.array(*[F.lit(float(p)) for p in ps])
    if approx:
        return F.percentile_approx(x, arr, F.lit(accuracy))
    return F.percentile(x, arr)


def median(c: ColumnOrName, approx: bool = False) -> Column:
    return quantile(c, 0.5, approx)


def grouped_quantiles(df, value: str, probs: Sequence[float], by: Sequence[str] = (), n_ranges: int | None = None):
    """Exact interpolated quantiles per group without gathering any group in one task.

    Rows → (group, value, count) with map-side combine; the distinct (group, value) pairs
    are range-partitioned, numbered inside each range and shifted by the counts of the
    same group in lower ranges (a table of groups × ranges), giving each value its
    position interval.  The 2·|probs| target positions per group (a small, broadcast
    table) are then located by interval containment.  A group holding a third of all
    rows is spread over as many ranges as its distinct values need.

    Returns one row per group with ``q0, q1, …`` (in the order of ``probs``).
    """
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from panelforge.operators.joins import bounded_broadcast
    from panelforge.session import materialize
    by = list(by)
    spark = df.sparkSession
    n_ranges = n_ranges or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    data = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    counts = data.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_t"))
    ranged = materialize(counts.repartitionByRange(n_ranges, *by, "_v").withColumn("_pid", F.spark_partition_id()))
    part = materialize(ranged.groupBy(*by, "_pid").agg(F.sum("_t").alias("_pt")))
    wp = (Window.partitionBy(*by).orderBy("_pid") if by else Window.orderBy("_pid")).rowsBetween(
        Window.unboundedPreceding, -1)  # over groups × ranges rows only
    offs = part.select(*by, "_pid", F.coalesce(F.sum("_pt").over(wp), F.lit(0)).alias("_off"))
    wl = Window.partitionBy(*by, "_pid").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_before", F.coalesce(F.sum("_t").over(wl), F.lit(0)))
    pos = (local.join(offs, [*by, "_pid"])
           .select(*by, "_v", (F.col("_off") + F.col("_before") + 1).alias("_start"),
                   (F.col("_off") + F.col("_before") + F.col("_t")).alias("_end")))
    n = part.groupBy(*by).agg(F.sum("_pt").alias("_n")) if by else part.agg(F.sum("_pt").alias("_n"))
    targets = []
    for i, p in enumerate(probs):
        h = (F.col("_n") - 1) * float(p)
        lo = F.floor(h).cast("long")
        targets.append(n.select(*by, F.lit(i).alias("_qi"), (h - lo).alias("_frac"),
                                (lo + 1).alias("_k"), F.lit(0).alias("_which")))
        targets.append(n.select(*by, F.lit(i).alias("_qi"), (h - lo).alias("_frac"),
                                F.least(lo + 2, F.col("_n")).alias("_k"), F.lit(1).alias("_which")))
    tg = targets[0]
    for t in targets[1:]:
        tg = tg.unionByName(t)
    if by:
        # not left to AQE: few groups leave most shuffle partitions empty, and then it does not broadcast but sorts a hot group in one task
        hit = pos.join(bounded_broadcast(tg), by)
    else:
        hit = pos.withColumn("_g", F.lit(0)).join(F.broadcast(tg.withColumn("_g", F.lit(0))), "_g")
    hit = hit.filter((F.col("_k") >= F.col("_start")) & (F.col("_k") <= F.col("_end")))
    pair = hit.groupBy(*by, "_qi").agg(F.max(F.when(F.col("_which") == 0, F.col("_v"))).alias("_a"),
                                       F.max(F.when(F.col("_which") == 1, F.col("_v"))).alias("_b"),
                                       F.first("_frac").alias("_f"))
    q = pair.select(*by, "_qi", (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_f")).alias("_q"))
    return q.groupBy(*by).pivot("_qi", list(range(len(probs)))).agg(F.first("_q")) \
        .select(*by, *[F.col(str(i)).alias(f"q{i}") for i in range(len(probs))])


def quantile_scalars(df, columns: Sequence[str], probs: Sequence[float]):
    """Global exact quantiles of several columns as ONE scalar struct ``s[col][i]``.

    The columns are stacked into (column, value) rows and go through ``grouped_quantiles``
    together (one distributed order-statistics pass, grouped by column name), so no task
    ever holds a whole column; the few result numbers are attached as a scalar subquery.
    """
    from pyspark.sql import functions as F
    cols = list(columns)
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_v"))
                                         for c in cols])).alias("_s")).select("_s._col", "_s._v")
    q = grouped_quantiles(long, "_v", probs, ["_col"])
    arr = F.array(*[F.col(f"q{j}") for j in range(len(probs))])
    wide = q.groupBy().pivot("_col", cols).agg(F.first(arr))
    return wide.select(F.struct(*[F.col(c) for c in cols])).scalar()
