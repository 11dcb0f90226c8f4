"""Joins (JN-1..10).

Equi-joins are left to the planner: AQE converts a side to a broadcast at run
time when its *measured* size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``
and splits skewed partitions of sort-merge joins.  An explicit ``broadcast``
hint is only used for sides of a fixed, known size (dimension tables of bounded
cardinality, one-row results) — see ``bounded_broadcast``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions import scalar as S
from panelforge.operators.ordered import earlier, ranges

# Upper bound of rows for which an explicit broadcast hint is allowed.
BROADCAST_MAX_ROWS = 1_000_000


def bounded_broadcast(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint for a side whose row count is checked against ``max_rows``.

    The count is one cheap job on the (small) side; above the bound the frame is
    returned unhinted and the planner picks a shuffle join.
    """
    n = small.limit(max_rows + 1).count()
    return F.broadcast(small) if n <= max_rows else small


def inner_on_keys(a: DataFrame, b: DataFrame, keys: Sequence[str], drop_from_b: Sequence[str] = ()) -> DataFrame:
    """JN-1: inner equi-join; overlapping non-key columns of ``b`` dropped first."""
    b = b.drop(*[c for c in drop_from_b if c in b.columns])
    overlap = [c for c in b.columns if c in a.columns and c not in keys]
    return a.join(b.drop(*overlap), list(keys), "inner")


def left_on_normalised(a: DataFrame, a_key: str, b: DataFrame, b_key: str) -> DataFrame:
    """JN-2: left join on trim/lower of the keys."""
    bk = b.withColumn("_nk", S.norm_key(b_key)).drop(b_key)
    return a.withColumn("_nk", S.norm_key(a_key)).join(bk, "_nk", "left").drop("_nk")


def lookup(a: DataFrame, key: str, dim: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """JN-3: key → label lookup, unmatched rows dropped; the dimension is broadcast if its size allows."""
    return a.join(bounded_broadcast(dim, max_rows), key, "inner")


def semi(a: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JN-4: keep rows whose key is in a computed set."""
    return a.join(keys_df.select(*keys), list(keys), "left_semi")


def anti(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JN-5 / SET-2: rows of ``a`` whose key is not in ``b``."""
    return a.join(b.select(*keys), list(keys), "left_anti")


def align_both(a: DataFrame, b: DataFrame, key: str, names: tuple[str, str]) -> DataFrame:
    """JN-6: two keyed series aligned by key, keys present in both (full join + drop NULL)."""
    (ca, cb) = names
    return a.join(b, key, "full_outer").dropna(subset=[ca, cb])


def nearest_match(treated: DataFrame, control: DataFrame, id_col: str, score: str,
                  n_ranges: int | None = None) -> DataFrame:
    """JN-7: each treated row → the control with the smallest |Δ score| (with replacement).

    No pairs are formed: both sides are unioned and dealt to ranges of the score that hold
    about equally many rows, however skewed the scores are.  The nearest control below and
    above a treated row is the last and the next control of its range or, past the border,
    of the ranges before and after (a scan over one row per range).  Ties in |Δ| go to the
    smaller control id, equal scores to the smallest.  Without a score or a control there is no match.
    """
    ctrl = (control.filter(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("_s"))
            .agg(F.min(id_col).alias("_cid")))
    ids = ctrl.schema["_cid"].dataType
    none = F.lit(None).cast("struct<s:double,id:" + ids.simpleString() + ">")
    t = treated.select(F.col(score).cast("double").alias("_s"), F.lit(1).alias("_side"), F.col(id_col).alias("_tid"),
                       none.alias("_c"))
    u = t.unionByName(ctrl.select("_s", F.lit(0).alias("_side"), F.lit(None).cast(t.schema["_tid"].dataType).alias("_tid"),
                                  F.struct(F.col("_s").alias("s"), F.col("_cid").alias("id")).alias("_c")))
    order = ["_s", "_side", "_tid"]
    ranged = ranges(u, [], order, n_ranges)
    ends = ranged.groupBy("_range").agg(F.max("_c").alias("_hi"), F.min("_c").alias("_lo"))
    after = Window.orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select("_range", F.last("_hi", True).over(earlier([])).alias("_before"),
                        F.last("_lo", True).over(after).alias("_after"))
    upto = (Window.unboundedPreceding, Window.currentRow)
    inside = Window.partitionBy("_range")
    below = F.last("_c", True).over(inside.orderBy(*order).rowsBetween(*upto))
    above = F.last("_c", True).over(inside.orderBy(*[F.col(c).desc() for c in order]).rowsBetween(*upto))
    near = (ranged.withColumns({"_b": below, "_a": above}).filter(F.col("_side") == 1)
            .join(F.broadcast(carry), "_range")  # one row per range
            .withColumns({"_b": F.coalesce("_b", "_before"), "_a": F.coalesce("_a", "_after")}))
    db, da = F.abs(F.col("_s") - F.col("_b.s")), F.abs(F.col("_a.s") - F.col("_s"))
    pick_b = F.col("_b").isNotNull() & (F.col("_a").isNull() | (db < da) | ((db == da) & (F.col("_b.id") <= F.col("_a.id"))))
    best = F.when(F.col("_s").isNotNull(), F.when(pick_b, F.col("_b")).otherwise(F.col("_a")))
    return near.select(F.col("_tid").alias(f"treated_{id_col}"), F.col("_s").alias("treated_score"),
                       best["id"].alias(f"control_{id_col}"), best["s"].alias("control_score"),
                       F.abs(F.col("_s") - best["s"]).alias("score_diff"))


def group_pairs(stats: DataFrame, group: str) -> DataFrame:
    """JN-8: all group pairs g1 < g2 over a per-group statistics table (one row per group)."""
    a = stats.select(*[F.col(c).alias(f"{c}_1") for c in stats.columns])
    b = stats.select(*[F.col(c).alias(f"{c}_2") for c in stats.columns])
    return a.join(b, F.col(f"{group}_1") < F.col(f"{group}_2"))


def align_predictions(actual: DataFrame, predicted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JN-10: left join of the actual rows with predictions on (key, period)."""
    return actual.join(predicted, list(keys), "left")
