"""Model explanation (XAI-1..7).

Tree attributions are path-dependent Shapley values (Lundberg, Erion & Lee, 2018) computed
on relations, see ``attribution``.  Local accuracy holds: Σφ + expected value = prediction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.operators import attribution


def attributions(df: DataFrame, model, features: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """XAI-1: long rows (ids…, feature, value, phi) plus per-row ``expected`` and ``prediction`` of a fitted ensemble."""
    nodes, depth = attribution.model_nodes(model)
    return attribution.attributions(df, nodes, depth, features, ids)


def mean_abs_shap(attr: DataFrame, top: int | None = None) -> DataFrame:
    """XAI-2: global importance = mean |φ| per feature, descending."""
    out = attr.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi")).orderBy(
        F.col("mean_abs_phi").desc(), "feature")
    return out.limit(top) if top else out


def local_explanation(attr: DataFrame, target: DataFrame, id_col: str, y: str, top: int = 10,
                      highest: bool = True) -> DataFrame:
    """XAI-3: top-|φ| features of the row with the highest (or lowest) target."""
    pick = (F.max_by if highest else F.min_by)(id_col, y)
    row_id = target.select(pick).scalar()
    return (attr.filter(F.col(id_col) == row_id).orderBy(F.abs("phi").desc(), "feature").limit(top))


def dependence(attr: DataFrame, features: Sequence[str]) -> DataFrame:
    """XAI-4: (feature value, φ) pairs for chosen features."""
    return attr.filter(F.col("feature").isin(list(features))).select("feature", "value", "phi")


def heatmap(attr: DataFrame, id_col: str, top_features: Sequence[str], q: int = 4) -> DataFrame:
    """XAI-7: mean φ per feature by quartile of the row-mean φ over the top features."""
    from panelforge.operators.stats import qcut
    sub = attr.filter(F.col("feature").isin(list(top_features)))
    rows = sub.groupBy(id_col).agg(F.avg("phi").alias("_row_mean"))
    rows = qcut(rows, "_row_mean", q, "quartile")
    return sub.join(rows.select(id_col, "quartile"), id_col).groupBy("quartile", "feature").agg(
        F.avg("phi").alias("mean_phi"))


# ------------------------------------------------------------------ model-agnostic
def distributed_positions(df: DataFrame, order: str, name: str = "_pos") -> DataFrame:
    """1-based row positions in ``order`` without a single-task sort: range partitions are
    numbered locally and shifted by the row counts of lower partitions."""
    from pyspark.sql import Window

    from panelforge.session import materialize
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = materialize(df.repartitionByRange(n, order).withColumn("_pid", F.spark_partition_id()))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"))
    offs = counts.select("_pid", F.coalesce(F.sum("_c").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    w = Window.partitionBy("_pid").orderBy(order)
    return (ranged.withColumn("_local", F.row_number().over(w)).join(F.broadcast(offs), "_pid")
            .withColumn(name, F.col("_off") + F.col("_local")).drop("_pid", "_local", "_off"))


def numbered(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Rows numbered from 0 without gaps, written, and their number: ids within a partition plus the counts of those before."""
    from pyspark.sql import Window

    from panelforge.session import materialize
    rows = materialize(df.withColumn("_id", F.monotonically_increasing_id()))
    part, local = F.call_function("shiftright", F.col("_id"), F.lit(33)), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    counts = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))  # one row a partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = materialize(counts.select("_part", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift")))
    total = shifts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    out = (rows.withColumn("_part", part).join(shifts.drop("_n"), "_part")
           .withColumn(name, (local + F.col("_shift")).cast("long")).drop("_id", "_part", "_shift"))
    return out, int(total)


def keyed_permutation(number: Column, n: int, key: Column, rounds: int = 40) -> Column:
    """A bijection of 0..n-1 for every key, computed row by row: no sort, no window.

    Swap-or-not (Hoang, Morris & Rogaway, 2012): a round pairs x with (k - x) mod n, and a bit
    hashed from the larger of the two says for both whether they change places.
    """
    n_ = F.lit(n).cast("long")

    def step(x: Column, i: Column) -> Column:
        pair = F.pmod(F.pmod(F.xxhash64(key, i), n_) - x, n_)
        bit = F.xxhash64(key, i, F.greatest(x, pair)).bitwiseAND(F.lit(1))
        return F.when(bit == 1, pair).otherwise(x)
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), number.cast("long"), step)


def permutation_importance(df: DataFrame, model, features: Sequence[str], label: str, repeats: int = 20,
                           seed: int = 42) -> DataFrame:
    """XAI-5: R² drop when one feature is permuted; mean and std over repeats.

    Rows get gapless numbers once.  In the copy of a (feature, repeat) a row takes the
    feature's value from the row that a keyed bijection of these numbers names, so a shuffle of
    a whole column is one join on the number, dealt evenly, and no copy is sorted in one task.
    """
    from panelforge.operators.ml import assemble, regression_metrics
    from panelforge.session import materialize
    feats = list(features)
    base, n = numbered(df.select(*feats, label).dropna(), "_row")
    base = materialize(base)
    base_r2 = regression_metrics(model.transform(assemble(base, feats)), label).select("r2").scalar()
    copies = base.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(len(feats) * repeats - 1))))
    copies = (copies.withColumn("_fidx", (F.col("_copy") / repeats).cast("int"))
              .withColumn("_from", keyed_permutation(F.col("_row"), max(n, 1), F.col("_copy") + F.lit(seed) * 1_000_003)))
    source = base.select(F.col("_row").alias("_from"), F.array(*[F.col(f).cast("double") for f in feats]).alias("_values"))
    perm = copies.join(source, "_from").withColumns(
        {f: F.when(F.col("_fidx") == i, F.get("_values", F.lit(i))).otherwise(F.col(f).cast("double"))
         for i, f in enumerate(feats)})
    scored = model.transform(assemble(perm, feats))
    m = regression_metrics(scored, label, by=["_fidx", "_copy"])
    names = F.element_at(F.array(*[F.lit(f) for f in feats]), F.col("_fidx") + 1)
    return (m.groupBy(names.alias("feature"))
            .agg((base_r2 - F.avg("r2")).alias("importance_mean"), F.stddev_pop("r2").alias("importance_std"))
            .orderBy(F.col("importance_mean").desc(), "feature"))


def partial_dependence(df: DataFrame, model, features: Sequence[str], feature: str, points: int = 50) -> DataFrame:
    """XAI-6: ``points``-point grid over one feature, the others held at their mean."""
    from panelforge.operators.ml import assemble
    means = df.agg(*[F.avg(c).alias(c) for c in features],
                   F.min(feature).cast("double").alias("_lo"), F.max(feature).cast("double").alias("_hi"))
    grid = means.select(*[F.col(c) for c in features if c != feature], "_lo", "_hi",
                        F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("_i"))
    grid = grid.withColumn(feature, F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_i") / (points - 1))
    out = model.transform(assemble(grid, features))
    return out.select(F.lit(feature).alias("feature"), F.col(feature).alias("grid_value"),
                      F.col("prediction").alias("partial_dependence"))
