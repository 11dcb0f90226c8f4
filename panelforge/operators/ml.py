"""Model training, tuning and evaluation (ML-1..21) on Spark ML.

Splits and folds are a hash of the key (stable across partitionings and reruns),
not a driver-side shuffle.  Fits are Spark ML estimators; the driver only sees
fitted parameters and metric rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.operators.features import one_hot
from panelforge.operators.filters import numeric_columns
from panelforge.session import at_once

FEATURES = "features"


# ------------------------------------------------------------------ preparation and splits
def prepare_features(df: DataFrame, target: str, ids: Sequence[str], categorical: str | None = None,
                     drop_suffix: str = "_scaled", drop_first: bool = True,
                     exclude_substrings: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """ML-1: numeric features minus the target (and its scaled twin), ids and ``*_scaled`` columns;
    one-hot of a categorical (first level dropped)."""
    if categorical:
        before = set(df.columns)
        df = one_hot(df, categorical, categorical, drop_first=drop_first)
        dummies = [c for c in df.columns if c not in before]
    else:
        dummies = []
    drop = {target, f"{target}{drop_suffix}", *ids}
    feats = [c for c in numeric_columns(df) if c not in drop and not c.endswith(drop_suffix)
             and not any(s in c for s in exclude_substrings) and c not in dummies]
    return df, feats + dummies


def hash_split(df: DataFrame, keys: Sequence[str], train_frac: float = 0.8, seed: int = 42,
               name: str = "split") -> DataFrame:
    """ML-2: deterministic row split from a hash of the key columns."""
    u = (F.abs(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])) % 1_000_000) / 1_000_000.0
    return df.withColumn(name, F.when(u < train_frac, "train").otherwise("test"))


def time_split(df: DataFrame, period: str, test_from, name: str = "split") -> DataFrame:
    """ML-3: train before ``test_from``, test from it on."""
    return df.withColumn(name, F.when(F.col(period) < F.lit(test_from), "train").otherwise("test"))


def hash_folds(df: DataFrame, keys: Sequence[str], k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """ML-4: fold id 0..k−1 from a hash of the key (the CV fold column)."""
    return df.withColumn(name, (F.abs(F.xxhash64(F.lit(seed + 1), *[F.col(c) for c in keys])) % k).cast("int"))


def assemble(df: DataFrame, features: Sequence[str], out: str = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="skip").transform(df)


# ------------------------------------------------------------------ estimators
def estimator(kind: str, label: str, params: Mapping | None = None, seed: int = 42, n_rows: int | None = None,
              label_std: float | None = None):
    """ML-5..8: 'linear' (scaler → OLS), 'ridge', 'lasso', 'rf', 'gbt'.

    Penalties follow the reference's library: ridge α → regParam = α·σ_y/n, lasso α → regParam = α,
    both with ``standardization=False`` after an explicit scaler.
    """
    p = dict(params or {})
    if kind in ("linear", "ridge", "lasso"):
        alpha = p.pop("alpha", 1.0 if kind == "ridge" else 10.0)
        if kind == "linear":
            reg, en = 0.0, 0.0
        elif kind == "ridge":
            reg, en = alpha * (label_std or 1.0) / max(n_rows or 1, 1), 0.0
        else:
            reg, en = alpha, 1.0
        scaler = StandardScaler(inputCol=FEATURES, outputCol="_scaled_features", withMean=True, withStd=True)
        lr = LinearRegression(featuresCol="_scaled_features", labelCol=label, regParam=reg, elasticNetParam=en,
                              standardization=False, maxIter=1000, tol=1e-9)
        return Pipeline(stages=[scaler, lr])
    if kind == "rf":
        return RandomForestRegressor(featuresCol=FEATURES, labelCol=label, seed=seed,
                                     numTrees=p.get("numTrees", 200), maxDepth=p.get("maxDepth", 8),
                                     minInstancesPerNode=p.get("minInstancesPerNode", 1),
                                     featureSubsetStrategy=str(p.get("featureSubsetStrategy", "onethird")))
    if kind == "gbt":
        return GBTRegressor(featuresCol=FEATURES, labelCol=label, seed=seed, maxIter=p.get("maxIter", 200),
                            maxDepth=p.get("maxDepth", 4), stepSize=p.get("stepSize", 0.05),
                            subsamplingRate=p.get("subsamplingRate", 0.8))
    raise ValueError(kind)


# ------------------------------------------------------------------ metrics
def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """ML-10: RMSE, MAE, R², MAPE (zero actuals excluded) and n — one aggregate."""
    y, p = F.col(label), F.col(prediction)
    err = y - p
    aggs = [F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"),
            (1 - F.try_divide(F.sum(err * err), F.sum(y * y) - F.pow(F.sum(y), 2) / F.count(y))).alias("r2"),
            (F.avg(F.abs(F.try_divide(err, F.nullif(y, F.lit(0))))) * 100).alias("mape"), F.count(y).alias("n")]
    data = df.filter(y.isNotNull() & p.isNotNull())
    return data.groupBy(*by).agg(*aggs) if by else data.agg(*aggs)


def fit_evaluate(df: DataFrame, features: Sequence[str], label: str, kind: str, params: Mapping | None = None,
                 split: str = "split", fold: str = "fold", n_folds: int = 5, seed: int = 42) -> DataFrame:
    """ML-4/10/11/12: CV R² mean/std on the train part, test metrics and train R² for one model (one row)."""
    data = assemble(df, features).select(FEATURES, label, split, fold)
    train = data.filter(F.col(split) == "train")
    stats = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("sd")).first()
    est = lambda: estimator(kind, label, params, seed, stats["n"], stats["sd"])
    def fold_r2(f: int) -> list:
        tr, va = train.filter(F.col(fold) != f), train.filter(F.col(fold) == f)
        return [] if va.limit(1).count() == 0 else [regression_metrics(est().fit(tr).transform(va), label).first()["r2"]]

    def whole():
        model = est().fit(train)
        return (regression_metrics(model.transform(data.filter(F.col(split) == "test")), label).first(),
                regression_metrics(model.transform(train), label).first()["r2"])

    (test, train_r2), *folds = at_once(df.sparkSession, [whole, *[lambda f=f: fold_r2(f) for f in range(n_folds)]])
    cv_r2 = [r2 for own in folds for r2 in own]
    arr = np.array([v for v in cv_r2 if v is not None], dtype=float)
    row = (kind, float(arr.mean()) if arr.size else None, float(arr.std(ddof=1)) if arr.size > 1 else None,
           test["rmse"], test["mae"], test["r2"], train_r2)
    return df.sparkSession.createDataFrame([row], "model string, cv_r2_mean double, cv_r2_std double, "
                                                  "test_rmse double, test_mae double, test_r2 double, train_r2 double")


def leaderboard(rows: Sequence[DataFrame], sort_by: str = "test_r2") -> DataFrame:
    """ML-11/12/20: models sorted by a metric, best flagged, overfit gap (train R² − CV R²)."""
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    best = out.select(F.max(sort_by)).scalar()
    return (out.withColumns({"overfit_gap": F.col("train_r2") - F.col("cv_r2_mean"),
                             "is_best": F.col(sort_by) == best})
            .orderBy(F.col(sort_by).desc_nulls_last()))


def stacking(df: DataFrame, features: Sequence[str], label: str, base: Sequence[tuple[str, Mapping]],
             fold: str = "fold", split: str = "split", n_folds: int = 5, meta_alpha: float = 1.0,
             seed: int = 42) -> DataFrame:
    """ML-9: out-of-fold predictions of the base models → ridge meta-learner; test metrics (one row)."""
    from panelforge.session import materialize
    data = assemble(df, features).select(FEATURES, label, split, fold)
    # stable row ids (checkpointed) so the base models' out-of-fold predictions line up
    train = materialize(data.filter(F.col(split) == "train").withColumn("_rid", F.monotonically_increasing_id()))
    test = data.filter(F.col(split) == "test")
    n = train.count()
    sd = train.select(F.stddev_pop(label)).first()[0]
    oof = train.select("_rid", label)
    test_preds = test
    for i, (kind, params) in enumerate(base):
        parts = None
        for f in range(n_folds):
            tr, va = train.filter(F.col(fold) != f), train.filter(F.col(fold) == f)
            m = estimator(kind, label, params, seed, n, sd).fit(tr)
            p = m.transform(va).select("_rid", F.col("prediction").alias(f"p{i}"))
            parts = p if parts is None else parts.unionByName(p)
        oof = oof.join(parts, "_rid")
        full = estimator(kind, label, params, seed, n, sd).fit(train)
        test_preds = full.transform(test_preds).withColumnRenamed("prediction", f"p{i}")
        test_preds = test_preds.drop(*[c for c in test_preds.columns if c.startswith("_scaled")])
    cols = [f"p{i}" for i in range(len(base))]
    meta_in = VectorAssembler(inputCols=cols, outputCol="_meta").transform(oof)
    meta = LinearRegression(featuresCol="_meta", labelCol=label, regParam=meta_alpha * (sd or 1) / max(n, 1),
                            elasticNetParam=0.0, standardization=False).fit(meta_in)
    scored = meta.transform(VectorAssembler(inputCols=cols, outputCol="_meta").transform(test_preds))
    return regression_metrics(scored, label).withColumn("model", F.lit("stacking"))


def feature_importance(model, names: Sequence[str], top: int = 12) -> list[tuple[str, float]]:
    """ML-13: impurity importance of a tree ensemble, top k (name, value) pairs."""
    imp = model.featureImportances.toArray()
    pairs = sorted(zip(names, imp), key=lambda t: (-t[1], t[0]))
    return [(n, float(v)) for n, v in pairs[:top]]


def learning_curve(df: DataFrame, features: Sequence[str], label: str, kind: str, params: Mapping | None,
                   fractions: Sequence[float], keys: Sequence[str], fold: str = "fold", seed: int = 42) -> DataFrame:
    """ML-14: train/validation R² at growing training fractions (hash-bucket subsets, fold 0 validates)."""
    data = assemble(df, features)
    u = (F.abs(F.xxhash64(F.lit(seed + 7), *[F.col(k) for k in keys])) % 1_000_000) / 1_000_000.0
    data = data.withColumn("_u", u)
    val = data.filter(F.col(fold) == 0)
    rows = []
    for frac in fractions:
        tr = data.filter((F.col(fold) != 0) & (F.col("_u") < frac))
        n = tr.count()
        if n < 3:
            continue
        sd = tr.select(F.stddev_pop(label)).first()[0]
        m = estimator(kind, label, params, seed, n, sd).fit(tr)
        rows.append((float(frac), int(n), regression_metrics(m.transform(tr), label).first()["r2"],
                     regression_metrics(m.transform(val), label).first()["r2"]))
    return df.sparkSession.createDataFrame(rows, "fraction double, n_train long, train_r2 double, val_r2 double")


def search(df: DataFrame, features: Sequence[str], label: str, kind: str, grid: Sequence[Mapping],
           fold: str = "fold", parallelism: int = 16, seed: int = 42) -> DataFrame:
    """ML-15/16/17/18: cross-validated search over parameter maps
    (shared fold column → identical folds for every strategy).  Rows: trial, params, cv_r2, cv_r2_std.

    The fits of all folds and maps run ``parallelism`` at a time.  Boosted trees that differ in their
    number of rounds only are one fit: the shorter ones are its first rounds.
    """
    data = assemble(df, features).select(FEATURES, label, fold)
    est = estimator(kind, label, {}, seed)
    stage = est.getStages()[-1] if isinstance(est, Pipeline) else est
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="r2")
    n_folds = int(data.select(F.max(fold)).first()[0]) + 1
    alike: dict[tuple, list[int]] = {}
    for i, g in enumerate(grid):
        own = tuple(sorted((k, str(v)) for k, v in g.items() if k != "maxIter")) if kind == "gbt" and "maxIter" in g else (i,)
        alike.setdefault(own, []).append(i)
    folds = []
    for f in range(n_folds):
        tr, va = data.filter(F.col(fold) != f).persist(), data.filter(F.col(fold) == f).persist()
        n, spread = va.agg(F.count(label), F.var_samp(label)).first()
        if not n or not tr.limit(1).count():
            raise ValueError(f"fold {f} has no rows to {'test' if not n else 'train'} on")
        folds.append((tr, va, n, spread))

    def scores(f: int, places: Sequence[int]) -> list[tuple[int, int, float]]:
        tr, va, n, spread = folds[f]
        longest = max(places, key=lambda i: grid[i].get("maxIter", 0))
        model = est.fit(tr, {stage.getParam(k): v for k, v in grid[longest].items()})
        if len(places) == 1:
            return [(f, longest, ev.evaluate(model.transform(va)))]
        mse = model.evaluateEachIteration(va, "squared")
        with np.errstate(all="ignore"):
            return [(f, i, float(1 - np.float64(mse[grid[i]["maxIter"] - 1]) * n / (np.float64(spread or 0.0) * (n - 1)))) for i in places]

    r2 = np.zeros((n_folds, len(grid)))
    for own in at_once(df.sparkSession, [lambda f=f, at=at: scores(f, at) for at in alike.values() for f in range(n_folds)], parallelism):
        for f, i, v in own:
            r2[f, i] = v
    for tr, va, _, _ in folds:
        tr.unpersist()
        va.unpersist()
    rows = [(i, ";".join(f"{k}={v}" for k, v in sorted(g.items())), float(m), float(s))
            for i, (g, m, s) in enumerate(zip(grid, r2.mean(axis=0), r2.std(axis=0)))]
    return df.sparkSession.createDataFrame(rows, "trial int, params string, cv_r2 double, cv_r2_std double")


def grid(space: Mapping[str, Sequence]) -> list[dict]:
    """ML-15: full grid of a parameter space."""
    out = [{}]
    for k, vs in space.items():
        out = [{**o, k: v} for o in out for v in vs]
    return out


def random_maps(space: Mapping[str, Callable[[np.random.Generator], object]], n: int, seed: int = 42) -> list[dict]:
    """ML-16/17: ``n`` seeded draws from a parameter space (callables over a numpy Generator)."""
    rng = np.random.default_rng(seed)
    return [{k: f(rng) for k, f in space.items()} for _ in range(n)]


def history(trials: DataFrame) -> DataFrame:
    """ML-18: score per trial and best so far (running max)."""
    from panelforge.operators.windows import running_best
    return running_best(trials, "trial", "cv_r2")


def best_trial(trials: DataFrame) -> DataFrame:
    """(params, cv_r2) of the trial with the highest score, ties to the first one."""
    return trials.agg(F.max_by("params", F.struct("cv_r2", -F.col("trial"))).alias("params"), F.max("cv_r2").alias("cv_r2"))


def best_parameters(searches: Mapping[str, DataFrame]) -> DataFrame:
    """ML-19: one row per parameter, one column per search strategy with its best trial's value; null where it has none."""
    rows = None
    for name, trials in searches.items():
        pairs = F.explode(F.split("params", ";")).alias("pair")
        own = best_trial(trials).select(F.lit(name).alias("strategy"), pairs).where("pair <> ''")
        rows = own if rows is None else rows.unionByName(own)
    split = F.split("pair", "=", 2)
    return (rows.select("strategy", split[0].alias("parameter"), split[1].alias("value"))
            .groupBy("parameter").pivot("strategy", list(searches)).agg(F.first("value")))


def parameters(params: str) -> dict:
    """A trial's parameter text as values."""
    def value(v: str):
        for kind in (int, float):
            try:
                return kind(v)
            except ValueError:
                pass
        return v
    return {k: value(v) for k, v in (pair.split("=", 1) for pair in params.split(";") if pair)}


def choose_strategy(evaluated: DataFrame, score: str = "cv_r2_mean") -> DataFrame:
    """ML-20: rows (family, strategy, scores) flagged best within their family; ties to the first strategy by name."""
    best = evaluated.groupBy(F.col("family").alias("_f")).agg(
        F.min_by("strategy", F.struct(-F.coalesce(F.col(score), F.lit(float("-inf"))), F.col("strategy"))).alias("_best"))
    return (evaluated.join(F.broadcast(best), F.col("family") == F.col("_f"))  # one row a model family
            .withColumn("chosen", F.col("strategy") == F.col("_best")).drop("_f", "_best"))


def final_leaderboard(evaluated: DataFrame, score: str = "cv_r2_mean") -> DataFrame:
    """ML-20: the baseline and the chosen strategy of every family, best score first, with the gap between train and CV R²."""
    rows = choose_strategy(evaluated, score).where(F.col("chosen") | (F.col("strategy") == "baseline"))
    return rows.withColumn("overfit_gap", F.col("train_r2") - F.col("cv_r2_mean")).orderBy(
        F.col(score).desc_nulls_last(), "family", "strategy")


def score_or_rule(df: DataFrame, model, features: Sequence[str], fallback: Column) -> DataFrame:
    """ML-21: batch scoring with the model when given, else the rule-based score (PRJ-14)."""
    if model is None:
        return df.withColumn("prediction", fallback).withColumn("model_used", F.lit("rule"))
    scored = model.transform(assemble(df, features)).drop(FEATURES)
    return scored.withColumn("model_used", F.lit("model"))


def residual_frame(scored: DataFrame, label: str, ids: Sequence[str]) -> DataFrame:
    return scored.select(*ids, F.col(label).alias("actual"), F.col("prediction").alias("predicted"),
                         (F.col(label) - F.col("prediction")).alias("residual"))

