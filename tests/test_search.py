"""Cross-validated search in one pool, Levene without dealing rows by group, medians of many columns at once."""

import numpy as np
import pytest


def test_search_equals_the_cross_validator_and_nests_rounds(spark, monkeypatch):
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import GBTRegressor
    from pyspark.ml.tuning import CrossValidator
    from panelforge.operators import ml
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 2))
    rows = [(float(a), float(b), float(a * 2 + b * b + e), i % 2) for i, ((a, b), e) in enumerate(zip(x, rng.normal(scale=.1, size=60)))]
    df = spark.createDataFrame(rows, "a double, b double, y double, fold int").coalesce(1).checkpoint()
    grid = ml.grid({"maxIter": [2, 4], "maxDepth": [2], "subsamplingRate": [0.8, 1.0]})
    fits = []
    own = GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, *a, **k: fits.append(1) or own(self, *a, **k))
    got = [(r.cv_r2, r.cv_r2_std) for r in ml.search(df, ["a", "b"], "y", "gbt", grid).orderBy("trial").collect()]
    assert len(fits) == 4  # 2 folds of 2 maps; the shorter boosting is part of the longer
    est = ml.estimator("gbt", "y", {}, 42)
    cv = CrossValidator(estimator=est, estimatorParamMaps=[{est.getParam(k): v for k, v in g.items()} for g in grid], foldCol="fold",
                        numFolds=2, evaluator=RegressionEvaluator(labelCol="y", metricName="r2"), seed=42)
    model = cv.fit(ml.assemble(df, ["a", "b"]).select("features", "y", "fold"))
    np.testing.assert_allclose([g[0] for g in got], model.avgMetrics, rtol=1e-9)
    np.testing.assert_allclose([g[1] for g in got], model.stdMetrics, rtol=1e-7)


def test_levene_sends_medians_to_the_rows(spark):
    from panelforge.operators import stats
    rng = np.random.default_rng(2)
    v = rng.normal(size=300)
    g = ["a" if i % 10 else "b" for i in range(300)]
    df = spark.createDataFrame([(k, float(x)) for k, x in zip(g, v)], "g string, v double").checkpoint()
    out = stats.levene(df, "g", "v")
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    by = {k: v[[x == k for x in g]] for k in "ab"}
    z = {k: np.abs(x - np.median(x)) for k, x in by.items()}
    every = np.concatenate([*z.values()])
    ssb = sum(len(x) * (x.mean() - every.mean()) ** 2 for x in z.values())
    ssw = sum(((x - x.mean()) ** 2).sum() for x in z.values())
    assert out.first()["f_stat"] == pytest.approx(ssb / (ssw / 298))


def test_medians_of_many_columns_take_one_pass(spark, monkeypatch):
    from panelforge.operators import missing
    rows = [(1, 1.0, None), (1, None, 2.0), (1, 5.0, 4.0), (2, None, None), (None, None, 3.0)]
    df = spark.createDataFrame(rows, "k int, a double, b double")
    passes = []
    own = missing.grouped_quantiles
    monkeypatch.setattr(missing, "grouped_quantiles", lambda *a: passes.append(1) or own(*a))
    got = {tuple(r) for r in missing.fill_key_median(df, ["k"], ["a", "b"]).collect()}
    assert got == {(1, 1.0, 3.0), (1, 3.0, 2.0), (1, 5.0, 4.0), (2, None, None), (None, None, 3.0)} and len(passes) == 1
