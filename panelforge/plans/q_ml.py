"""Registered queries: model training, tuning and explanation on the feature panel.

Model sizes in these registered runs are kept moderate so the whole registry runs
in minutes (tree counts and boosting rounds are parameters of the operators; the
reference defaults live in ``operators.ml.estimator``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions import scalar as S
from panelforge.operators import explain as X
from panelforge.operators import ml as M
from panelforge.operators.features import engineer_features_g2
from panelforge.operators.missing import fill_key_median
from panelforge.plans.q_features import G2_ROLES, proxied_panel
from panelforge.plans.registry import query
from panelforge.session import at_once, materialize
from panelforge.sources.panel import panel, with_panel

TARGET = "entity_growth_yoy"
IDS = ["k", "yr"]
RF = {"numTrees": 300, "maxDepth": 6}
GBT = {"maxIter": 30, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.8}


def ml_frame(spark, sf_dir):
    """Feature panel with the target filled per key, split and fold columns (materialized once)."""
    # the features read the panel many times (extremes, medians, levels); it is made once
    p = materialize(engineer_features_g2(materialize(proxied_panel(spark, sf_dir)), G2_ROLES, "k", "yr"))
    p = fill_key_median(p, ["k"], [TARGET, "funding_growth_yoy", "startup_momentum", "funding_momentum"])
    p, feats = M.prepare_features(p, TARGET, IDS, categorical="period", exclude_substrings=["nation"])
    p = M.hash_folds(M.hash_split(p, IDS), IDS)
    p = p.na.fill(0.0, subset=feats).repartition(IDS[0]).sortWithinPartitions(*IDS)  # bagging draws by place: one order of the rows
    return materialize(p.select(*IDS, "nation", TARGET, *feats, "split", "fold")), feats


_ML1_FEATS = ["entity_count", "funding", "deals", "big_deals", "volume", "disc", "tax", "price", "is_partial",
              "density", "intensity", "big_rate", "funding_growth_yoy", "is_during", "is_post"]


@query("ml1_prepare_features", "ML-1,ENC-2,FLT-4", with_panel(
    "SELECT k, yr, " + ", ".join(_ML1_FEATS)
    + ", CAST(period = 'post' AS INTEGER) AS period_post, CAST(period = 'pre' AS INTEGER) AS period_pre FROM panel"))
def q_ml1(spark, sf_dir):
    df, feats = M.prepare_features(panel(spark, sf_dir), TARGET, IDS, categorical="period",
                                   exclude_substrings=["nation"])
    return df.select(*IDS, *feats)


@query("ml2_hash_split", "ML-2")
def q_ml2(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return M.hash_split(o, ["o_orderkey"]).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("ml3_time_split", "ML-3", with_panel(
    "SELECT k, yr, CASE WHEN yr < 2000 THEN 'train' ELSE 'test' END AS split FROM panel"))
def q_ml3(spark, sf_dir):
    return M.time_split(panel(spark, sf_dir), "yr", 2000).select("k", "yr", "split")


@query("ml10_metrics", "ML-10,JN-10", with_panel("""
WITH p AS (SELECT funding AS y, lag(funding) OVER (PARTITION BY k ORDER BY yr) AS yhat FROM panel)
SELECT sqrt(avg((y - yhat) ** 2)) AS rmse, avg(abs(y - yhat)) AS mae,
       1 - sum((y - yhat) ** 2) / (sum(y * y) - sum(y) ** 2 / count(y)) AS r2,
       avg(abs((y - yhat) / nullif(y, 0))) * 100 AS mape, count(y) AS n
FROM p WHERE y IS NOT NULL AND yhat IS NOT NULL"""))
def q_ml10(spark, sf_dir):
    from pyspark.sql import Window
    p = panel(spark, sf_dir)
    pred = p.withColumn("prediction", F.lag("funding").over(Window.partitionBy("k").orderBy("yr")))
    return M.regression_metrics(pred, "funding")


@query("ml4_cross_validation", "ML-4,ML-5,ML-10")
def q_ml4(spark, sf_dir):
    df, feats = ml_frame(spark, sf_dir)
    return M.fit_evaluate(df, feats, TARGET, "linear")


@query("ml11_leaderboard", "ML-5,ML-6,ML-7,ML-8,ML-11,ML-12,ML-20")
def q_ml11(spark, sf_dir):
    df, feats = ml_frame(spark, sf_dir)
    rows = [M.fit_evaluate(df, feats, TARGET, "linear"), M.fit_evaluate(df, feats, TARGET, "ridge", {"alpha": 1.0}),
            M.fit_evaluate(df, feats, TARGET, "lasso", {"alpha": 10.0}), M.fit_evaluate(df, feats, TARGET, "rf", RF),
            M.fit_evaluate(df, feats, TARGET, "gbt", GBT)]
    return M.leaderboard(rows, "cv_r2_mean")


@query("ml9_stacking", "ML-9")
def q_ml9(spark, sf_dir):
    df, feats = ml_frame(spark, sf_dir)
    return M.stacking(df, feats, TARGET, [("linear", {}), ("rf", RF), ("gbt", GBT)])


def _rf_model(spark, sf_dir):
    df, feats = ml_frame(spark, sf_dir)
    train = M.assemble(df.filter(F.col("split") == "train"), feats)
    model = M.estimator("rf", TARGET, RF).fit(train)
    return df, feats, model


@query("ml13_feature_importance", "ML-13")
def q_ml13(spark, sf_dir):
    df, feats, model = _rf_model(spark, sf_dir)
    return spark.createDataFrame(M.feature_importance(model, feats, 12), "feature string, importance double")


@query("ml14_learning_curve", "ML-14")
def q_ml14(spark, sf_dir):
    df, feats = ml_frame(spark, sf_dir)
    return M.learning_curve(df, feats, TARGET, "rf", RF, [0.2, 0.4, 0.6, 0.8, 1.0], IDS)


GBT_GRID = {"maxIter": [10, 20], "maxDepth": [3, 4, 5], "stepSize": [0.05, 0.1], "subsamplingRate": [0.8, 1.0]}
GBT_SPACE = {"maxIter": lambda r: int(r.integers(10, 31)), "maxDepth": lambda r: int(r.integers(2, 7)),
             "stepSize": lambda r: round(float(r.uniform(0.01, 0.26)), 4),
             "subsamplingRate": lambda r: round(float(r.uniform(0.6, 1.0)), 4),
             "minInstancesPerNode": lambda r: int(r.integers(1, 9))}
RF_SPACE = {"numTrees": lambda r: int(r.integers(20, 80)), "maxDepth": lambda r: int(r.integers(3, 9)),
            "minInstancesPerNode": lambda r: int(r.integers(1, 6)),
            "featureSubsetStrategy": lambda r: str(r.choice(["sqrt", "onethird", "0.5", "all"]))}
DRAWS = 12


def _grid_trials(df, feats):
    return M.search(df.filter(F.col("split") == "train"), feats, TARGET, "gbt", M.grid(GBT_GRID))


def _random_trials(df, feats, kind, space):
    return M.search(df.filter(F.col("split") == "train"), feats, TARGET, kind, M.random_maps(space, DRAWS))


@query("ml15_grid_search", "ML-15,ML-18,WIN-10")
def q_ml15(spark, sf_dir):
    return M.history(_grid_trials(*ml_frame(spark, sf_dir)))


@query("ml16_random_search", "ML-16,ML-17,ML-18")
def q_ml16(spark, sf_dir):
    return M.history(_random_trials(*ml_frame(spark, sf_dir), "rf", RF_SPACE))


@query("ml16_random_search_boosted", "ML-16,ML-18")
def q_ml16b(spark, sf_dir):
    return M.history(_random_trials(*ml_frame(spark, sf_dir), "gbt", GBT_SPACE))


@query("ml19_best_parameters", "ML-19")
def q_ml19(spark, sf_dir):
    """The best parameters of the boosted trees by search strategy."""
    df, feats = ml_frame(spark, sf_dir)
    grid, random = at_once(spark, [lambda: _grid_trials(df, feats), lambda: _random_trials(df, feats, "gbt", GBT_SPACE)])
    return M.best_parameters({"grid": grid, "random": random})


@query("ml20_final_leaderboard", "ML-20")
def q_ml20(spark, sf_dir):
    """Baselines and the chosen search strategy of boosted trees and forests."""
    df, feats = ml_frame(spark, sf_dir)

    def evaluated(kind, name, params):
        return M.fit_evaluate(df, feats, TARGET, kind, params).withColumn("family", F.lit(kind)).withColumn("strategy", F.lit(name))

    def searched(kind, name, trials):
        return evaluated(kind, name, M.parameters(M.best_trial(trials()).first()["params"]))

    plans = at_once(spark, [  # in the order of the rows
        lambda: evaluated("gbt", "baseline", GBT), lambda: evaluated("rf", "baseline", RF),
        lambda: searched("gbt", "grid", lambda: _grid_trials(df, feats)),
        lambda: searched("gbt", "random", lambda: _random_trials(df, feats, "gbt", GBT_SPACE)),
        lambda: searched("rf", "random", lambda: _random_trials(df, feats, "rf", RF_SPACE))])
    rows = reduce(DataFrame.unionByName, plans)
    return M.final_leaderboard(rows.drop("model"))


@query("ml21_batch_scoring", "ML-21,PRJ-14")
def q_ml21(spark, sf_dir):
    df, feats, model = _rf_model(spark, sf_dir)
    scored = M.score_or_rule(df, model, feats, S.rule_score("disc", "price", "tax"))
    rule = M.score_or_rule(df, None, feats, S.rule_score(F.col("disc") * 100, F.col("price") / 1000, F.col("tax") * 100))
    res = M.residual_frame(scored, TARGET, IDS).withColumn("model_used", F.lit("model"))
    return res.unionByName(M.residual_frame(rule, TARGET, IDS).withColumn("model_used", F.lit("rule")))


# ------------------------------------------------------------------ explanation
def _attributions(spark, sf_dir):
    df, feats, model = _rf_model(spark, sf_dir)
    return df, feats, model, materialize(X.attributions(df, model, feats, IDS))


@query("xai1_tree_shap", "XAI-1")
def q_xai1(spark, sf_dir):
    return _attributions(spark, sf_dir)[3]


@query("xai2_mean_abs_shap", "XAI-2")
def q_xai2(spark, sf_dir):
    return X.mean_abs_shap(_attributions(spark, sf_dir)[3])


@query("xai3_local_explanation", "XAI-3")
def q_xai3(spark, sf_dir):
    df, feats, model, attr = _attributions(spark, sf_dir)
    keyed = attr.withColumn("row_id", F.concat_ws("-", "k", "yr"))
    target = df.withColumn("row_id", F.concat_ws("-", "k", "yr"))
    hi = X.local_explanation(keyed, target, "row_id", TARGET, 10, True).withColumn("which", F.lit("highest"))
    lo = X.local_explanation(keyed, target, "row_id", TARGET, 10, False).withColumn("which", F.lit("lowest"))
    return hi.unionByName(lo)


@query("xai4_dependence", "XAI-4")
def q_xai4(spark, sf_dir):
    attr = _attributions(spark, sf_dir)[3]
    top = [r[0] for r in X.mean_abs_shap(attr, 2).collect()]
    return X.dependence(attr, top)


@query("xai5_permutation_importance", "XAI-5")
def q_xai5(spark, sf_dir):
    df, feats, model = _rf_model(spark, sf_dir)
    return X.permutation_importance(df, model, feats, TARGET, repeats=20)


@query("xai6_partial_dependence", "XAI-6")
def q_xai6(spark, sf_dir):
    df, feats, model = _rf_model(spark, sf_dir)
    imp = M.feature_importance(model, feats, 2)
    out = None
    for f, _ in imp:
        pdp = X.partial_dependence(df, model, feats, f, 50)
        out = pdp if out is None else out.unionByName(pdp)
    return out


@query("xai7_shap_heatmap", "XAI-7,STA-16")
def q_xai7(spark, sf_dir):
    attr = _attributions(spark, sf_dir)[3].withColumn("row_id", F.concat_ws("-", "k", "yr"))
    top = [r[0] for r in X.mean_abs_shap(attr, 10).collect()]
    return X.heatmap(attr, "row_id", top, 4)


@query("snk7_model_save_load", "SNK-7,ML-21")
def q_snk7(spark, sf_dir):
    """Persist the fitted pipeline to the shared folder, load it back and score with the loaded copy."""
    from pyspark.ml import Pipeline, PipelineModel

    from panelforge.sources.sinks import new_scratch
    df, feats = ml_frame(spark, sf_dir)
    pipe = Pipeline(stages=[M.estimator("linear", TARGET)])
    model = pipe.fit(M.assemble(df.filter(F.col("split") == "train"), feats))
    path = new_scratch(spark, "model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    scored = loaded.transform(M.assemble(df, feats))
    return M.residual_frame(scored, TARGET, IDS)
