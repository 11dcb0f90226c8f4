"""Operator behaviour on hand-made frames (NULLs, ties, hot keys, constant columns) and identities."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F


def _pdf(df):
    return df.toPandas()


def test_ffill_bucketed_equals_plain(spark):
    from panelforge.operators.missing import ffill_bfill
    rng = np.random.default_rng(0)
    n = 400
    keys = np.where(rng.random(n) < 0.6, 0, rng.integers(1, 5, n))  # one hot key
    t = rng.permutation(n)
    v = np.where(rng.random(n) < 0.5, np.nan, rng.normal(size=n))
    v[keys == 3] = np.nan  # an all-NULL key stays NULL
    df = spark.createDataFrame(pd.DataFrame({"k": keys.astype("int64"), "t": t.astype("int64"), "v": v})) \
        .withColumn("v", F.nanvl("v", F.lit(None)))
    plain = _pdf(ffill_bfill(df, ["k"], "t", ["v"])).sort_values("t").reset_index(drop=True)
    bucketed = _pdf(ffill_bfill(df, ["k"], "t", ["v"], bucket=(F.col("t") / 37).cast("int"))) \
        .sort_values("t").reset_index(drop=True)
    pd.testing.assert_frame_equal(plain, bucketed)
    ref = pd.DataFrame({"k": keys, "t": t, "v": v}).sort_values(["k", "t"])
    ref["v"] = ref.groupby("k")["v"].transform(lambda s: s.ffill().bfill())
    got = plain.set_index("t").loc[ref.t, "v"].to_numpy()
    np.testing.assert_allclose(got, ref["v"].to_numpy(), equal_nan=True)


def test_bucketed_lag_equals_plain(spark):
    from panelforge.operators.windows import lag
    rng = np.random.default_rng(1)
    n = 300
    df = spark.createDataFrame(pd.DataFrame({"k": rng.integers(0, 3, n).astype("int64"),
                                             "t": rng.permutation(n).astype("int64"), "v": rng.normal(size=n)}))
    a = _pdf(lag(df, ["k"], "t", ["v"])).sort_values("t").reset_index(drop=True)
    b = _pdf(lag(df, ["k"], "t", ["v"], bucket=(F.col("t") / 23).cast("int"))).sort_values("t").reset_index(drop=True)
    np.testing.assert_allclose(a["v_lag1"].to_numpy(), b["v_lag1"].to_numpy(), equal_nan=True)


def test_nearest_match_equals_brute_force(spark):
    from panelforge.operators.joins import nearest_match
    rng = np.random.default_rng(2)
    t = pd.DataFrame({"id": np.arange(50, dtype="int64"), "s": np.round(rng.random(50), 2)})
    c = pd.DataFrame({"id": np.arange(100, 180, dtype="int64"), "s": np.round(rng.random(80), 2)})
    got = _pdf(nearest_match(spark.createDataFrame(t), spark.createDataFrame(c), "id", "s")).set_index("treated_id")
    for _, r in t.iterrows():
        d = (c.s - r.s).abs()
        best = c[d == d.min()].id.min()
        assert got.loc[r.id, "control_id"] == best
        assert got.loc[r.id, "score_diff"] == pytest.approx(d.min())


def test_global_average_rank_matches_pandas(spark):
    from panelforge.operators.stats import with_average_rank
    rng = np.random.default_rng(3)
    x = rng.integers(0, 30, 500).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"i": np.arange(500), "x": x}))
    got = _pdf(with_average_rank(df, "x", "r")).sort_values("i")
    np.testing.assert_allclose(got.r.to_numpy(), pd.Series(x).rank().to_numpy())


def test_kruskal_and_anova_identities(spark):
    from panelforge.operators.stats import anova_oneway, kruskal, t_statistics
    rng = np.random.default_rng(4)
    g = np.repeat(["a", "b", "c"], [40, 50, 60])
    x = np.round(rng.normal(size=150) + (g == "b") * 0.5, 1)
    df = spark.createDataFrame(pd.DataFrame({"g": g, "x": x}))
    r = pd.Series(x).rank()
    n = len(x)
    h = 12 / (n * (n + 1)) * sum(r[g == k].sum() ** 2 / (g == k).sum() for k in "abc") - 3 * (n + 1)
    ties = pd.Series(x).value_counts()
    h /= 1 - ((ties ** 3 - ties).sum()) / (n ** 3 - n)
    assert kruskal(df, "g", "x").first()["h_stat"] == pytest.approx(h, rel=1e-10)
    # two groups: F = t² (Student)
    two = df.filter(F.col("g").isin("a", "b"))
    f = anova_oneway(two, "g", "x").first()["f_stat"]
    t = t_statistics(two, "g", "x", "a", "b").first()["t_student"]
    assert f == pytest.approx(t * t, rel=1e-10)


def test_qcut_matches_pandas(spark):
    from panelforge.operators.stats import qcut
    rng = np.random.default_rng(5)
    x = rng.normal(size=101)
    df = spark.createDataFrame(pd.DataFrame({"i": np.arange(101), "x": x}))
    got = _pdf(qcut(df, "x", 4)).sort_values("i")["bin"].to_numpy()
    np.testing.assert_array_equal(got, pd.qcut(x, 4, labels=False))


def test_distribution_functions():
    from panelforge.functions import dist
    assert dist.t_sf_two_sided(2.0, 10) == pytest.approx(0.0733880347, rel=1e-6)
    assert dist.f_sf(3.0, 2, 20) == pytest.approx(0.0726, abs=5e-4)
    assert dist.chi2_sf(3.84145882, 1) == pytest.approx(0.05, rel=1e-6)
    assert dist.norm_ppf(0.975) == pytest.approx(1.959963985, rel=1e-9)
    # published critical values of the studentised range: q(.95; 3, 20) = 3.578, q(.95; 2, ∞) = 1.96·√2
    assert dist.ptukey(3.578, 3, 20) == pytest.approx(0.95, abs=1e-3)
    assert dist.ptukey(1.959964 * 2 ** 0.5, 2, float("inf")) == pytest.approx(0.95, abs=1e-4)


def test_shapiro_normal_vs_skewed(spark):
    from panelforge.operators.stats import shapiro_wilk
    rng = np.random.default_rng(6)
    df = spark.createDataFrame(pd.DataFrame({"a": rng.normal(size=300), "b": rng.exponential(size=300)}))
    wa = shapiro_wilk(df, "a").first()
    wb = shapiro_wilk(df, "b").first()
    assert 0.98 < wa["w"] <= 1.0 and wa["p_value"] > 0.01
    assert wb["w"] < 0.95 and wb["p_value"] < 1e-6


def test_tree_shap_local_accuracy(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    from panelforge.operators.explain import attributions
    rng = np.random.default_rng(7)
    X = rng.normal(size=(120, 3))
    y = X[:, 0] * 2 + (X[:, 1] > 0) * 1.5 + rng.normal(scale=0.1, size=120)
    pdf = pd.DataFrame({"i": np.arange(120), "a": X[:, 0], "b": X[:, 1], "c": X[:, 2], "y": y})
    df = spark.createDataFrame(pdf)
    data = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    model = RandomForestRegressor(labelCol="y", numTrees=10, maxDepth=4, seed=1).fit(data)
    attr = _pdf(attributions(df, model, ["a", "b", "c"], ["i"]))
    per_row = attr.groupby("i").agg(phi=("phi", "sum"), e=("expected", "first"), p=("prediction", "first"))
    np.testing.assert_allclose(per_row.phi + per_row.e, per_row.p, rtol=1e-9, atol=1e-9)
    spark_pred = model.transform(data).select("i", "prediction").toPandas().set_index("i")["prediction"]
    np.testing.assert_allclose(per_row.p.sort_index(), spark_pred.sort_index(), rtol=1e-9)


def test_silhouette_exact_matches_numpy(spark):
    from panelforge.operators.cluster import silhouette, vectors
    rng = np.random.default_rng(8)
    X = np.vstack([rng.normal(0, 1, (30, 2)), rng.normal(4, 1, (30, 2))])
    lab = np.repeat([0, 1], 30)
    df = vectors(spark.createDataFrame(pd.DataFrame({"i": np.arange(60), "x0": X[:, 0], "x1": X[:, 1], "l": lab})),
                 ["x0", "x1"])
    got = _pdf(silhouette(df, "l", id_col="i")).sort_values("i")["silhouette"].to_numpy()
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    exp = []
    for i in range(60):
        same = lab == lab[i]
        a = D[i, same].sum() / (same.sum() - 1)
        b = D[i, ~same].mean()
        exp.append((b - a) / max(a, b))
    np.testing.assert_allclose(got, exp, rtol=1e-10)


def test_event_study_equals_subset_regressions(spark):
    from panelforge.functions.linalg import ols
    from panelforge.operators.causal import event_study
    rng = np.random.default_rng(9)
    rows = [(k, y, int(k % 2), rng.normal() + (k % 2) * (y >= 3) * 2) for k in range(12) for y in range(1, 6)]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["k", "yr", "treated", "v"]))
    ev = _pdf(event_study(df, "v", "treated", "yr", 2, cov="nonrobust")).set_index("yr")
    assert ev.loc[2, "coef"] == 0.0 and ev.loc[2, "p"] == 1.0
    sub = df.filter(F.col("yr").isin(2, 4)).withColumns({"ep": (F.col("yr") == 4).cast("int")}) \
        .withColumn("ed", F.col("treated") * F.col("ep"))
    direct = _pdf(ols(sub, "v", ["treated", "ep", "ed"])).set_index("term")
    assert ev.loc[4, "coef"] == pytest.approx(direct.loc["ed", "coef"], rel=1e-9)


def test_exact_quantile_interpolation(spark):
    from panelforge.functions.quantile import quantiles
    x = np.array([1.0, 2.0, 2.0, 7.0, 10.0, 11.5])
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    got = df.select(quantiles("x", [0.1, 0.25, 0.5, 0.9])).first()[0]
    np.testing.assert_allclose(got, np.quantile(x, [0.1, 0.25, 0.5, 0.9]))


def test_cap_outliers_per_key_constant_group_unchanged(spark):
    from panelforge.operators.features import cap_outliers
    pdf = pd.DataFrame({"k": [1] * 6 + [2] * 5, "v": [1, 2, 3, 4, 5, 100, 7, 7, 7, 7, 7.0]})
    out = _pdf(cap_outliers(spark.createDataFrame(pdf), ["k"], ["v"]))
    q1, q3 = np.quantile(pdf.v[:6], [0.25, 0.75])
    assert out[out.k == 1].v.max() == pytest.approx(q3 + 1.5 * (q3 - q1))
    assert (out[out.k == 2].v == 7).all()


def test_repartition_invariance(spark):
    from panelforge.operators.stats import kruskal
    rng = np.random.default_rng(10)
    pdf = pd.DataFrame({"g": rng.integers(0, 4, 400), "x": rng.integers(0, 50, 400).astype(float)})
    df = spark.createDataFrame(pdf)
    a = kruskal(df.repartition(1), "g", "x").first()["h_stat"]
    b = kruskal(df.repartition(8), "g", "x").first()["h_stat"]
    assert a == pytest.approx(b, rel=1e-12)


def test_grouped_quantiles_hot_group_matches_numpy(spark):
    from panelforge.functions.quantile import grouped_quantiles
    rng = np.random.default_rng(11)
    g = np.where(rng.random(3000) < 0.7, 0, rng.integers(1, 6, 3000))  # group 0 holds most rows
    x = np.round(rng.normal(size=3000), 2)
    df = spark.createDataFrame(pd.DataFrame({"g": g.astype("int64"), "x": x}))
    got = grouped_quantiles(df, "x", [0.0, 0.25, 0.5, 0.9, 1.0], ["g"], n_ranges=16).toPandas().set_index("g")
    for k in np.unique(g):
        exp = np.quantile(x[g == k], [0.0, 0.25, 0.5, 0.9, 1.0])
        np.testing.assert_allclose(got.loc[k, ["q0", "q1", "q2", "q3", "q4"]].to_numpy(dtype=float), exp, rtol=1e-12)
    one = grouped_quantiles(df, "x", [0.5]).first()["q0"]
    assert one == pytest.approx(np.median(x))


def test_quantile_scalars_stacked_columns(spark):
    from panelforge.functions.quantile import quantile_scalars
    rng = np.random.default_rng(12)
    a = rng.normal(size=500)
    b = np.round(rng.exponential(size=500), 1)
    b[::7] = np.nan
    df = spark.createDataFrame(pd.DataFrame({"a": a, "b": b})).withColumn("b", F.nanvl("b", F.lit(None)))
    s = quantile_scalars(df, ["a", "b"], [0.01, 0.5, 0.99])
    got = spark.range(1).select(s["a"].alias("a"), s["b"].alias("b")).first()
    np.testing.assert_allclose(got["a"], np.quantile(a, [0.01, 0.5, 0.99]), rtol=1e-12)
    np.testing.assert_allclose(got["b"], np.quantile(b[~np.isnan(b)], [0.01, 0.5, 0.99]), rtol=1e-12)


@pytest.mark.parametrize("strips", [1, 3, 7])
def test_silhouette_tiles_use_every_pair_once(spark, monkeypatch, strips):
    from panelforge.operators import cluster
    monkeypatch.setattr(cluster, "strips_of", lambda n: strips)
    rng = np.random.default_rng(strips)
    X = rng.normal(size=(41, 3))
    lab = np.array([str(v) for v in rng.integers(0, 3, 40)] + ["lone"])
    df = cluster.vectors(spark.createDataFrame(pd.DataFrame(
        {"i": np.arange(41), "x0": X[:, 0], "x1": X[:, 1], "x2": X[:, 2], "l": lab})), ["x0", "x1", "x2"])
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    for metric, dist in (("euclidean", D), ("sqeuclidean", D ** 2)):
        got = _pdf(cluster.silhouette(df, "l", metric, id_col="i")).sort_values("i")["silhouette"].to_numpy()
        exp = []
        for i in range(41):
            same = lab == lab[i]
            a = dist[i, same].sum() / max(same.sum() - 1, 1)
            b = min(dist[i, lab == o].mean() for o in set(lab) - {lab[i]})
            exp.append((b - a) / max(a, b) if same.sum() > 1 else 0.0)
        np.testing.assert_allclose(got, exp, rtol=1e-9)


def test_strips_grow_with_the_square_root_of_the_tiles():
    from panelforge.operators.cluster import SILHOUETTE_STRIP, strips_of
    assert strips_of(0) == 1 and strips_of(100) == 1 and strips_of(2000) == 8
    for n in (10**6, 10**8):
        g = strips_of(n)
        assert g == -(-n // SILHOUETTE_STRIP) and g <= (g * (g + 1)) ** 0.5


def test_best_parameters_and_final_leaderboard(spark):
    from panelforge.operators import ml
    trials = "trial int, params string, cv_r2 double"
    grid = spark.createDataFrame([(0, "a=1;b=0.5", 0.1), (1, "a=2;b=0.7", 0.4), (2, "a=3;b=0.7", 0.4)], trials)
    rand = spark.createDataFrame([(0, "a=5;c=sqrt", -0.2)], trials)
    got = {r.parameter: (r.grid, r["random"]) for r in ml.best_parameters({"grid": grid, "random": rand}).collect()}
    assert got == {"a": ("2", "5"), "b": ("0.7", None), "c": (None, "sqrt")}
    assert ml.parameters("a=2;b=0.7;c=sqrt") == {"a": 2, "b": 0.7, "c": "sqrt"} and ml.parameters("") == {}
    rows = spark.createDataFrame(
        [("gbt", "baseline", 0.1, 0.9), ("gbt", "grid", 0.3, 0.8), ("gbt", "random", 0.3, 0.7), ("rf", "baseline", 0.5, 0.6),
         ("rf", "random", None, 0.6)], "family string, strategy string, cv_r2_mean double, train_r2 double")
    board = ml.final_leaderboard(rows).collect()
    assert [(r.family, r.strategy, r.chosen) for r in board] == [
        ("rf", "baseline", True), ("gbt", "grid", True), ("gbt", "baseline", False)]
    assert board[1].overfit_gap == pytest.approx(0.5)
