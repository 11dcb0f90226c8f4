"""Windows, ranks, codes and matches over ranges: equal to the plain forms, hot keys spread."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def hot(spark):
    rng = np.random.default_rng(7)
    n = 3000
    keys = pd.array(np.where(rng.random(n) < 0.5, 0, rng.integers(1, 40, n)), dtype="Int64")
    keys[keys == 5] = pd.NA
    v = rng.normal(size=n)
    pdf = pd.DataFrame({"k": keys, "t": rng.permutation(n), "v": v})
    df = spark.createDataFrame(pdf).withColumn("v", F.when(F.col("t") % 11 != 0, F.col("v")))
    return df.checkpoint()


def _rows(df, name):
    return df.select("t", name).toPandas().sort_values("t")[name].to_numpy()


def test_positions_are_gapless_and_hot_keys_spread(spark, hot):
    from panelforge.operators.ordered import positions, ranges
    got = positions(hot, ["k"], "t").toPandas().sort_values(["k", "t"])
    assert (got.groupby("k", dropna=False)["t"].rank().to_numpy() == got["_pos"].to_numpy()).all()
    assert len(got) == 3000
    per = ranges(hot, ["k"], ["t"]).groupBy("_range").count().toPandas()["count"]
    assert len(per) == 8 and per.max() < 3000 / 4
    assert positions(hot.limit(0), ["k"], "t").count() == 0


@pytest.mark.parametrize("size,block", [(3, 7), (5, 5), (4, 1), (3, 1 << 16)])
def test_spread_rolling_mean_equals_plain(hot, size, block):
    from panelforge.operators.windows import rolling_mean
    name = f"v_roll{size}"
    plain = _rows(rolling_mean(hot, ["k"], "t", ["v"], size), name)
    spread = _rows(rolling_mean(hot, ["k"], "t", ["v"], size, spread=True, block_rows=block), name)
    np.testing.assert_array_equal(plain, spread)


@pytest.mark.parametrize("keys,maximize", [(["k"], True), (["k"], False), ([], True)])
def test_spread_running_best_equals_plain(hot, keys, maximize):
    from panelforge.operators.windows import running_best
    plain = _rows(running_best(hot, "t", "v", keys, maximize=maximize), "best_so_far")
    spread = _rows(running_best(hot, "t", "v", keys, maximize=maximize, spread=True), "best_so_far")
    np.testing.assert_array_equal(plain, spread)


@pytest.mark.parametrize("short", [0, 1 << 15])
def test_acf_equals_direct_sums(spark, short):
    from panelforge.operators.windows import acf
    rng = np.random.default_rng(3)
    series = {"a": rng.normal(size=333).cumsum(), "b": rng.normal(size=64), "c": np.ones(9), "d": np.array([2.0]),
              None: rng.normal(size=17)}
    rows = [(k, i, float(x)) for k, v in series.items() for i, x in enumerate(v)] + [("b", -1, None)]
    df = spark.createDataFrame(rows, "k string, t long, x double")
    for max_lag in (None, 20):
        got = {(r.k, r.lag): r.acf for r in acf(df, ["k"], "t", "x", max_lag, short=short).collect()}
        want = {}
        for k, v in series.items():
            d = v - v.mean()
            for lag in range(1, min(len(v) - 1, len(v) // 2 - 1 if max_lag is None else max_lag) + 1):
                want[k, lag] = (d[lag:] * d[:-lag]).sum() / (d * d).sum() if (d * d).sum() else None
        assert got.keys() == want.keys()
        for key, w in want.items():
            assert (got[key] is None) == (w is None)
            if w is not None:
                assert got[key] == pytest.approx(w, abs=1e-12)


def test_fourier_equals_numpy(spark):
    from panelforge.operators.spectral import fourier
    x = np.random.default_rng(1).normal(size=32)
    rows = [(1, 8, 4, i, float(v), 0.0) for i, v in enumerate(x) if i != 9]
    x[9] = 0
    df = spark.createDataFrame(rows, "k int, _n1 long, _n2 long, _at long, _re double, _im double")
    got = fourier(df, ["k"]).toPandas().sort_values("_at")
    np.testing.assert_allclose(got["_re"] + 1j * got["_im"], np.fft.fft(x), atol=1e-12)


def test_spearman_with_ties_nulls_and_empty_features(spark):
    from panelforge.operators.stats import spearman
    rng = np.random.default_rng(5)
    n = 500
    pdf = pd.DataFrame({"y": rng.integers(0, 30, n).astype(float), "a": rng.integers(0, 9, n).astype(float),
                        "b": rng.normal(size=n), "c": 1.0, "e": np.nan})
    pdf.loc[::7, "a"] = np.nan
    pdf.loc[::5, "y"] = np.nan
    got = spearman(spark.createDataFrame(pdf), "y", ["a", "b", "c", "e"]).toPandas().set_index("feature")
    for f in "ab":
        sub = pdf[["y", f]].dropna()
        assert got.loc[f, "rho"] == pytest.approx(sub["y"].rank().corr(sub[f].rank()), abs=1e-12)
        assert got.loc[f, "n"] == len(sub)
    assert np.isnan(got.loc["c", "rho"]) and got.loc["e", "n"] == 0


def test_one_hot_sparse_and_dense_bound(spark):
    from panelforge.operators.features import one_hot, one_hot_sparse
    values = ["b", "a", None, "c", "a", "z", "", "a"]
    df = spark.createDataFrame(list(enumerate(values)), "i int, x string")
    levels = sorted({v for v in values if v is not None})
    for drop in (False, True):
        got = {r.i: r.v for r in one_hot_sparse(df, "x", "v", drop_first=drop).collect()}
        assert len(got) == len(values)
        for i, v in enumerate(values):
            at = None if v is None else levels.index(v) - drop
            want = [] if at is None or at < 0 else [at]
            assert got[i]["size"] == len(levels) - drop
            assert got[i]["indices"] == want and got[i]["values"] == [1.0] * len(want)
    assert one_hot_sparse(df.limit(0), "x").count() == 0
    with pytest.raises(ValueError, match="one_hot_sparse"):
        one_hot(df, "x", max_levels=3)
    assert len(one_hot(df, "x", max_levels=5).columns) == 7


@pytest.mark.parametrize("n_ranges", [1, 8, 40])
def test_nearest_match_on_skewed_scores(spark, n_ranges):
    from panelforge.operators.joins import nearest_match
    rng = np.random.default_rng(9)
    score = np.round(np.exp(rng.normal(scale=4, size=400)), 2)
    score[:150] = 1.0
    side = rng.random(400) < 0.7
    side[:150] = True
    rows = [(i, float(s), bool(t)) for i, (s, t) in enumerate(zip(score, side, strict=True))] + [(900, None, True), (901, None, False)]
    df = spark.createDataFrame(rows, "i long, s double, t boolean")
    got = {r.treated_i: r for r in nearest_match(df.where("t"), df.where("not t"), "i", "s", n_ranges).collect()}
    controls = [(s, i) for i, s, t in rows if not t and s is not None]
    assert len(got) == side.sum() + 1 and got[900].control_i is None
    for i, s, t in rows:
        if t and s is not None:
            d, c = min((abs(cs - s), ci) for cs, ci in controls)
            assert (got[i].score_diff, got[i].control_i) == (d, c)
    alone = nearest_match(df.where("t"), df.where("i < 0"), "i", "s", n_ranges)
    assert alone.where("control_i is not null").count() == 0 and alone.count() == len(got)
