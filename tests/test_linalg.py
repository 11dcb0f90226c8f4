"""OLS core against numpy: coefficients, classical and HC3 errors, fixed effects."""

import numpy as np
import pandas as pd
import pytest

from panelforge.functions.linalg import ols


def _frame(spark, seed=0, n=120, groups=6):
    rng = np.random.default_rng(seed)
    g = np.repeat(np.arange(groups), n // groups)
    x1 = rng.normal(10, 3, n)
    x2 = rng.normal(0, 1, n) * 1000 + 5e5
    y = 3 + 2 * x1 - 0.001 * x2 + g * 1.5 + rng.normal(0, 1, n)
    pdf = pd.DataFrame({"g": g.astype("int64"), "x1": x1, "x2": x2, "y": y})
    return pdf, spark.createDataFrame(pdf)


def _np_ols(X, y):
    # QR on the design itself: well conditioned even with money-scale columns
    keep = np.abs(np.linalg.qr(X)[1].diagonal()) > 1e-9 * np.abs(X).max()
    X = X[:, keep] if not keep.all() else X
    q, r = np.linalg.qr(X)
    r_inv = np.linalg.inv(r)
    XtX_inv = r_inv @ r_inv.T
    b = r_inv @ (q.T @ y)
    e = y - X @ b
    n, k = X.shape
    rank = np.linalg.matrix_rank(X)
    s2 = e @ e / (n - rank)
    se = np.sqrt(np.diag(XtX_inv) * s2)
    h = np.einsum("ij,jk,ik->i", X, XtX_inv, X)
    meat = (X * (e ** 2 / (1 - h) ** 2)[:, None]).T @ X
    se_hc3 = np.sqrt(np.diag(XtX_inv @ meat @ XtX_inv))
    return b, se, se_hc3, e


def test_ols_matches_numpy(spark):
    pdf, df = _frame(spark)
    res = ols(df, "y", ["x1", "x2"]).toPandas().set_index("term")
    X = np.column_stack([np.ones(len(pdf)), pdf.x1, pdf.x2])
    b, se, _, e = _np_ols(X, pdf.y.to_numpy())
    np.testing.assert_allclose(res.loc[["const", "x1", "x2"], "coef"], b, rtol=1e-7)
    np.testing.assert_allclose(res.loc[["const", "x1", "x2"], "se"], se, rtol=1e-6)
    sst = ((pdf.y - pdf.y.mean()) ** 2).sum()
    assert res["r2"].iloc[0] == pytest.approx(1 - (e @ e) / sst, rel=1e-7)


def test_hc3_matches_numpy(spark):
    pdf, df = _frame(spark, seed=1)
    res = ols(df, "y", ["x1", "x2"], cov="HC3").toPandas().set_index("term")
    X = np.column_stack([np.ones(len(pdf)), pdf.x1, pdf.x2])
    _, _, se_hc3, _ = _np_ols(X, pdf.y.to_numpy())
    np.testing.assert_allclose(res.loc[["const", "x1", "x2"], "se"], se_hc3, rtol=1e-6)


def test_fixed_effects_equal_dummies(spark):
    pdf, df = _frame(spark, seed=2)
    res = ols(df, "y", ["x1", "x2"], absorb="g", cov="HC3").toPandas().set_index("term")
    D = pd.get_dummies(pdf.g, drop_first=True).to_numpy(dtype=float)
    X = np.column_stack([np.ones(len(pdf)), D, pdf.x1, pdf.x2])
    b, se, se_hc3, e = _np_ols(X, pdf.y.to_numpy())
    np.testing.assert_allclose(res.loc[["x1", "x2"], "coef"], b[-2:], rtol=1e-7)
    np.testing.assert_allclose(res.loc[["x1", "x2"], "se"], se_hc3[-2:], rtol=1e-6)
    sst = ((pdf.y - pdf.y.mean()) ** 2).sum()
    assert res["r2"].iloc[0] == pytest.approx(1 - (e @ e) / sst, rel=1e-7)


def test_grouped_ols_equals_per_group(spark):
    pdf, df = _frame(spark, seed=3)
    res = ols(df, "y", ["x1"], by=["g"]).toPandas()
    for g, sub in pdf.groupby("g"):
        X = np.column_stack([np.ones(len(sub)), sub.x1])
        b, se, _, _ = _np_ols(X, sub.y.to_numpy())
        got = res[(res.g == g)].set_index("term")
        np.testing.assert_allclose(got.loc[["const", "x1"], "coef"], b, rtol=1e-7)
        np.testing.assert_allclose(got.loc[["const", "x1"], "se"], se, rtol=1e-6)


def test_residuals_sum_to_zero(spark):
    from panelforge.operators.stats import fitted_residuals, regression
    pdf, df = _frame(spark, seed=4)
    coefs = regression(df, "y", ["x1", "x2"])
    fr = fitted_residuals(df, coefs, "y", ["x1", "x2"], ["g"]).toPandas()
    assert abs(fr.residual.sum()) < 1e-6 * len(fr) * pdf.y.abs().mean()
