"""Unit-root tests against plain least squares on every sample."""

import math

import numpy as np
import pytest


def _fit(y, lag, start):
    """(n, ssr, t of the level) with rows of y from index ``start`` on."""
    dy = np.diff(y)
    rows = range(start, len(y))
    x = np.array([[1.0, y[t - 1], *[dy[t - 1 - i] for i in range(1, lag + 1)]] for t in rows])
    z = np.array([dy[t - 1] for t in rows])
    beta, *_ = np.linalg.lstsq(x, z, rcond=None)
    ssr = float(((z - x @ beta) ** 2).sum())
    se = math.sqrt(ssr / (len(z) - x.shape[1]) * np.linalg.inv(x.T @ x)[1, 1])
    return len(z), ssr, beta[1] / se


def _series():
    rng = np.random.default_rng(2)
    out = {"walk": np.cumsum(rng.normal(size=60)) + 1e4, "noise": rng.normal(size=45), "short": rng.normal(size=9)}
    ar = [0.0, 0.1]
    for e in rng.normal(size=140):
        ar.append(0.5 * ar[-1] + 0.3 * ar[-2] + e)
    return out | {"ar": np.array(ar)}


def _frame(spark, extra=()):
    rows = [(k, int(t), float(v)) for k, y in _series().items() for t, v in enumerate(y)]
    return spark.createDataFrame([*rows, *extra], "k string, t long, y double").repartition(3)


@pytest.mark.parametrize("width", [8192, 16])
def test_every_order_and_the_choice_among_them(spark, monkeypatch, width):
    from panelforge.operators import unitroot
    monkeypatch.setattr(unitroot.positions, "__defaults__", ("t", "pos", width))
    monkeypatch.setattr(unitroot.with_border, "__defaults__", (width,))
    df = _frame(spark, [("flat", t, 3.0) for t in range(20)] + [("tiny", 0, 1.0), ("tiny", 1, 2.0), ("walk", 99, None)])
    top = None if width > 16 else 3
    table = unitroot.lag_table(df, "k", max_lag=top)[0].collect()
    got = {(r.k, r.lag): r for r in table}
    chosen = {r.k: r for r in unitroot.adf(df, "k", max_lag=top).collect()}
    for k, y in _series().items():
        longest = min(math.ceil(12 * (len(y) / 100) ** 0.25) if top is None else top, len(y) // 2 - 2)
        aic = {}
        for lag in range(longest + 1):
            n, ssr, t = _fit(y, lag, longest + 2 - 1)
            assert got[(k, lag)].n == n
            assert got[(k, lag)].adf_t == pytest.approx(t, rel=1e-6)
            assert got[(k, lag)].ssr * y.var() == pytest.approx(ssr, rel=1e-6)
            aic[lag] = n * math.log(ssr / n) + 2 * (lag + 2)
        assert (k, longest + 1) not in got
        best = min(aic, key=aic.get)
        n, _, t = _fit(y, best, best + 2 - 1)
        assert (chosen[k].lag, chosen[k].n) == (best, n) and chosen[k].adf_stat == pytest.approx(t, rel=1e-6)
    assert chosen["noise"].stationary and not chosen["walk"].stationary
    assert chosen["flat"].p_value == 1.0 and chosen["tiny"].p_value == 1.0


def test_no_series(spark):
    from panelforge.operators import unitroot
    assert unitroot.adf(_frame(spark).limit(0), "k").count() == 0
