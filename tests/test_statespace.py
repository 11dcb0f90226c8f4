"""Likelihoods from combined chunks against the plain filter and the joint normal density."""

import numpy as np
import pytest


def _plain_filter(y, phi, theta, mean):
    """(sum log F, sum v v / F) of a plain step-by-step filter."""
    r = 3
    t = np.zeros((r, r))
    t[: len(phi), 0] = phi
    t[0, 1] = t[1, 2] = 1
    g = np.zeros(r)
    g[0] = 1
    g[1: 1 + len(theta)] = theta
    p = np.linalg.solve(np.eye(r * r) - np.kron(t, t), np.outer(g, g).ravel()).reshape(r, r)
    x, logs, quad = np.zeros(r), 0.0, 0.0
    for v in y - mean:
        x, p = t @ x, t @ p @ t.T + np.outer(g, g)
        f = p[0, 0]
        e = v - x[0]
        logs, quad = logs + np.log(f), quad + e * e / f
        k = p[:, 0] / f
        x, p = x + k * e, p - np.outer(k, p[0])
    return logs, quad, x


@pytest.mark.parametrize("order", [(0, 0, 0), (1, 0, 0), (0, 0, 2), (2, 0, 1), (2, 1, 2)])
def test_combined_stretches_equal_a_plain_filter(order):
    from panelforge.operators.statespace import Arma, coefficients, combine, conclude
    p, d, q = order
    rng = np.random.default_rng(sum(order))
    raw = rng.normal(scale=0.7, size=p + q + (d == 0))
    y = rng.normal(size=40).cumsum() * 0.4
    arma = raw[1:] if d == 0 else raw
    logs, quad, state = _plain_filter(y, coefficients(arma[:p]), -coefficients(arma[p:]), raw[0] if d == 0 else 0.0)
    model = Arma([order], [raw])
    want = -0.5 * (40 * (np.log(2 * np.pi * quad / 40) + 1) + logs)
    for cuts in ([], [13], [1, 2, 30, 39]):
        whole = None
        for piece in np.split(y, cuts):
            own = model.fold(piece)
            whole = own if whole is None else combine(whole, own)
        end = conclude(whole, model.prior())
        assert end["ll"][0] == pytest.approx(want, rel=1e-10)
        np.testing.assert_allclose(end["state"][0], state, atol=1e-8)
    # any bracketing gives the same summary
    a, b, c = (model.fold(x) for x in np.split(y, [11, 25]))
    np.testing.assert_allclose(combine(combine(a, b), c), combine(a, combine(b, c)), atol=1e-9)


def _frame(spark, series):
    rows = [(k, int(t), None if v is None else float(v)) for k, y in series.items() for t, v in enumerate(y)]
    return spark.createDataFrame(rows, "k string, t int, y double").repartition(3)


def test_fits_reach_the_optimum_whatever_the_chunks(spark):
    from panelforge.operators import statespace as ss
    rng = np.random.default_rng(1)
    ar = [0.0]
    for e in rng.normal(size=160):
        ar.append(0.7 * ar[-1] + e)
    series = {"ar": np.array(ar) * 5 + 100, "walk": rng.normal(size=50).cumsum(), "flat": [3.0] * 10}
    df = _frame(spark, series)
    orders = [(1, 0, 0), (0, 1, 1)]
    got = {}
    for width in (4096, 7):
        fits, parts = ss.fit(df, "k", orders=orders, rounds=10, width=width)
        got[width] = {(r.k, r.p, r.d, r.q): r for r in fits.collect()}
        assert width == 4096 or parts.agg({"chunk": "max"}).first()[0] == 160 // 7
    assert set(got[7]) == {(k, *o) for k in ("ar", "walk") for o in orders}
    for name, r in got[4096].items():
        assert got[7][name].ll == pytest.approx(r.ll, abs=1e-6)
        y = series[name[0]]
        v = np.diff(y) if r.d else y
        scale = y.std()
        v = (v if r.d else v - y.mean()) / scale
        best = None
        for a in np.linspace(-1.5, 1.5, 61):
            for m in (np.linspace(-0.3, 0.3, 13) if r.d == 0 else [0.0]):
                model = ss.Arma([(r.p, r.d, r.q)], [[m, a] if r.d == 0 else [a]])
                ll = ss.conclude(model.fold(v), model.prior())["ll"][0] - len(v) * np.log(scale)
                best = ll if best is None else max(best, ll)
        assert r.ll >= best - 1e-3 and r.aic == pytest.approx(-2 * r.ll + 2 * r.n_params)
    phi = np.tanh(got[7][("ar", 1, 0, 0)].raw[1])
    assert 0.5 < phi < 0.9


def test_forecasts_of_known_models(spark):
    from panelforge.operators import statespace as ss
    rng = np.random.default_rng(3)
    series = {"walk": rng.normal(size=60).cumsum(), "noise": rng.normal(size=60) + 10}
    df = _frame(spark, series)
    fits, parts = ss.fit(df, "k", orders=[(0, 0, 0), (0, 1, 0)], rounds=8, width=16)
    chosen = ss.select_order(fits, df, "k")
    picked = {r.k: (r.p, r.d, r.q) for r in chosen.collect()}
    assert picked == {"walk": (0, 1, 0), "noise": (0, 0, 0)}
    rows = {(r.k, r.step): r for r in ss.forecast(df, chosen, parts, "k", steps=3).collect()}
    sd = np.sqrt((np.diff(series["walk"]) ** 2).mean())
    for h in (1, 2, 3):
        r = rows[("walk", h)]
        assert r.t == 59 + h and r.forecast == pytest.approx(series["walk"][-1])
        assert r.hi - r.forecast == pytest.approx(1.2815515655 * sd * np.sqrt(h), rel=1e-6)
        assert rows[("noise", h)].forecast == pytest.approx(series["noise"].mean(), abs=1e-3)


def test_short_series_take_no_job_a_round_and_equal_long_ones(spark, monkeypatch):
    from panelforge.operators import statespace as ss
    rng = np.random.default_rng(9)
    series = {f"s{i}": rng.normal(size=24 + i % 3).cumsum() for i in range(7)}
    df = _frame(spark, series).checkpoint()
    orders = [(0, 0, 0), (0, 1, 0), (1, 0, 1), (2, 1, 1)]
    whole = {(r.k, r.p, r.d, r.q): r for r in ss.fit(df, "k", orders=orders, rounds=6, width=8)[0].collect()}
    jobs = []
    own = ss.materialize
    monkeypatch.setattr(ss, "materialize", lambda x: jobs.append(1) or own(x))
    short = {(r.k, r.p, r.d, r.q): r for r in ss.fit(df, "k", orders=orders, rounds=6)[0].collect()}
    assert len(jobs) == 2  # the chunks and the fits, however many rounds
    assert set(short) == set(whole) and len(short) == 28
    for name, r in short.items():
        assert r.ll == pytest.approx(whole[name].ll, abs=1e-6)


def test_searches_move_as_arrays():
    from panelforge.operators.statespace import first_candidates, moved
    raws = np.tile(first_candidates(2), (3, 1, 1))
    ll = np.array([[0, -1, -1, -1, -1, 0, 0], [0, 1, -1, -3, 2, 0, 0], [np.nan] * 7], float)
    now, step, top = moved(raws, np.full(3, 0.4), ll)
    assert now.shape == (3, 7, 2) and step.tolist() == [0.2, 0.4, 0.2] and top.tolist() == [0, 2, -1e300]
    assert now[0, 0].tolist() == [0, 0] and now[1, 0].tolist() == [0, 0.4]
    np.testing.assert_allclose(now[1, 5], [-0.4, 0.4 / 2 * (-3 - 2) / (-3 + 2)])
    assert [len(first_candidates(n)) for n in (0, 1, 5)] == [1, 5, 13]
