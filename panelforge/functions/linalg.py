"""Grouped least squares: the one kernel behind OLS, HC3, fixed effects, DiD, Granger, ADF and AR fits.

Data stays in Spark: one aggregate builds Σxᵢxⱼ, Σxᵢy, Σy², n per group (map-side
partial sums, so a group of any size is just a few hundred doubles).  Only those
k×k sums reach Python (``applyInPandas`` over one row per group) for the solve.
Columns are centred and scaled by their global mean/σ first, which keeps the
Gram matrix well conditioned; coefficients are transformed back exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.session import materialize

GROUP = "_grp"


def _standardise(df: DataFrame, cols: Sequence[str], centre: bool = True) -> tuple[DataFrame, Column]:
    """Centre (with an intercept) and scale columns for conditioning.

    Mean and σ are taken over all rows (one map-side combined aggregate): the solve cuts
    directions by their relative size, so a scale from part of the rows would make the
    result depend on their order.
    """
    mu = (lambda c: F.avg(c)) if centre else (lambda c: F.lit(0.0))
    sdf = (lambda c: F.stddev_pop(c)) if centre else (lambda c: F.sqrt(F.avg(F.col(c) * F.col(c))))
    st = df.agg(F.struct(*[F.struct(mu(c).cast("double").alias("mu"), sdf(c).alias("sd")).alias(f"s{i}")
                           for i, c in enumerate(cols)])).scalar()
    exprs = {}
    for i, c in enumerate(cols):
        sd = F.when((st[f"s{i}"]["sd"] > 0), st[f"s{i}"]["sd"]).otherwise(F.lit(1.0))
        exprs[f"_z{i}"] = (F.col(c) - st[f"s{i}"]["mu"]) / sd
    return df.withColumns(exprs), st


def gram(df: DataFrame, y: str, xs: Sequence[str], by: Sequence[str] = (), intercept: bool = True,
         weight: Column | None = None) -> DataFrame:
    """Per group: n, Σxx (row-major k×k), Σxy, Σyy on standardised columns, plus the scaling used.

    Rows with a NULL in y or any x are dropped (listwise, as the reference does).
    """
    by = list(by)
    cols = [y, *xs]
    data = df.dropna(subset=cols)
    if not by:
        data = data.withColumn(GROUP, F.lit(0))
        by = [GROUP]
    z, st = _standardise(data, cols, centre=intercept)
    zy = F.col("_z0")
    zx = ([F.lit(1.0)] if intercept else []) + [F.col(f"_z{i + 1}") for i in range(len(xs))]
    k = len(zx)
    w = weight if weight is not None else F.lit(1.0)
    sums = [F.sum(w * zx[i] * zx[j]).alias(f"_xx_{i}_{j}") for i in range(k) for j in range(i, k)]
    sums += [F.sum(w * zx[i] * zy).alias(f"_xy_{i}") for i in range(k)]
    g = z.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(w * zy * zy).alias("_yy"), *sums)
    sxx = F.array(*[F.col(f"_xx_{min(i, j)}_{max(i, j)}") for i in range(k) for j in range(k)])
    sxy = F.array(*[F.col(f"_xy_{i}") for i in range(k)])
    mu = F.array(*[st[f"s{i}"]["mu"] for i in range(len(cols))])
    sd = F.array(*[F.when(st[f"s{i}"]["sd"] > 0, st[f"s{i}"]["sd"]).otherwise(F.lit(1.0)) for i in range(len(cols))])
    return g.select(*by, "n", "_yy", sxx.alias("sxx"), sxy.alias("sxy"), mu.alias("mu"), sd.alias("sd"))


def solve_gram(sxx, sxy, syy, n, mu, sd, intercept: bool, n_absorbed: int = 0, sst=None):
    """Solve one group's normal equations; returns coefficients and fit statistics on the original scale.

    ``n_absorbed`` counts fixed-effect levels removed by demeaning (their dummies and the
    constant), ``sst`` is then the total sum of squares of the un-demeaned y.
    """
    sxx = np.asarray(sxx, dtype=float)
    k = int(round(np.sqrt(sxx.size)))
    A = sxx.reshape(k, k)
    b = np.asarray(sxy, dtype=float)
    inv = np.linalg.pinv(A)
    beta_z = inv @ b
    rank = int(np.linalg.matrix_rank(A)) if k else 0
    ssr_z = max(float(syy - 2 * beta_z @ b + beta_z @ A @ beta_z), 0.0)
    T = transform(mu, sd, intercept, k)
    beta = T @ beta_z
    if intercept:
        beta[0] += float(mu[0])
    sdy = float(sd[0])
    ssr = ssr_z * sdy ** 2
    const = 1 if (intercept or n_absorbed) else 0
    nparams = rank + max(n_absorbed, 0)
    df_resid = n - nparams
    cov = T @ (inv * (ssr_z / df_resid)) @ T.T if df_resid > 0 else np.full((k, k), np.nan)
    se = np.sqrt(np.clip(np.diag(cov), 0, None))
    if sst is None:
        ybar_z = (b[0] / n) if intercept else 0.0
        sst = (syy - n * ybar_z ** 2) * sdy ** 2 if intercept else syy * sdy ** 2
    r2 = 1 - ssr / sst if sst > 0 else np.nan
    df_model = nparams - const
    adj = 1 - (1 - r2) * (n - const) / df_resid if df_resid > 0 else np.nan
    f = ((sst - ssr) / df_model) / (ssr / df_resid) if df_model > 0 and df_resid > 0 and ssr > 0 else np.nan
    llf = -n / 2 * (np.log(2 * np.pi) + np.log(ssr / n) + 1) if ssr > 0 else np.nan
    return {"beta": beta, "se": se, "inv_z": inv, "beta_z": beta_z, "ssr": ssr, "r2": r2, "adj_r2": adj,
            "f": f, "df_model": df_model, "df_resid": df_resid, "llf": llf,
            "aic": -2 * llf + 2 * nparams, "bic": -2 * llf + np.log(n) * nparams, "rank": rank}


def transform(mu, sd, intercept: bool, k: int) -> np.ndarray:
    """Matrix taking standardised coefficients to the original scale (the intercept also
    receives ``mu_y``, added separately)."""
    mu, sd = np.asarray(mu, dtype=float), np.asarray(sd, dtype=float)
    nx = len(mu) - 1
    off = 1 if intercept else 0
    T = np.zeros((k, k))
    if intercept:
        T[0, 0] = sd[0]
        for j in range(nx):
            T[0, off + j] = -sd[0] * mu[1 + j] / sd[1 + j]
    for j in range(nx):
        T[off + j, off + j] = sd[0] / sd[1 + j]
    return T


def ols(df: DataFrame, y: str, xs: Sequence[str], by: Sequence[str] = (), intercept: bool = True,
        cov: str = "nonrobust", absorb: str | None = None) -> DataFrame:
    """Least squares per group → one row per (group, term).

    Columns: term, coef, se, stat (t, or z for HC3), df_resid, r2, adj_r2, f_stat, df_model,
    aic, bic, n, ssr.  ``absorb`` demeans y and xs within that key (fixed effects by the
    within transformation; same slopes and residuals as key dummies).  ``cov='HC3'``
    runs a second distributed pass for leverages and the sandwich.
    """
    by = list(by)
    need = list(dict.fromkeys([*by, y, *xs, *([absorb] if absorb else [])]))
    data = df.select(*need).dropna(subset=[y, *xs])
    if absorb or cov.upper() == "HC3":
        data = materialize(data)  # several passes follow (means, Gram, leverages, sandwich)
    orig = data
    if absorb:
        keys = [*by, absorb]
        means = data.groupBy(*keys).agg(*[F.avg(c).alias(f"_m_{c}") for c in [y, *xs]],
                                        F.count(F.lit(1)).alias("_ng"))
        data = data.join(means, keys).withColumns({c: F.col(c) - F.col(f"_m_{c}") for c in [y, *xs]})
        intercept = False
    g = gram(data, y, xs, by, intercept)
    gcols = by or [GROUP]
    if absorb:
        tot = [F.countDistinct(absorb).alias("_nabs"),
               (F.var_samp(y) * (F.count(y) - 1)).alias("_sst")]
        totals = orig.groupBy(*by).agg(*tot) if by else orig.agg(*tot).withColumn(GROUP, F.lit(0))
        g = g.join(totals, gcols)
    else:
        g = g.withColumns({"_nabs": F.lit(0), "_sst": F.lit(None).cast("double")})
    robust = cov.upper() == "HC3"
    if robust:
        g = materialize(g)  # one row per group; reused by the fit and the HC3 pass
    names = (["const"] if intercept else []) + list(xs)
    key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in g.schema.fields if f.name in gcols)
    schema = (key_schema + ", " if key_schema else "") + (
        "term string, coef double, se double, stat double, df_resid double, r2 double, adj_r2 double, "
        "f_stat double, df_model double, aic double, bic double, n long, ssr double, "
        "inv_z array<double>, beta_z array<double>")
    icpt = intercept

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.iloc[0]
        sst = None if pd.isna(r["_sst"]) else float(r["_sst"])
        res = solve_gram(r["sxx"], r["sxy"], r["_yy"], int(r["n"]), r["mu"], r["sd"], icpt, int(r["_nabs"]), sst)
        out = pd.DataFrame({"term": names, "coef": res["beta"], "se": res["se"]})
        out["stat"] = out["coef"] / out["se"].where(out["se"] > 0)
        for kname, v in (("df_resid", res["df_resid"]), ("r2", res["r2"]), ("adj_r2", res["adj_r2"]),
                         ("f_stat", res["f"]), ("df_model", res["df_model"]), ("aic", res["aic"]),
                         ("bic", res["bic"]), ("ssr", res["ssr"])):
            out[kname] = float(v)
        out["n"] = int(r["n"])
        out["inv_z"] = [list(np.ravel(res["inv_z"]))] * len(out)
        out["beta_z"] = [list(res["beta_z"])] * len(out)
        for c in gcols:
            out.insert(0, c, r[c])
        return out

    coefs = g.groupBy(*gcols).applyInPandas(fit, schema)
    if robust:
        coefs = materialize(coefs)
        coefs = _hc3(data if by else data.withColumn(GROUP, F.lit(0)), g, coefs, y, xs, gcols, intercept, names,
                     absorb)
    out = coefs.drop("inv_z", "beta_z")
    return out.drop(GROUP) if not by else out


def _hc3(data: DataFrame, g: DataFrame, coefs: DataFrame, y: str, xs: Sequence[str], gcols: list[str],
         intercept: bool, names: list[str], absorb: str | None) -> DataFrame:
    """Second pass: hᵢ = zᵢ'(Z'Z)⁻¹zᵢ (+1/n_key with absorbed effects), sandwich Σ e²/(1−h)² zz'."""
    k = len(names)
    sol = (coefs.groupBy(*gcols).agg(F.first("inv_z").alias("inv_z"), F.first("beta_z").alias("beta_z"))
           .join(g.select(*gcols, "mu", "sd"), gcols))
    rows = data.join(sol, gcols)  # one small row per group; AQE broadcasts it
    # staged projections keep every expression small (each stage references columns only)
    rows = rows.withColumns({"_zy": (F.col(y) - F.col("mu")[0]) / F.col("sd")[0],
                             **{f"_zx{i + 1}": (F.col(c) - F.col("mu")[i + 1]) / F.col("sd")[i + 1]
                                for i, c in enumerate(xs)}})
    zx = ([F.lit(1.0)] if intercept else []) + [F.col(f"_zx{i + 1}") for i in range(len(xs))]
    quad = [zx[i] * F.col("inv_z")[i * k + j] * zx[j] for i in range(k) for j in range(k)]
    h = F.aggregate(F.array(*quad), F.lit(0.0), lambda acc, v: acc + v)
    if absorb:
        h = h + 1.0 / F.col("_ng")
    fitted = F.aggregate(F.array(*[F.col("beta_z")[i] * zx[i] for i in range(k)]), F.lit(0.0), lambda a, v: a + v)
    rows = rows.withColumns({"_h": h, "_e": (F.col("_zy") - fitted) * F.col("sd")[0]})
    rows = rows.withColumn("_w", (F.col("_e") * F.col("_e")) / F.pow(1 - F.col("_h"), 2))
    meat = rows.groupBy(*gcols).agg(*[F.sum(F.col("_w") * zx[i] * zx[j]).alias(f"_m_{i}_{j}")
                                      for i in range(k) for j in range(k)])
    meat = meat.select(*gcols, F.array(*[F.col(f"_m_{i}_{j}") for i in range(k) for j in range(k)]).alias("meat"))
    j = coefs.join(meat, gcols).join(g.select(*gcols, "sd"), gcols)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in j.schema.fields
                       if f.name not in ("meat", "sd"))
    return j.join(g.select(*gcols, "mu"), gcols).groupBy(*gcols).applyInPandas(
        _sandwich(intercept, k, names), schema)


def _sandwich(intercept: bool, k: int, names: list[str]):
    """Wrap the sandwich so the intercept's variance uses the full mean shift."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.iloc[0]
        inv = np.asarray(r["inv_z"], dtype=float).reshape(k, k)
        M = np.asarray(r["meat"], dtype=float).reshape(k, k)
        sd = np.asarray(r["sd"], dtype=float)
        T = transform(r["mu"], sd, intercept, k)
        cov = T @ (inv @ (M / sd[0] ** 2) @ inv) @ T.T
        se = np.sqrt(np.clip(np.diag(cov), 0, None))
        out = pdf.drop(columns=["meat", "sd", "mu"]).copy()
        out["se"] = [se[names.index(t)] for t in out["term"]]
        out["stat"] = out["coef"] / out["se"].where(out["se"] > 0)
        return out
    return run
