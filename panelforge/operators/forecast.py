"""Forecasting many series at once (FC-1..12).

Every series is a key.  Unit-root tests over all lags are in ``unitroot``, ARIMA by exact
likelihood in ``statespace``; here are loading, the plain forecasts, hold-outs and metrics.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.operators.aggs import coverage_filter


def load_series(df: DataFrame, key: str, period, value: str, slack: int = 1, period_name: str = "t") -> DataFrame:
    """FC-1: sum per (key, period), keys with at least max(count) − slack periods."""
    s = df.groupBy(key, (period if not isinstance(period, str) else F.col(period)).alias(period_name)).agg(
        F.sum(value).alias("y"))
    return coverage_filter(s, key, slack)


def global_series(series: DataFrame, key: str, period: str = "t", label: str = "GLOBAL") -> DataFrame:
    """FC-2: sum over keys per period, tagged with a key of its own, unioned to the per-key series."""
    g = series.groupBy(period).agg(F.sum("y").alias("y")).select(F.lit(label).alias(key), period, "y")
    return series.select(F.col(key).cast("string").alias(key), period, "y").unionByName(g)


def with_index(series: DataFrame, key: str, period: str = "t") -> DataFrame:
    """Position 1..n of each period within its key."""
    return series.withColumn("pos", F.row_number().over(Window.partitionBy(key).orderBy(period)))


# ------------------------------------------------------------------ unit-root test
# MacKinnon (1994) p-value surface for the ADF t statistic, constant-only
# model, one series: tau max / min / star, small-p and large-p polynomial coefficients.
_TAU_MAX, _TAU_MIN, _TAU_STAR = 2.74, -18.83, -1.61
_SMALL_P = (2.1659, 1.4412, 0.038269)
_LARGE_P = (1.7339, 0.93202 * 1e-1, -0.12745 * 1e-1, -0.010368 * 1e-2)


def adf_pvalue(t: float) -> float:
    from panelforge.functions.dist import norm_cdf
    if t is None or math.isnan(t):
        return float("nan")
    if t > _TAU_MAX:
        return 1.0
    if t < _TAU_MIN:
        return 0.0
    coefs = _SMALL_P if t <= _TAU_STAR else _LARGE_P
    return norm_cdf(sum(c * t ** i for i, c in enumerate(coefs)))


def adf_t_lag0(series: DataFrame, key: str, period: str = "t") -> DataFrame:
    """FC-3 at lag 0 in closed form: t of β in Δy = α + β·y₋₁ (one aggregate)."""
    w = Window.partitionBy(key).orderBy(period)
    d = series.select(key, (F.col("y") - F.lag("y").over(w)).alias("dy"), F.lag("y").over(w).alias("ylag"))
    g = d.groupBy(key).agg(F.regr_slope("dy", "ylag").alias("b"), F.regr_sxx("dy", "ylag").alias("sxx"),
                           F.regr_syy("dy", "ylag").alias("syy"), F.regr_sxy("dy", "ylag").alias("sxy"),
                           F.regr_count("dy", "ylag").alias("n"))
    ssr = F.col("syy") - F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx"))
    se = F.sqrt(F.try_divide(F.try_divide(ssr, F.col("n") - 2), F.col("sxx")))
    return g.select(key, "n", F.try_divide(F.col("b"), se).alias("adf_t"))


def random_walk(series: DataFrame, key: str, period: str = "t", steps: int = 3) -> DataFrame:
    """FC-6: last value carried forward ``steps`` periods."""
    last = series.groupBy(key).agg(F.max_by("y", period).alias("forecast"), F.max(period).alias("_last"))
    return last.select(key, F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"), "forecast", "_last") \
        .select(key, "step", (F.col("_last") + F.col("step")).alias(period), "forecast")


def linear_trend(series: DataFrame, key: str, period: str = "t", steps: int = 3) -> DataFrame:
    """FC-9: least-squares line on position, ``steps`` ahead."""
    s = with_index(series, key, period)
    fit = s.groupBy(key).agg(F.regr_slope("y", "pos").alias("b"), F.regr_intercept("y", "pos").alias("a"),
                             F.max("pos").alias("_n"), F.max(period).alias("_last"))
    h = F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step")
    return fit.select(key, "a", "b", "_n", "_last", h).select(
        key, "step", (F.col("_last") + F.col("step")).alias(period),
        (F.col("a") + F.col("b") * (F.col("_n") + F.col("step"))).alias("forecast"))


def cagr_projection(series: DataFrame, key: str, period: str = "t", span: int = 3, top: int = 5) -> DataFrame:
    """FC-8: (last / value ``span`` before)^(1/span) − 1; next value; top keys by CAGR.

    Fewer than span+1 points or a non-positive base → CAGR 0.
    """
    from panelforge.operators.windows import nth_from_end
    e = nth_from_end(series, [key], period, "y", span)
    ok = (F.col("n_points") > span) & (F.col(f"value_{span}_before") > 0) & (F.col("last_value") > 0)
    cagr = F.when(ok, F.pow(F.col("last_value") / F.col(f"value_{span}_before"), 1.0 / span) - 1).otherwise(F.lit(0.0))
    out = e.select(key, "last_value", cagr.alias("cagr")).withColumn("next_value", F.col("last_value") * (1 + F.col("cagr")))
    return out.orderBy(F.col("cagr").desc(), key).limit(top)


def holdout_metrics(actual: DataFrame, forecasts: DataFrame, key: str, period: str = "t",
                    by: Sequence[str] = ("model",)) -> DataFrame:
    """FC-7 / FC-11: RMSE, MAE, MAPE of forecasts against held-out actuals (JN-10 + ML-10)."""
    j = forecasts.join(actual.select(key, period, F.col("y").alias("actual")), [key, period])
    err = F.col("forecast") - F.col("actual")
    return j.groupBy(*by).agg(F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"),
                              (F.avg(F.abs(F.try_divide(err, F.nullif(F.col("actual"), F.lit(0))))) * 100).alias("mape"),
                              F.count(F.lit(1)).alias("n"))


def split_tail(series: DataFrame, key: str, period: str = "t", test_n: int = 2) -> tuple[DataFrame, DataFrame]:
    """WIN-6 for series: (train, test) with the last ``test_n`` periods per key held out."""
    from panelforge.operators.windows import holdout_split
    s = holdout_split(series, [key], period, test_n)
    return s.filter(F.col("split") == "train").drop("split"), s.filter(F.col("split") == "test").drop("split")


def pooled_lag_regression(series: DataFrame, key: str, period: str = "t", lookback: int = 3,
                          steps: int = 3) -> DataFrame:
    """FC-10: next value from the previous ``lookback`` values scaled by the key's max, one model
    for all keys (Spark ML), rolled forward ``steps`` per key."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    from panelforge.operators.windows import lag_matrix
    mx = series.groupBy(key).agg(F.max(F.abs("y")).alias("_mx"))
    s = series.join(mx, key).withColumn("_ys", F.try_divide(F.col("y"), F.nullif(F.col("_mx"), F.lit(0))))
    lagged = lag_matrix(s, [key], period, "_ys", lookback)
    feats = [f"_ys_l{i}" for i in range(1, lookback + 1)]
    model = LinearRegression(featuresCol="_f", labelCol="_ys").fit(
        VectorAssembler(inputCols=feats, outputCol="_f").transform(lagged))
    coef = [float(c) for c in model.coefficients]
    icpt = float(model.intercept)
    kt = series.schema[key].dataType.simpleString()
    tt = series.schema[period].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(period)
        hist = list(pdf["_ys"].to_numpy(dtype=float))
        if len(hist) < lookback:  # too short for the lags: no forecast
            return pd.DataFrame({key: [], "step": [], period: [], "forecast": []})
        mxv = float(pdf["_mx"].iloc[0]) or 1.0
        out = []
        for _ in range(steps):
            nxt = icpt + sum(coef[i] * hist[-1 - i] for i in range(lookback))
            out.append(nxt)
            hist.append(nxt)
        last = pdf[period].iloc[-1]
        return pd.DataFrame({key: pdf[key].iloc[0], "step": np.arange(1, steps + 1, dtype="int32"),
                             period: [last + h for h in range(1, steps + 1)], "forecast": np.array(out) * mxv})

    return s.groupBy(key).applyInPandas(run, f"`{key}` {kt}, step int, `{period}` {tt}, forecast double")
