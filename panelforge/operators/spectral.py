"""Fourier transforms of whole series and the sums of lagged products they give.

A series of N = n1 * n2 places is transformed in two passes: n2 transforms of length n1, a turn
of each value's phase, n1 transforms of length n2.  Each short transform is one group of about
the square root of the series, so a series of any length is spread over many tasks, and all
lags together cost N log N operations.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Series of at most so many places are transformed whole, one group a series.
SHORT_SERIES = 1 << 15
_SHAPE = ["_n1", "_n2"]


def _key_types(df: DataFrame, keys: Sequence[str]) -> str:
    return "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)


def _columns(keys: Sequence[str], key: tuple, n: int, **values) -> pd.DataFrame:
    out = pd.DataFrame({k: pd.Series([v] * n, dtype=object) for k, v in zip(keys, key, strict=True)}, index=range(n))
    return out.assign(**values)


def fourier(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """X[k] = sum over t of x[t] exp(-2 pi i t k / N) per key.

    ``rows`` are (keys, _n1, _n2, _at, _re, _im) with N = _n1 * _n2 the same within a key and
    places ``_at`` from 0; missing places are zeros.  Returns the same columns, one row per k.
    """
    keys = list(keys)
    group = [*keys, *_SHAPE, "_lane"]
    types = _key_types(rows, keys) + "_n1 long, _n2 long, _lane long, _k long, _re double, _im double"

    def line(length: int):
        """One transform of a group; ``length`` says which of _n1, _n2 is its size, the lane is the other coordinate."""
        def run(key, pdf):
            n1, n2, lane = (int(v) for v in key[-3:])
            size = (n1, n2)[length]
            x = np.zeros(size, complex)
            x[pdf["_i"].to_numpy()] = pdf["_re"].to_numpy() + 1j * pdf["_im"].to_numpy()
            y = np.fft.fft(x)
            k = np.arange(size, dtype=np.int64)
            if length == 0:
                y = y * np.exp(-2j * np.pi * ((k * lane) % (n1 * n2)) / (n1 * n2))
            return _columns(group[:-3], key[:-3], size, _n1=n1, _n2=n2, _lane=lane, _k=k, _re=y.real, _im=y.imag)
        return run

    first = rows.select(*keys, *_SHAPE, (F.col("_at") % F.col("_n2")).alias("_lane"),
                        F.floor(F.col("_at") / F.col("_n2")).cast("long").alias("_i"), "_re", "_im")
    columns = first.groupBy(*group).applyInPandas(line(0), types)
    second = columns.select(*keys, *_SHAPE, F.col("_k").alias("_lane"), F.col("_lane").alias("_i"), "_re", "_im")
    lines = second.groupBy(*group).applyInPandas(line(1), types)
    return lines.select(*keys, *_SHAPE, (F.col("_lane") + F.col("_n1") * F.col("_k")).alias("_at"), "_re", "_im")


def lagged_products(series: DataFrame, keys: Sequence[str], short: int = SHORT_SERIES) -> DataFrame:
    """(keys, lag, num): sum over t of x[t] x[t + lag] for every lag from 1 to _lim.

    ``series`` is (keys, _pos from 1 without gaps, _d the value, _n places, _lim the largest lag).
    Both ways come from the power spectrum of the series padded with zeros past _n + _lim, so no
    product wraps round; series of more than ``short`` places go through ``fourier``.
    """
    keys = list(keys)
    whole = series.where((F.col("_n") <= short) & (F.col("_lim") >= 1))
    spread = series.where((F.col("_n") > short) & (F.col("_lim") >= 1))

    def transform(key, pdf):
        n, lim = int(pdf["_n"].iloc[0]), int(pdf["_lim"].iloc[0])
        x = np.zeros(n)
        x[pdf["_pos"].to_numpy() - 1] = pdf["_d"].to_numpy()
        size = 1 << int(n + lim).bit_length()
        power = np.abs(np.fft.rfft(x, size)) ** 2
        return _columns(keys, key, lim, lag=np.arange(1, lim + 1), num=np.fft.irfft(power, size)[1:lim + 1])

    few = whole.groupBy(*keys).applyInPandas(transform, _key_types(series, keys) + "lag long, num double")
    bits = (F.floor(F.log2(F.col("_n") + F.col("_lim") + 1)) + 1).cast("int")
    half = F.ceil(bits / 2)
    padded = spread.select(*keys, F.pow(F.lit(2.0), half).cast("long").alias("_n1"),
                           F.pow(F.lit(2.0), bits - half).cast("long").alias("_n2"), (F.col("_pos") - 1).alias("_at"),
                           F.col("_d").alias("_re"), F.lit(0.0).alias("_im"))
    power = fourier(padded, keys).withColumns({"_re": F.col("_re") * F.col("_re") + F.col("_im") * F.col("_im"),
                                               "_im": F.lit(0.0)})
    # the spectrum is real and even, so transforming it again and dividing by N is the way back
    back = fourier(power, keys).select(*keys, F.col("_at").alias("lag"),
                                       (F.col("_re") / (F.col("_n1") * F.col("_n2"))).alias("num"))
    from panelforge.operators.ordered import attach
    limits = spread.groupBy(*keys).agg(F.max("_lim").alias("_lim"))
    many = attach(back, limits, keys).where((F.col("lag") >= 1) & (F.col("lag") <= F.col("_lim"))).drop("_lim")
    return few.unionByName(many)
