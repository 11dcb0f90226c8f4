"""Serving-layer lookups (SRV-1..6): the queries behind the reference's HTTP endpoints,
returned as DataFrames (no server is part of this library)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions import scalar as S


def list_keys(df: DataFrame, key: str) -> DataFrame:
    """SRV-1: sorted distinct keys with their count."""
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    return keys.withColumn("n_keys", keys.select(F.count(F.lit(1))).scalar()).orderBy(key)


def key_history(df: DataFrame, key: str, value: str, period: str, drop_suffix: str = "_scaled") -> DataFrame:
    """SRV-2: one key's history (case/space-insensitive match), without scaled columns, by period."""
    cols = [c for c in df.columns if not c.endswith(drop_suffix)]
    return df.filter(S.norm_key(key) == S.norm_key(F.lit(value))).select(*cols).orderBy(period)


def forecast_rows(fc: DataFrame, key: str, value, model: str | None = None) -> DataFrame:
    """SRV-3: forecast rows of one key (and model)."""
    out = fc.filter(F.col(key) == F.lit(value))
    return out.filter(F.col("model") == model) if model else out


def cluster_of(assigned: DataFrame, label: str, value) -> DataFrame:
    """SRV-4: assignments of one cluster (or of one key when filtered by key)."""
    return assigned.filter(F.col(label) == F.lit(value))


def history_with_forecast(history: DataFrame, forecast: DataFrame, period: str) -> DataFrame:
    """SRV-6: observed rows unioned with forecast rows, tagged."""
    h = history.select(period, F.col(history.columns[-1]).alias("value"), F.lit("observed").alias("kind"))
    f = forecast.select(period, F.col(forecast.columns[-1]).alias("value"), F.lit("forecast").alias("kind"))
    return h.unionByName(f)
