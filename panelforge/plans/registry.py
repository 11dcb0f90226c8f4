"""Registry of named queries: each is (spark, sf_dir) -> DataFrame plus an optional DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from panelforge.session import prepare


@dataclass
class Registered:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: tuple[str, ...]


REGISTRY: dict[str, Registered] = {}


def query(name: str, covers: tuple[str, ...] | str = (), sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with its oracle SQL."""
    if isinstance(covers, str):
        covers = tuple(c.strip() for c in covers.split(",") if c.strip())

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        REGISTRY[name] = Registered(name, run, sql, covers)
        return run
    return deco


def load_all() -> dict[str, Registered]:
    """Import every plan module (registration happens at import)."""
    from panelforge.plans import (  # noqa: F401
        q_attribution, q_causal, q_cluster, q_features, q_forecast, q_ml, q_prep, q_relational, q_serve, q_stats,
    )
    return REGISTRY
