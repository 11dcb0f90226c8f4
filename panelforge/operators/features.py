"""Outlier treatment, scaling, encoding and composite features (OUT, SCL, ENC, FEA).

Global statistics (min/max, mean/σ, percentiles) are computed in one aggregate
and attached as a scalar subquery: no join, no global window.  Per-key
statistics are a grouped aggregate joined back on the key (skew-tolerant: the
aggregate combines map-side, AQE broadcasts or splits the join).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions import scalar as S
from panelforge.functions.quantile import grouped_quantiles, median, quantile_scalars, quantiles
from panelforge.operators.joins import bounded_broadcast
from panelforge.operators.ordered import positions
from panelforge.session import materialize

#: Most levels that become columns of their own.
MAX_DENSE_LEVELS = 1_000


# ---------------------------------------------------------------- outliers
def winsorize(df: DataFrame, columns: Sequence[str], lower_pct: float = 0.01, upper_pct: float = 0.99) -> DataFrame:
    """OUT-1: clip each column to its global lower/upper percentiles."""
    q = quantile_scalars(df, columns, [lower_pct, upper_pct])
    return df.withColumns({c: F.least(F.greatest(F.col(c), q[c][0]), q[c][1]) for c in columns})


def winsorize_counts(df: DataFrame, columns: Sequence[str], lower_pct: float = 0.01,
                     upper_pct: float = 0.99) -> DataFrame:
    """OUT-1 report: values changed by clipping, per column."""
    q = quantile_scalars(df, columns, [lower_pct, upper_pct])
    wide = df.agg(*[F.sum(S.flag((F.col(c) < q[c][0]) | (F.col(c) > q[c][1]))).cast("long").alias(c)
                    for c in columns])
    return wide.unpivot([], list(columns), "column_name", "n_changed")


def iqr_bounds(df: DataFrame, keys: Sequence[str], columns: Sequence[str], k: float = 1.5,
               skew_safe: bool = True) -> DataFrame:
    """Per-key Q1/Q3 and IQR fences of each column.

    ``skew_safe`` (default): exact quartiles from distributed order statistics
    (``grouped_quantiles``), so one key holding most rows is still spread over tasks;
    otherwise one grouped ``percentile`` aggregate.
    """
    keys = list(keys)
    if skew_safe:
        b = None
        for c in columns:
            q = grouped_quantiles(df, c, [0.25, 0.75], keys).select(
                *keys, F.array("q0", "q1").alias(f"_q_{c}"))
            b = q if b is None else b.join(q, keys, "full_outer")
    else:
        b = df.groupBy(*keys).agg(*[quantiles(c, [0.25, 0.75]).alias(f"_q_{c}") for c in columns])
    exprs = []
    for c in columns:
        q1, q3 = F.col(f"_q_{c}")[0], F.col(f"_q_{c}")[1]
        iqr = q3 - q1
        exprs += [F.when(iqr != 0, q1 - k * iqr).alias(f"_lo_{c}"), F.when(iqr != 0, q3 + k * iqr).alias(f"_hi_{c}")]
    return b.select(*keys, *exprs)


def cap_outliers(df: DataFrame, keys: Sequence[str], columns: Sequence[str], k: float = 1.5) -> DataFrame:
    """OUT-2: clip to Q1−k·IQR..Q3+k·IQR within each key; IQR 0 → unchanged."""
    keys = list(keys)
    out = df.join(iqr_bounds(df, keys, columns, k), keys, "left")
    capped = {c: F.when(F.col(f"_lo_{c}").isNull(), F.col(c))
              .otherwise(F.least(F.greatest(F.col(c), F.col(f"_lo_{c}")), F.col(f"_hi_{c}")))
              for c in columns}
    return out.select(*[capped[c].alias(c) if c in capped else F.col(c) for c in df.columns])


def cap_counts(df: DataFrame, keys: Sequence[str], columns: Sequence[str], k: float = 1.5) -> DataFrame:
    """OUT-2 report: (column_name, capped_rows) per column."""
    keys = list(keys)
    out = df.join(iqr_bounds(df, keys, columns, k), keys, "left")
    wide = out.agg(*[F.sum(S.flag((F.col(c) < F.col(f"_lo_{c}")) | (F.col(c) > F.col(f"_hi_{c}"))))
                     .cast("long").alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column_name", "capped_rows")


# ---------------------------------------------------------------- scaling
def zscore(df: DataFrame, columns: Sequence[str], suffix: str = "_scaled",
           keys: Sequence[str] | None = None) -> DataFrame:
    """SCL-1: (x−μ)/σ with population σ; σ = 0 → 0; new ``*_scaled`` columns.

    Global (scalar subquery) or per key (grouped aggregate joined back).
    """
    if keys:
        keys = list(keys)
        st = df.groupBy(*keys).agg(*[e for c in columns for e in (
            F.avg(c).alias(f"_mu_{c}"), F.stddev_pop(c).alias(f"_sd_{c}"))])
        out = df.join(st, keys, "left")
        scaled = {f"{c}{suffix}": _z(F.col(c), F.col(f"_mu_{c}"), F.col(f"_sd_{c}")) for c in columns}
        return out.select(*df.columns, *[v.alias(k) for k, v in scaled.items()])
    st = df.agg(F.struct(*[F.struct(F.avg(c).alias("mu"), F.stddev_pop(c).alias("sd")).alias(c)
                           for c in columns])).scalar()
    return df.withColumns({f"{c}{suffix}": _z(F.col(c), st[c]["mu"], st[c]["sd"]) for c in columns})


def _z(x: Column, mu: Column, sd: Column) -> Column:
    return F.when(x.isNull(), None).when(sd == 0, F.lit(0.0)).otherwise((x - mu) / sd)


def scaler_params(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """SCL-1 / SCL-4: the stored scaler as rows (column_name, mean, scale, min, max)."""
    st = df.agg(*[F.struct(F.lit(c).alias("column_name"), F.avg(c).alias("mean"),
                           F.stddev_pop(c).alias("scale"), F.min(c).cast("double").alias("min"),
                           F.max(c).cast("double").alias("max")).alias(c) for c in columns])
    return st.select(F.explode(F.array(*[F.col(c) for c in columns])).alias("s")).select("s.*")


def minmax(c: str | Column, df: DataFrame, eps: float | None = None, constant_value: float = 0.5) -> Column:
    """SCL-2 / SCL-3: (x−min)/(max−min); with ``eps`` the denominator is max−min+eps,
    without it a constant column maps to ``constant_value``."""
    x = S.col(c)
    st = df.agg(F.struct(F.min(x).cast("double").alias("lo"), F.max(x).cast("double").alias("hi"))).scalar()
    lo, hi = st["lo"], st["hi"]
    if eps is not None:
        return (x - lo) / (hi - lo + F.lit(eps))
    return F.when(x.isNull(), None).when(hi == lo, F.lit(constant_value)).otherwise((x - lo) / (hi - lo))


def max_scale(c: str, df: DataFrame) -> Column:
    """SCL-4: x / max."""
    return F.try_divide(F.col(c), df.select(F.max(c)).scalar())


def unscale_minmax(c: Column, lo: Column, hi: Column) -> Column:
    """SCL-4: inverse of min-max scaling."""
    return c * (hi - lo) + lo


# ---------------------------------------------------------------- encoding
def level_index(df: DataFrame, column: str) -> DataFrame:
    """(level, level_index): the distinct non-null values in order, numbered from 0 across range partitions."""
    levels = df.select(F.col(column).alias("level")).where("level is not null").distinct()
    return positions(levels, [], "level").select("level", (F.col("_pos") - 1).alias("level_index"))


def one_hot_sparse(df: DataFrame, column: str, name: str | None = None, drop_first: bool = False) -> DataFrame:
    """ENC-1 / ENC-2 for any number of levels: a sparse vector struct(size, indices, values) per row.

    The levels never reach the driver: their index is a distributed table, joined to the rows
    (broadcast only below a counted bound; else AQE splits a hot level).  A null and, with
    ``drop_first``, the first level have no entry.
    """
    name = name or f"{column}_vector"
    index = materialize(level_index(df, column))
    first = int(drop_first)
    size = F.greatest(F.lit(0), index.agg(F.count(F.lit(1))).scalar() - first).cast("long")
    at = F.col("_level_index") - first
    held = F.coalesce(at >= 0, F.lit(False))
    vector = F.struct(size.alias("size"), F.when(held, F.array(at)).otherwise(F.array().cast("array<bigint>")).alias("indices"),
                      F.when(held, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"))
    side = bounded_broadcast(index.select(F.col("level").alias("_level"), F.col("level_index").alias("_level_index")))
    return df.join(side, F.col(column) == F.col("_level"), "left").withColumn(name, vector).drop("_level", "_level_index")


def one_hot(df: DataFrame, column: str, prefix: str | None = None, drop_first: bool = False,
            levels: Sequence | None = None, max_levels: int = MAX_DENSE_LEVELS) -> DataFrame:
    """ENC-1 / ENC-2: one 0/1 column per distinct value (sorted); optionally drop the first.

    Columns are part of the plan, so at most ``max_levels`` of them are made; a column with
    more levels is an error that names ``one_hot_sparse``.
    """
    prefix = prefix or column
    if levels is None:
        levels = [r[0] for r in df.select(column).distinct().filter(F.col(column).isNotNull())
                  .orderBy(column).limit(max_levels + 1).collect()]
    levels = list(levels)
    if len(levels) > max_levels:
        raise ValueError(f"{column} has more than {max_levels} levels: use one_hot_sparse")
    levels = levels[1:] if drop_first else levels
    return df.withColumns({f"{prefix}_{v}": (F.col(column) == F.lit(v)).cast("int") for v in levels})


# ---------------------------------------------------------------- composite features
def weighted_score(df: DataFrame, parts: Sequence[tuple[str | Column, float]] | Mapping[str, float],
                   eps: float | None = 1e-9, constant_value: float = 0.5) -> Column:
    """FEA-1..5: Σ wᵢ · minmax(xᵢ) over global min/max — all parts' extremes in one aggregate."""
    items = list(parts.items() if isinstance(parts, Mapping) else parts)
    st = df.agg(F.struct(*[F.struct(F.min(S.col(c)).cast("double").alias("lo"),
                                    F.max(S.col(c)).cast("double").alias("hi")).alias(f"p{i}")
                           for i, (c, _) in enumerate(items)])).scalar()
    out = None
    for i, (c, w) in enumerate(items):
        x, lo, hi = S.col(c), st[f"p{i}"]["lo"], st[f"p{i}"]["hi"]
        if eps is not None:
            mm = (x - lo) / (hi - lo + F.lit(eps))
        else:
            mm = F.when(x.isNull(), None).when(hi == lo, F.lit(constant_value)).otherwise((x - lo) / (hi - lo))
        term = F.lit(w) * mm
        out = term if out is None else out + term
    return out


def above_median_flag(df: DataFrame, value: str, subset: Column | None = None) -> Column:
    """FEA-8 / FEA-9: value > median of value (over all rows or a filtered subset)."""
    src = df.filter(subset) if subset is not None else df
    return S.flag(F.col(value) > quantile_scalars(src, [value], [0.5])[value][0])


def feature_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """FEA-12: mean, sample std, min, max, nulls per feature (one aggregate, long form)."""
    st = df.agg(*[F.struct(F.lit(c).alias("feature"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                           F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"),
                           F.sum(F.col(c).isNull().cast("long")).alias("n_null")).alias(c) for c in columns])
    return st.select(F.explode(F.array(*[F.col(c) for c in columns])).alias("s")).select("s.*")


def feature_list(df: DataFrame, named: Sequence[str], scaled_suffix: str = "_scaled",
                 prefixes: Sequence[str] = ("sector_", "period_")) -> list[str]:
    """FEA-11: scaled + named + one-hot columns that exist, de-duplicated, in order."""
    out: list[str] = []
    for c in df.columns:
        if c.endswith(scaled_suffix):
            out.append(c)
    out += [c for c in named if c in df.columns]
    out += [c for c in df.columns if any(c.startswith(p) for p in prefixes)]
    seen, uniq = set(), []
    for c in out:
        if c not in seen:
            seen.add(c)
            uniq.append(c)
    return uniq


# ---------------------------------------------------------------- feature stages
def create_features_g1(df: DataFrame, r: Mapping[str, str]) -> DataFrame:
    """FEA-10 (first generation, FEA-1/2/6, PRJ-6/7): seven columns in one projection.

    ``r`` maps roles → columns: count, funding, population, internet, gdp_pc, rd, growth,
    unemployment, pandemic.  Min-max here maps a constant column to 0.5 (no ε).
    """
    c = lambda k: F.col(r[k])
    internet = minmax(r["internet"], df)
    gdp_pc = minmax(r["gdp_pc"], df)
    rd_filled = F.coalesce(c("rd"), F.lit(0.0))
    rd = minmax(rd_filled, df.withColumn(r["rd"], rd_filled))
    return df.withColumns({
        "startup_density": S.safe_ratio(c("count"), F.nullif(c("population"), F.lit(0)) / 1e6),
        "funding_per_startup_mn": F.try_divide(c("funding"), F.nullif(c("count"), F.lit(0)) * 1e6),
        "innovation_score": 0.4 * internet + 0.4 * gdp_pc + 0.2 * rd,
        "digital_readiness_score": 0.6 * internet + 0.4 * gdp_pc,
        "investment_efficiency": S.safe_ratio(c("count"), F.nullif(c("funding"), F.lit(0)) / 1e9),
        "economic_momentum": S.difference(c("growth"), c("unemployment")),
        "pandemic_interaction": S.interaction(c("pandemic"), c("internet")),
    })


def engineer_features_g2(df: DataFrame, r: Mapping[str, str], key: str, period: str,
                         period_label: str = "period", pre: str = "pre", post: str = "post") -> DataFrame:
    """FEA-10 (second generation, FEA-3/4/5/7/8/9, WIN-3, PRJ-11): twelve columns.

    Roles: rd, internet, rank, gdp_pc, unicorns, funding, growth, unemployment, count_growth,
    funding_growth, gdp, count, cum_unicorns, deals.  Min-max uses max−min+1e-9.
    """
    from pyspark.sql import Window
    c = lambda k: F.col(r[k])
    mm = lambda e: minmax(e, df, eps=1e-9)
    w3 = Window.partitionBy(key).orderBy(period).rowsBetween(-2, 0)
    out = df.withColumns({
        "innovation_score": 0.40 * mm(c("rd")) + 0.35 * mm(c("internet")) + 0.25 * mm(F.lit(100) - c("rank")),
        "digital_readiness": 0.50 * mm(c("internet")) + 0.30 * mm(c("rd")) + 0.20 * mm(c("gdp_pc")),
        "investment_efficiency": F.try_divide(c("unicorns"), c("funding") / 1000 + 1e-6),
        "economic_stability": 0.60 * mm(c("growth") + 10) + 0.40 * mm(F.lit(20) - c("unemployment")),
        "startup_momentum": F.avg(c("count_growth")).over(w3),
        "funding_momentum": F.avg(c("funding_growth")).over(w3),
        "gdp_per_startup": F.try_divide(c("gdp") * 1e9, c("count") + 1),
        "unicorn_pipeline": F.try_divide(c("cum_unicorns"), c("count") + 1) * 1000,
        "funding_per_deal": F.try_divide(c("funding"), c("deals") + 1),
        "year_idx": F.col(period) - df.select(F.min(period)).scalar(),
    })
    pre_median = quantile_scalars(df.filter(F.col(period_label) == pre), [r["count_growth"]], [0.5])[r["count_growth"]][0]
    out = out.withColumn("strong_recovery",
                         S.flag((F.col(period_label) == post) & (c("count_growth") > pre_median)))
    return out.withColumn("high_innovation", above_median_flag(out, "innovation_score"))
