"""Data quality checks (DQ-1..12); every check is one or two aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions import scalar as S
from panelforge.functions.quantile import quantile_scalars
from panelforge.operators.filters import numeric_columns


def check_schema(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """DQ-1: missing expected columns and whitespace issues per string column.

    Rows: (check, column_name, n_issues).  Declared dtypes are not compared (as in the reference).
    """
    spark = df.sparkSession
    missing = [c for c in expected if c not in df.columns]
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    rows = spark.createDataFrame([("missing_column", c, 1) for c in missing],
                                 "check string, column_name string, n_issues long")
    if strings:
        ws = df.agg(*[F.sum(S.flag(S.has_edge_whitespace(c))).cast("long").alias(c) for c in strings])
        ws = ws.unpivot([], strings, "column_name", "n_issues").select(
            F.lit("whitespace").alias("check"), "column_name", "n_issues")
        rows = rows.unionByName(ws)
    return rows


def panel_gaps(df: DataFrame, key: str, period: str) -> DataFrame:
    """DQ-2 / JN-5 / SET-2: expected (key, period in min..max) pairs minus the actual pairs."""
    lo, hi = df.select(F.min(period)).scalar(), df.select(F.max(period)).scalar()
    expected = (df.select(key).distinct()
                .select(key, F.explode(F.sequence(lo, hi)).alias(period)))
    actual = df.select(key, period)
    return expected.join(actual, [key, period], "left_anti")


def count_panel_gaps(df: DataFrame, key: str, period: str) -> DataFrame:
    return panel_gaps(df, key, period).agg(F.count(F.lit(1)).alias("panel_gaps"))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ-3: exact-row duplicates and key duplicates (extra copies only), one row."""
    n = F.count(F.lit(1))
    exact = df.groupBy(*df.columns).agg(n.alias("c")).agg(F.sum(F.col("c") - 1).cast("long").alias("exact_duplicates"))
    keyd = df.groupBy(*keys).agg(n.alias("c")).agg(F.sum(F.col("c") - 1).cast("long").alias("key_duplicates"))
    return exact.select(F.coalesce("exact_duplicates", F.lit(0)).alias("exact_duplicates"),
                        F.coalesce(keyd.select("key_duplicates").scalar(), F.lit(0)).alias("key_duplicates"))


def range_violations(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """DQ-4: non-null values outside [lo, hi] per column → (column_name, n_out)."""
    cols = [c for c in bounds if c in df.columns]
    wide = df.agg(*[F.sum(S.flag(F.col(c).isNotNull() & ((F.col(c) < lo) | (F.col(c) > hi)))).cast("long").alias(c)
                    for c, (lo, hi) in ((c, bounds[c]) for c in cols)])
    return wide.unpivot([], cols, "column_name", "n_out")


def iqr_outliers(df: DataFrame, columns: Sequence[str] | None = None, k: float = 1.5) -> DataFrame:
    """DQ-5: per numeric column, count outside Q1−k·IQR..Q3+k·IQR; IQR = 0 skipped.

    Pass 1: one aggregate with every column's quartiles; pass 2: one conditional
    count per column against the scalar bounds.
    """
    cols = list(columns or numeric_columns(df))
    q = quantile_scalars(df, cols, [0.25, 0.75])  # distributed exact quartiles, one scalar struct
    exprs = []
    for c in cols:
        arr = q[c]
        q1, q3 = arr[0], arr[1]
        iqr = q3 - q1
        lo, hi = q1 - k * iqr, q3 + k * iqr
        exprs.append(F.struct(
            F.lit(c).alias("column_name"),
            F.when(iqr != 0, F.sum(S.flag((F.col(c) < lo) | (F.col(c) > hi)))).cast("long").alias("n_outliers"),
            q1.alias("q1"), q3.alias("q3")).alias(c))
    wide = df.agg(*exprs)
    return (wide.select(F.explode(F.array(*[F.col(c) for c in cols])).alias("s"))
            .select("s.*").filter(F.col("n_outliers").isNotNull()))


def flag_mismatch(df: DataFrame, flag_col: str, expected) -> DataFrame:
    """DQ-6: count of rows where a stored flag differs from its recomputed value."""
    return df.agg(F.sum(S.flag(~F.col(flag_col).eqNullSafe(expected))).cast("long").alias("flag_mismatch"))


def health_score(df: DataFrame, pass_at: float = 80.0) -> DataFrame:
    """DQ-7: 100·(1 − null cells / cells); PASS if ≥ ``pass_at``."""
    ncols = len(df.columns)
    nulls = F.lit(0).cast("long")
    for c in df.columns:
        nulls = nulls + F.sum(F.col(c).isNull().cast("long"))
    out = df.agg((F.count(F.lit(1)) * ncols).alias("total_cells"), nulls.alias("missing_cells"))
    score = 100.0 * (1.0 - F.try_divide(F.col("missing_cells"), F.col("total_cells")))
    return out.select("total_cells", "missing_cells", score.alias("health_pct"),
                      F.when(score >= pass_at, "PASS").otherwise("NEEDS CLEANING").alias("status"))


def validate_panel(df: DataFrame, key: str, period: str, period_label: str, labels: Sequence[str],
                   range_columns: Sequence[str]) -> DataFrame:
    """DQ-8: rows, distinct keys, sorted periods, rows per period label and min/max of chosen columns (one row)."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.countDistinct(key).alias("n_keys"),
                  F.sort_array(F.collect_set(period)).alias("periods"),
                  *[F.sum(S.flag(F.col(period_label) == F.lit(v))).cast("long").alias(f"n_{v}") for v in labels],
                  *[e for c in range_columns for e in (F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"))])


def flat_series(df: DataFrame, key: str, period: str, value: str, last_n: int = 4) -> DataFrame:
    """DQ-9: keys whose last ``last_n`` values (≥ last_n rows) are all equal."""
    w = Window.partitionBy(key).orderBy(F.col(period).desc())
    tail = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= last_n)
    return (tail.groupBy(key).agg(F.count(F.lit(1)).alias("n_tail"),
                                  F.countDistinct(value).alias("n_distinct"),
                                  F.max(value).alias("flat_value"))
            .filter((F.col("n_tail") == last_n) & (F.col("n_distinct") == 1))
            .select(key, "flat_value"))


def fanout(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ-10: (key…, n_rows) for key combinations seen more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def stage_trace(stages: Mapping[str, DataFrame], period: str, value: str) -> DataFrame:
    """DQ-11: per-period sums of one value, one column per stage, full outer joined."""
    out = None
    for name, df in stages.items():
        s = df.groupBy(period).agg(F.sum(value).alias(f"{name}_sum"))
        out = s if out is None else out.join(s, period, "full_outer")
    return out


def cluster_sanity(df: DataFrame, key: str, lo: int = 5, hi: int = 25,
                   placeholder: str = r"^Country_\d+$") -> DataFrame:
    """DQ-12: distinct keys within lo..hi and no placeholder names (one row)."""
    return df.agg(F.countDistinct(key).alias("n_keys"),
                  F.sum(S.flag(S.is_placeholder_name(F.col(key).cast("string"), placeholder))).cast("long")
                  .alias("n_placeholder")).withColumn(
        "status", F.when(F.col("n_keys").between(lo, hi) & (F.col("n_placeholder") == 0), "PASS").otherwise("FAIL"))
