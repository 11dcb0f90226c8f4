"""Reading stage tables (SRC-1..6).

Parquet is the default format: filters and projections reach the scan.  Reads
normalise NaN to NULL so that Spark aggregates skip missing values the way the
reference does.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.session import prepare

STAR_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")

_FLOATING = (T.DoubleType, T.FloatType)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """SRC-1: load a named stage table; optional column projection."""
    prepare(spark)
    df = spark.read.parquet(table_path(sf_dir, name))
    if columns:
        df = df.select(*columns)
    return df


def read_csv_stage(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """SRC-1 for headed CSV files; give a schema in production (no inference pass)."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return nan_to_null(reader.csv(path))


def nan_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """NaN → NULL on every floating column (or the given ones)."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, _FLOATING)]
    targets = set(columns) if columns is not None else set(floating)
    return df.select(*[
        F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)).alias(c)
        if c in targets and c in floating else F.col(c)
        for c in df.columns
    ])


def first_existing(spark: SparkSession, candidates: Sequence[str]) -> str | None:
    """SRC-2: first path that exists on the cluster file system."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for cand in candidates:
        p = jvm.org.apache.hadoop.fs.Path(cand)
        if p.getFileSystem(conf).exists(p):
            return cand
    return None


def read_first_existing(spark: SparkSession, candidates: Sequence[str]) -> DataFrame:
    path = first_existing(spark, candidates)
    if path is None:
        raise FileNotFoundError(f"none of {list(candidates)} exists")
    return spark.read.parquet(path) if path.endswith(".parquet") else read_csv_stage(spark, path)


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """SRC-3: full table read from the catalog (``SELECT * FROM t``)."""
    return spark.table(name)


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """SRC-4 helper: one (table_name, n_rows) row per table, as one union job."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def largest_table(tables: dict[str, DataFrame]) -> DataFrame:
    """SRC-4: the table with the most rows (ties → first name)."""
    return table_row_counts(tables).orderBy(F.desc("n_rows"), "table_name").limit(1)


def resolve_column(df: DataFrame, candidates: Sequence[str], forced: str | None = None,
                   substring: bool = True) -> str:
    """SRC-6: resolve a column by exact, then substring, case-insensitive match."""
    lower = {c.lower(): c for c in df.columns}
    if forced:
        if forced in df.columns:
            return forced
        if forced.lower() in lower:
            return lower[forced.lower()]
        raise KeyError(f"column {forced!r} not found; columns: {df.columns}")
    for cand in candidates:
        if cand.lower() in lower:
            return lower[cand.lower()]
    if substring:
        for cand in candidates:
            for c in df.columns:
                if cand.lower() in c.lower():
                    return c
    raise KeyError(f"none of {list(candidates)} in columns: {df.columns}")


def select_resolved(df: DataFrame, mapping: dict[str, Sequence[str]]) -> DataFrame:
    """Rename resolved columns to canonical names in one projection."""
    return df.select(*[F.col(resolve_column(df, cands)).alias(name) for name, cands in mapping.items()])


def arrays_to_rows(df: DataFrame, key: str, start_year: int | Column, arrays: Sequence[str],
                   lookups: dict[str, Column] | None = None, year_col: str = "year") -> DataFrame:
    """SRC-5: per-key arrays (position = year offset) → long rows, with scalar lookups.

    ``lookups`` maps output name → Column expression evaluated on the key row
    (e.g. ``F.element_at(map_col, F.col(key))``).
    """
    zipped = F.arrays_zip(*[F.col(a) for a in arrays])
    start = start_year if isinstance(start_year, Column) else F.lit(start_year)
    base = df.select(F.col(key), start.alias("_start"), F.posexplode(zipped).alias("_pos", "_z"),
                     *[expr.alias(name) for name, expr in (lookups or {}).items()])
    return base.select(
        F.col(key), (F.col("_start") + F.col("_pos")).cast("int").alias(year_col),
        *[F.col(f"_z.{a}").alias(a) for a in arrays],
        *list((lookups or {}).keys()))
