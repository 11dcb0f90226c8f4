"""Writing stage tables (SNK-1..7).

Writes go to the shared folder (``spark.checkpoint.dir`` on a cluster) or to a
caller-given path; output is partitioned only when a partition column is given.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.session import scratch_path


def save_stage(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None) -> str:
    """SNK-1: overwrite a stage table (parquet by default, CSV with header)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def new_scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def replace_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """SNK-2: replace a catalog table (external, at ``path`` when given)."""
    w = df.write.mode("overwrite")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def conform(df: DataFrame, contract: T.StructType, rename: Mapping[str, str] | None = None) -> DataFrame:
    """SNK-3: rename, keep the contract columns that exist (in contract order), cast, NaN → NULL."""
    rename = dict(rename or {})
    src = df.select(*[F.col(c).alias(rename.get(c, c)) for c in df.columns])
    out = []
    for f in contract.fields:
        if f.name not in src.columns:
            continue
        c = F.col(f.name)
        if isinstance(src.schema[f.name].dataType, (T.DoubleType, T.FloatType)):
            c = F.nanvl(c, F.lit(None))
        out.append(c.cast(f.dataType).alias(f.name))
    return src.select(*out)


def store(df: DataFrame, table: str, contract: T.StructType, rename: Mapping[str, str] | None = None) -> None:
    """SNK-3: delete-and-insert load into an existing catalog table."""
    conform(df, contract, rename).write.insertInto(table, overwrite=True)


def summary_rows(one_row: DataFrame) -> DataFrame:
    """SNK-6: a one-row metrics frame as (key, value) string rows."""
    cols = one_row.columns
    return one_row.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "key", "value")
