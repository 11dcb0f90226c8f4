"""A corpus pipeline of five stages; each reads what its predecessor kept and its decisions take effect.

Every stage is (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, all but the last with the columns of ``documents``.  ``run`` writes each stage's
rows to the shared folder of ``spark.checkpoint.dir`` and reads them again for the next.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm import decontaminate, minhash, pieces, quality, toxicity
from panelforge.llm.common import read_table
from panelforge.session import prepare, scratch_path, small_batches

#: The stages train on and count over all rows they get, so no SQL expresses their results.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised quality scorer accepts."""
    small_batches(spark)
    return quality.drop_rejected(docs, quality.fit(docs))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    small_batches(spark)
    return toxicity.drop_toxic(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component over 5-word shingles at 0.8."""
    small_batches(spark)
    return minhash.drop_near_duplicates(docs, width=5, threshold=0.8)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    small_batches(spark)
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece_ids, n_pieces of every document and exact, whether the ids decode to its text."""
    small_batches(spark)
    coded = pieces.encode(docs, pieces.Pieces.load(), ["doc_id"], check=True)
    return coded.withColumn("n_pieces", F.when(F.col("piece_ids").isNull(), 0).otherwise(F.size("piece_ids")))


STAGES = [
    ("quality classifier", quality_stage),
    ("toxicity", toxicity_stage),
    ("minhash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("sentencepiece encoding and decoding", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the rows of the last."""
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    folder = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
