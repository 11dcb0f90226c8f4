"""Arrow batches of the corpus pipeline's stages are bounded by their bytes."""


def test_no_stage_sends_large_batches(spark, monkeypatch):
    import pyarrow as pa
    import corpus_pipeline
    from pyspark.sql import functions as F
    from panelforge.session import BATCH_BYTES
    docs = spark.range(0, 400, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 10_000).alias("text"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [b.nbytes], "n": [b.num_rows]})

    class Stop(Exception):
        pass

    def stop(*args, **kwargs):
        raise Stop

    for module, name in ((corpus_pipeline.quality, "fit"), (corpus_pipeline.toxicity, "fit"), (corpus_pipeline.pieces, "encode"),
                         (corpus_pipeline.minhash, "drop_near_duplicates"), (corpus_pipeline, "read_table")):
        monkeypatch.setattr(module, name, stop)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.unset(key)
            try:
                stage(spark, docs, "")
            except Stop:
                pass
            rows = docs.mapInArrow(sizes, "bytes long, n long").collect()
            assert sum(r.n for r in rows) == 400 and max(r.bytes for r in rows) < BATCH_BYTES + 200_000
    finally:
        spark.conf.unset(key)
