"""Registered queries of the corpus operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm import (
    centroids, chat, codes, decontaminate, embed_join, langid, minhash, packing, pieces, quality, sharding, tokencount, toxicity, twins,
)
from panelforge.llm.common import read_table
from panelforge.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


@_register("op3_minhash_near_dedup", """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS sh
      FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 3, 1))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS d, doc_id AS c FROM documents UNION SELECT r.d, e.b FROM r JOIN e ON e.a = r.c),
m AS (SELECT d, min(c) AS c FROM r GROUP BY d)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN m ON m.d = d.doc_id
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents over 4-word shingles."""
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), width=4)


@_register("op2_balanced_label_propagation")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of equal row counts; equal texts stay together where they fit."""
    return sharding.document_shards(read_table(spark, sf_dir, "documents"), 40)


@_register("op5_epsilon_grid_order_join", """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      AND len(a.e) = len(b.e)
      WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.93),
r AS (SELECT vec_id AS d, vec_id AS c FROM embeddings UNION SELECT r.d, l.b FROM r JOIN l ON l.a = r.c),
m AS (SELECT d, min(c) AS c FROM r GROUP BY d),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, m.c AS component_id, e.vec_id = m.c AS kept
FROM embeddings e JOIN m ON m.d = e.vec_id LEFT JOIN n ON n.a = e.vec_id
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of at least 0.93 within labels."""
    return embed_join.similar_vectors(read_table(spark, sf_dir, "embeddings"), 0.93)


@_register("op6_kneser_ney_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by character models learned from the rows that are not held out."""
    return langid.identify(read_table(spark, sf_dir, "documents"))


@_register("op10_longest_match_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece lengths of all documents."""
    return tokencount.count_tokens(read_table(spark, sf_dir, "documents"), tokencount.vocabulary())


@_register("op1_weak_label_quality")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes, posterior, score and decision of every document."""
    docs = read_table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.fit(docs))


@_register("op4_template_decontamination")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents hold benchmark items, word by word or with other numbers, names and units."""
    return decontaminate.document_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@_register("op7_sentencepiece_lattice")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece counts, a hash of the ids and the round trip of every document."""
    return pieces.round_trip(read_table(spark, sf_dir, "documents"), pieces.Pieces.load())


@_register("op8_levenshtein_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of held-out documents are not read."""
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


@_register("op9_preference_format", """
WITH t AS (SELECT DISTINCT CAST(conv_id AS BIGINT) AS conv_id, coalesce(CAST(turn AS BIGINT), -1) AS turn,
                  coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
i AS (SELECT conv_id, max(turn) FILTER (WHERE role = 'assistant') AS last,
             min({'turn': turn, 'text': text}) FILTER (WHERE role = 'assistant') AS first FROM t GROUP BY conv_id),
b AS (SELECT t.*, i.last, CASE WHEN role = 'assistant' AND turn = last THEN
               CASE WHEN i.first.turn < last THEN i.first.text
                    ELSE array_to_string(string_split(text, ' ')[1:len(string_split(text, ' ')) // 2], ' ') END
             ELSE text END AS weak
      FROM t JOIN i USING (conv_id) WHERE last IS NULL OR turn <= last),
s AS (SELECT conv_id, turn, role, text, 1 AS c FROM b UNION SELECT conv_id, turn, role, weak, 0 FROM b),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id, c ORDER BY turn, role, text) - 1 AS place FROM s),
m AS (SELECT conv_id, place, role, text, max(c) AS c, max(1 - c) AS r FROM o GROUP BY ALL),
e AS (SELECT conv_id, min(place) FILTER (WHERE c <> r) AS split FROM m GROUP BY conv_id),
x AS (SELECT m.*, split IS NOT NULL AS preference, (split IS NULL OR place < split) AS shared,
             '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS rendered FROM m JOIN e USING (conv_id))
SELECT conv_id AS pair_id, CAST(place // 64 AS BIGINT) AS part, bool_or(preference) AS preference,
       count(*) FILTER (WHERE shared) AS prompt_turns,
       md5(coalesce(string_agg(rendered, '' ORDER BY place) FILTER (WHERE shared), '')) AS prompt_md5,
       md5(coalesce(string_agg(rendered, '' ORDER BY place) FILTER (WHERE NOT shared AND c = 1), '')) AS chosen_md5,
       md5(coalesce(string_agg(rendered, '' ORDER BY place) FILTER (WHERE NOT shared AND r = 1), '')) AS rejected_md5,
       CAST(coalesce(sum(length(text) + 10) FILTER (WHERE NOT shared AND c = 1 AND role = 'assistant'), 0) AS BIGINT) AS chosen_loss_chars,
       CAST(coalesce(sum(length(text) + 10) FILTER (WHERE NOT shared AND r = 1 AND role = 'assistant'), 0) AS BIGINT) AS rejected_loss_chars
FROM x GROUP BY 1, 2
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference rows of all conversations, each against itself with a weaker last reply."""
    rows = chat.preference_rows(chat.with_weaker_reply(chat.turns_of(read_table(spark, sf_dir, "conversations"))))

    def loss(spans: str) -> Column:
        return F.aggregate(F.transform(spans, lambda s: (s["end"] - s["start"]).cast("long")), F.lit(0).cast("long"),
                           lambda a, b: a + b)
    return rows.select("pair_id", "part", "preference", F.col("prompt_turns").cast("long").alias("prompt_turns"),
                       *[F.md5(F.col(c).cast("binary")).alias(f"{c}_md5") for c in ("prompt", "chosen", "rejected")],
                       loss("chosen_spans").alias("chosen_loss_chars"), loss("rejected_spans").alias("rejected_loss_chars"))


@_register("op11_geometric_drift_clustering", twins.centroids_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight clusters of all vectors after ten rounds, with exact distances."""
    return centroids.cluster(read_table(spark, sf_dir, "embeddings"))


@_register("op12_vector_best_fit_packing")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    digest = F.crc32("ids").alias("ids_crc32")
    return packing.pack(read_table(spark, sf_dir, "documents"), packing.byte_pair_file(), 2048, columns=[digest])


@_register("op13_norm_of_sum_codes", twins.codes_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors under four codebooks of 256 entries."""
    return codes.compress(read_table(spark, sf_dir, "embeddings"))
