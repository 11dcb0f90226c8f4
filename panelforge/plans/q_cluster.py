"""Registered queries: clustering embeddings and entities."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators import cluster as CL
from panelforge.plans.registry import query
from panelforge.session import materialize
from panelforge.sources.panel import panel, with_panel
from panelforge.sources.tables import read_table

_PF = ["entity_count", "funding", "disc", "tax", "density", "entity_growth_yoy"]


def _emb(spark, sf_dir):
    return CL.vectors(read_table(spark, sf_dir, "embeddings"), "embedding")


@query("clu1_prepare_features", "CLU-1,SCL-1,MIS-6,AGG-1", with_panel("""
WITH m AS (SELECT nation, """ + ", ".join(f"coalesce(avg({c}), 0) AS {c}" for c in _PF) + """ FROM panel GROUP BY nation)
SELECT nation, """ + ", ".join(
    f"CASE WHEN stddev_pop({c}) OVER () = 0 THEN 0.0 ELSE ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () END AS {c}"
    for c in _PF) + " FROM m"))
def q_clu1(spark, sf_dir):
    p = panel(spark, sf_dir).select("nation", *_PF)
    return CL.prepare_cluster_features(p, "nation")[0]


@query("clu2_select_k", "CLU-2,CLU-3,CLU-4")
def q_clu2(spark, sf_dir):
    return CL.select_k(materialize(_emb(spark, sf_dir)), range(2, 8), restarts=20)


@query("clu3_fit_kmeans", "CLU-3,SNK-5")
def q_clu3(spark, sf_dir):
    e = materialize(_emb(spark, sf_dir))
    model, _ = CL.fit_kmeans(e, 10, restarts=50)
    return CL.assignments(model.transform(e).withColumnRenamed("prediction", "c"), "vec_id", "c")


_EMB_D = "CAST(embedding AS DOUBLE[])"


@query("clu4_silhouette_given_labels", "CLU-4", f"""
WITH e AS (SELECT vec_id, label, {_EMB_D} AS x FROM embeddings),
d AS (SELECT a.vec_id, a.label AS la, b.label AS lb, list_distance(a.x, b.x) AS dist
      FROM e a JOIN e b ON a.vec_id <> b.vec_id),
m AS (SELECT vec_id, la, lb, avg(dist) AS md FROM d GROUP BY vec_id, la, lb),
ab AS (SELECT vec_id, la, max(CASE WHEN la = lb THEN md END) AS a, min(CASE WHEN la <> lb THEN md END) AS b
       FROM m GROUP BY vec_id, la)
SELECT vec_id, la AS label, CASE WHEN a IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END AS silhouette FROM ab""")
def q_clu4(spark, sf_dir):
    return CL.silhouette(_emb(spark, sf_dir), "label", id_col="vec_id")


@query("clu4_silhouette_sq_form", "CLU-4", f"""
WITH e AS (SELECT vec_id, label, {_EMB_D} AS x FROM embeddings),
d AS (SELECT a.vec_id, a.label AS la, b.label AS lb, list_distance(a.x, b.x) * list_distance(a.x, b.x) AS dist
      FROM e a JOIN e b ON a.vec_id <> b.vec_id),
m AS (SELECT vec_id, la, lb, avg(dist) AS md FROM d GROUP BY vec_id, la, lb),
ab AS (SELECT vec_id, la, max(CASE WHEN la = lb THEN md END) AS a, min(CASE WHEN la <> lb THEN md END) AS b
       FROM m GROUP BY vec_id, la)
SELECT vec_id, la AS label, CASE WHEN a IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END AS silhouette FROM ab""")
def q_clu4b(spark, sf_dir):
    """Squared-Euclidean silhouette through per-cluster sums."""
    return CL.silhouette(_emb(spark, sf_dir), "label", metric="sqeuclidean", id_col="vec_id")


@query("clu5_pca", "CLU-5")
def q_clu5(spark, sf_dir):
    scores, ratio = CL.pca_2d(_emb(spark, sf_dir), ["vec_id", "label"])
    return scores.withColumns({"explained_1": F.lit(ratio[0]), "explained_2": F.lit(ratio[1])})


_D = list(range(64))


def _emb_dims(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"d{i}") for i in _D])


@query("clu6_profiles", "CLU-6,SCL-3,JN-3", """
WITH m AS (SELECT label, """ + ", ".join(f"avg(CAST(embedding[{i + 1}] AS DOUBLE)) AS d{i}" for i in _D) + """
           FROM embeddings GROUP BY label),
l AS (UNPIVOT m ON """ + ", ".join(f"d{i}" for i in _D) + """ INTO NAME feature VALUE mean)
SELECT label, feature, mean, (mean - min(mean) OVER (PARTITION BY feature))
       / (max(mean) OVER (PARTITION BY feature) - min(mean) OVER (PARTITION BY feature) + 1e-9) AS normalised FROM l""")
def q_clu6(spark, sf_dir):
    return CL.profiles(_emb_dims(spark, sf_dir), "label", [f"d{i}" for i in _D])


@query("clu7_name_clusters", "CLU-7", """
WITH e AS (SELECT vec_id, label, """ + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS d{i}" for i in _D) + """
           FROM embeddings),
mem AS (SELECT label, count(*) AS size FROM e GROUP BY label),
m AS (SELECT label, """ + ", ".join(f"avg(d{i}) AS d{i}" for i in _D) + """ FROM e GROUP BY label),
l AS (UNPIVOT m ON """ + ", ".join(f"d{i}" for i in _D) + """ INTO NAME feature VALUE mean),
t AS (SELECT label, arg_max(feature, (abs(mean), feature)) AS top_feature, arg_max(mean, (abs(mean), feature)) AS top_mean
      FROM l GROUP BY label)
SELECT label, vec_id, size, top_feature, top_mean FROM e JOIN mem USING (label) JOIN t USING (label)""")
def q_clu7(spark, sf_dir):
    return CL.name_clusters(_emb_dims(spark, sf_dir), "label", "vec_id", [f"d{i}" for i in _D])


@query("clu8_pre_post_by_cluster", "CLU-8,JN-3,AGG-11", with_panel("""
SELECT n_regionkey AS cluster_id, avg(CASE WHEN yr < 2000 THEN entity_growth_yoy END) AS pre_mean,
       avg(CASE WHEN yr >= 2000 THEN entity_growth_yoy END) AS post_mean
FROM panel JOIN nation ON k = n_nationkey GROUP BY n_regionkey"""))
def q_clu8(spark, sf_dir):
    assigned = read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"),
                                                          F.col("n_regionkey").alias("cluster_id"))
    return CL.pre_post_by_cluster(panel(spark, sf_dir), assigned, "k", "cluster_id", "entity_growth_yoy", "yr", 2000)


@query("clu9_bootstrap_stability", "CLU-9")
def q_clu9(spark, sf_dir):
    e = materialize(_emb(spark, sf_dir))
    draws = CL.bootstrap_stability(e, 2)
    return draws.agg(F.avg("silhouette").alias("silhouette_mean"), F.stddev_samp("silhouette").alias("silhouette_std"),
                     F.count(F.lit(1)).alias("n_draws"))


@query("clu10_cluster_sizes", "CLU-10,AGG-5", "SELECT label AS cluster_id, count(*) AS n FROM embeddings GROUP BY label")
def q_clu10(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    return CL.sizes(CL.assignments(e, "vec_id", "label"))


@query("snk5_cluster_assignments", "SNK-5", """
SELECT vec_id, label AS cluster_id, 'Cluster ' || CAST(label + 1 AS VARCHAR) AS cluster_label FROM embeddings""")
def q_snk5(spark, sf_dir):
    return CL.assignments(read_table(spark, sf_dir, "embeddings"), "vec_id", "label")
