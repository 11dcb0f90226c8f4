"""Registered queries: the serving-layer lookups (results as DataFrames, no HTTP)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators import serve as SV
from panelforge.plans.q_forecast import series, with_ser
from panelforge.operators import forecast as FC
from panelforge.plans.registry import query
from panelforge.sources.panel import panel, with_panel
from panelforge.sources.tables import read_table


@query("srv1_countries", "SRV-1,AGG-4", with_panel("""
SELECT nation, count(*) OVER () AS n_keys FROM (SELECT DISTINCT nation FROM panel WHERE nation IS NOT NULL)"""))
def q_srv1(spark, sf_dir):
    return SV.list_keys(panel(spark, sf_dir), "nation")


@query("srv2_country_data", "SRV-2,PRJ-16,FLT-4", with_panel("""
SELECT * EXCLUDE (funding_scaled) FROM (SELECT *, funding / 2 AS funding_scaled FROM panel)
WHERE lower(trim(nation)) = lower(trim('  nation_3 '))"""))
def q_srv2(spark, sf_dir):
    p = panel(spark, sf_dir).withColumn("funding_scaled", F.col("funding") / 2)
    return SV.key_history(p, "nation", "  nation_3 ", "yr")


@query("srv3_forecast_rows", "SRV-3,FC-9", with_ser("""
WITH i AS (SELECT user_id, t, y, row_number() OVER (PARTITION BY user_id ORDER BY t) AS pos FROM s),
f AS (SELECT user_id, regr_slope(y, pos) b, regr_intercept(y, pos) a, max(pos) n, max(t) lt FROM i GROUP BY user_id)
SELECT user_id, CAST(h AS INTEGER) AS step, CAST(lt + h AS INTEGER) AS t, a + b * (n + h) AS forecast, 'linear' AS model
FROM f, range(1, 4) r(h) WHERE user_id = (SELECT min(user_id) FROM s)"""))
def q_srv3(spark, sf_dir):
    s = series(spark, sf_dir)
    fc = FC.linear_trend(s, "user_id", steps=3).withColumn("model", F.lit("linear"))
    return SV.forecast_rows(fc, "user_id", s.select(F.min("user_id")).scalar(), "linear")


@query("srv3_forecast_global", "SRV-3,FC-9", with_ser("""
WITH g AS (SELECT t, sum(y) AS y FROM s GROUP BY t), i AS (SELECT t, y, row_number() OVER (ORDER BY t) AS pos FROM g),
f AS (SELECT regr_slope(y, pos) b, regr_intercept(y, pos) a, max(pos) n, max(t) lt, arg_max(y, t) AS v FROM i)
SELECT 'GLOBAL' AS user_id, CAST(h AS INTEGER) AS step, CAST(lt + h AS INTEGER) AS t, a + b * (n + h) AS forecast, 'linear' AS model
FROM f, range(1, 4) r(h)"""))
def q_srv3g(spark, sf_dir):
    """The global forecast, asked for by key and model among all keys' rows of two models."""
    g = FC.global_series(series(spark, sf_dir), "user_id")
    rows = FC.linear_trend(g, "user_id", steps=3).withColumn("model", F.lit("linear"))
    rows = rows.unionByName(FC.random_walk(g, "user_id", steps=3).withColumn("model", F.lit("walk")))
    return SV.forecast_rows(rows, "user_id", "GLOBAL", "linear")


@query("srv4_cluster_of_key", "SRV-4", """
SELECT vec_id, label AS cluster_id, 'Cluster ' || CAST(label + 1 AS VARCHAR) AS cluster_label FROM embeddings
WHERE vec_id = (SELECT min(vec_id) FROM embeddings)""")
def q_srv4k(spark, sf_dir):
    from panelforge.operators.cluster import assignments
    e = read_table(spark, sf_dir, "embeddings")
    return SV.cluster_of(assignments(e, "vec_id", "label"), "vec_id", e.select(F.min("vec_id")).scalar())


@query("srv4_clusters", "SRV-4,SNK-5", """
SELECT vec_id, label AS cluster_id, 'Cluster ' || CAST(label + 1 AS VARCHAR) AS cluster_label FROM embeddings
WHERE label = 3""")
def q_srv4(spark, sf_dir):
    from panelforge.operators.cluster import assignments
    a = assignments(read_table(spark, sf_dir, "embeddings"), "vec_id", "label")
    return SV.cluster_of(a, "cluster_id", 3)


@query("srv6_history_forecast", "SRV-6,SET-1,FC-2", with_ser("""
WITH g AS (SELECT t, sum(y) AS y FROM s GROUP BY t),
i AS (SELECT t, y, row_number() OVER (ORDER BY t) AS pos FROM g),
f AS (SELECT regr_slope(y, pos) b, regr_intercept(y, pos) a, max(pos) n, max(t) lt FROM i)
SELECT t, y AS value, 'observed' AS kind FROM g
UNION ALL SELECT CAST(lt + h AS INTEGER), a + b * (n + h), 'forecast' FROM f, range(1, 4) r(h)"""))
def q_srv6(spark, sf_dir):
    g = FC.global_series(series(spark, sf_dir), "user_id").filter(F.col("user_id") == "GLOBAL")
    fc = FC.linear_trend(g, "user_id", steps=3)
    return SV.history_with_forecast(g.select("t", "y"), fc.select("t", "forecast"), "t")
