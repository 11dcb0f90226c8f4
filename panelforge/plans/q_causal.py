"""Registered queries: causal inference on the panel (treatment = baseline-year value ≥ median)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators import causal as C
from panelforge.operators.joins import nearest_match
from panelforge.operators.missing import fill_key_median
from panelforge.plans.registry import query
from panelforge.sources.panel import SPEC, panel, with_panel
from panelforge.session import materialize

CONTROLS = ["growth_proxy", "unemp_proxy", "big_rate", "price"]

# DuckDB twin of the prepared causal panel.
CP_SQL = """
cp0 AS (SELECT *, disc * 100 AS growth_proxy, tax * 100 AS unemp_proxy FROM panel WHERE is_partial = 0),
cp1 AS (SELECT * REPLACE (coalesce(entity_growth_yoy, quantile_cont(entity_growth_yoy, 0.5) OVER (PARTITION BY k))
                          AS entity_growth_yoy) FROM cp0),
tr AS (SELECT k, CAST(max(CASE WHEN yr = 1997 THEN price END) >= (SELECT quantile_cont(price, 0.5) FROM cp1
               WHERE yr = 1997) AS INTEGER) AS treated FROM cp1 GROUP BY k),
cp AS (SELECT cp1.*, coalesce(treated, 0) AS treated, CAST(yr >= 2000 AS INTEGER) AS post FROM cp1 LEFT JOIN tr USING (k))"""


def with_cp(sql: str) -> str:
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return with_panel("WITH " + CP_SQL + ",\n" + body[5:])
    return with_panel("WITH " + CP_SQL + "\n" + body)


def causal_panel(spark, sf_dir):
    """Confirmed rows, growth filled with the key's median, treatment and period flags."""
    p = materialize(panel(spark, sf_dir).filter(F.col("is_partial") == 0))  # several passes follow
    p = p.withColumns({"growth_proxy": F.col("disc") * 100, "unemp_proxy": F.col("tax") * 100})
    p = fill_key_median(p, ["k"], ["entity_growth_yoy"])
    p = C.treat_by_baseline(p, "k", "yr", "price", SPEC.baseline_year)
    p = p.withColumns({"treated": F.coalesce("treated", F.lit(0)), "post": (F.col("yr") >= SPEC.post_start).cast("int")})
    return materialize(p)


@query("cau1_treatment_baseline", "CAU-1,JN-4", with_cp("SELECT k, treated FROM tr"))
def q_cau1(spark, sf_dir):
    p = panel(spark, sf_dir).filter(F.col("is_partial") == 0)
    return C.treat_by_baseline(p, "k", "yr", "price", SPEC.baseline_year).select("k", "treated").distinct()


@query("cau2_treatment_threshold", "CAU-2", with_panel("""
SELECT k, yr, CAST(coalesce(big_rate >= 200, false) AS INTEGER) AS treated FROM panel"""))
def q_cau2(spark, sf_dir):
    return C.treat_by_threshold(panel(spark, sf_dir), "big_rate", 200.0).select("k", "yr", "treated")


@query("cau3_did_2x2", "CAU-3,AGG-9", with_cp("""
WITH c AS (SELECT avg(CASE WHEN treated = 1 AND post = 1 THEN entity_growth_yoy END) AS t_post,
                  avg(CASE WHEN treated = 1 AND post = 0 THEN entity_growth_yoy END) AS t_pre,
                  avg(CASE WHEN treated = 0 AND post = 1 THEN entity_growth_yoy END) AS c_post,
                  avg(CASE WHEN treated = 0 AND post = 0 THEN entity_growth_yoy END) AS c_pre FROM cp)
SELECT *, (t_post - t_pre) - (c_post - c_pre) AS did FROM c"""))
def q_cau3(spark, sf_dir):
    return C.did_2x2(causal_panel(spark, sf_dir), "entity_growth_yoy", "treated", "post")


@query("cau4_did_basic_coef", "CAU-4", with_cp("""
WITH c AS (SELECT avg(CASE WHEN treated = 1 AND post = 1 THEN entity_growth_yoy END) AS tp,
                  avg(CASE WHEN treated = 1 AND post = 0 THEN entity_growth_yoy END) AS t0,
                  avg(CASE WHEN treated = 0 AND post = 1 THEN entity_growth_yoy END) AS cpost,
                  avg(CASE WHEN treated = 0 AND post = 0 THEN entity_growth_yoy END) AS c0 FROM cp)
SELECT 'const' AS term, c0 AS coef FROM c UNION ALL SELECT 'treated', t0 - c0 FROM c
UNION ALL SELECT 'post', cpost - c0 FROM c UNION ALL SELECT 'did', (tp - t0) - (cpost - c0) FROM c"""))
def q_cau4(spark, sf_dir):
    """Saturated DiD: OLS coefficients equal the cell-mean contrasts (compared exactly)."""
    res = C.did_regression(causal_panel(spark, sf_dir), "entity_growth_yoy", "treated", "post", cov="HC3")
    return res.select("term", "coef")


@query("cau4_did_basic", "CAU-4,STA-7")
def q_cau4f(spark, sf_dir):
    return C.did_regression(causal_panel(spark, sf_dir), "entity_growth_yoy", "treated", "post", cov="HC3")


@query("cau5_did_extended", "CAU-5,STA-7,STA-8")
def q_cau5(spark, sf_dir):
    return C.did_regression(causal_panel(spark, sf_dir), "entity_growth_yoy", "treated", "post",
                            controls=CONTROLS, absorb="k", cov="HC3")


@query("cau6_did_full", "CAU-6,STA-7")
def q_cau6(spark, sf_dir):
    p = causal_panel(spark, sf_dir)
    return C.did_regression(p, "entity_growth_yoy", "treated", "post", controls=CONTROLS[:3], cov="HC3",
                            extra_terms={"during": F.col("is_during"), "did_dur": F.col("treated") * F.col("is_during")})


@query("cau7_event_study", "CAU-7,SRV-5")
def q_cau7(spark, sf_dir):
    return C.event_study(causal_panel(spark, sf_dir), "entity_growth_yoy", "treated", "yr", SPEC.baseline_year,
                         controls=CONTROLS[:2])


def _propensity(spark, sf_dir):
    p = causal_panel(spark, sf_dir).filter(F.col("yr") == SPEC.baseline_year)
    return C.propensity(p, "treated", ["intensity", "big_rate", "unemp_proxy", "density"], ["k", "nation"])


@query("cau8_propensity", "CAU-8")
def q_cau8(spark, sf_dir):
    return _propensity(spark, sf_dir)


@query("cau9_matched_pairs", "CAU-9,JN-7")
def q_cau9(spark, sf_dir):
    ps = materialize(_propensity(spark, sf_dir))
    pairs = nearest_match(ps.filter(F.col("treated") == 1), ps.filter(F.col("treated") == 0), "k", "propensity")
    names = ps.select("k", "nation")
    return (pairs.join(names.withColumnsRenamed({"k": "treated_k", "nation": "treated_nation"}), "treated_k")
            .join(names.withColumnsRenamed({"k": "control_k", "nation": "control_nation"}), "control_k"))


@query("cau10_att", "CAU-10,STA-9", with_cp("""
WITH m AS (SELECT treated g, count(entity_growth_yoy) n, avg(entity_growth_yoy) mu, var_samp(entity_growth_yoy) v
           FROM cp WHERE post = 1 AND entity_growth_yoy IS NOT NULL GROUP BY 1),
a AS (SELECT * FROM m WHERE g = 1), b AS (SELECT * FROM m WHERE g = 0)
SELECT a.mu - b.mu AS att, a.mu AS treated_mean, b.mu AS control_mean,
       (a.mu - b.mu) / sqrt(((a.n - 1) * a.v + (b.n - 1) * b.v) / (a.n + b.n - 2) * (1.0 / a.n + 1.0 / b.n)) AS t_stat,
       CAST(a.n + b.n - 2 AS DOUBLE) AS dof FROM a, b"""))
def q_cau10(spark, sf_dir):
    return C.att(causal_panel(spark, sf_dir), "entity_growth_yoy", "treated", F.col("post") == 1)


@query("cau10_att_matched", "CAU-10")
def q_cau10m(spark, sf_dir):
    ps = materialize(_propensity(spark, sf_dir))
    pairs = nearest_match(ps.filter(F.col("treated") == 1), ps.filter(F.col("treated") == 0), "k", "propensity")
    post = (causal_panel(spark, sf_dir).filter(F.col("post") == 1)
            .groupBy("k").agg(F.avg("entity_growth_yoy").alias("y")))
    return C.att_matched(pairs, post, "k", "y")


@query("cau11_method_comparison", "CAU-11,SET-1,PRJ-13")
def q_cau11(spark, sf_dir):
    from panelforge.functions import dist
    from panelforge.functions import scalar as S
    p = causal_panel(spark, sf_dir)
    did = (C.did_regression(p, "entity_growth_yoy", "treated", "post", controls=CONTROLS, absorb="k")
           .filter(F.col("term") == "did").select(F.lit("DiD (extended)").alias("method"),
                                                  F.col("coef").alias("effect"), F.col("p_value")))
    a = C.att(p, "entity_growth_yoy", "treated", F.col("post") == 1)
    psm = a.select(F.lit("PSM ATT").alias("method"), F.col("att").alias("effect"),
                   dist.t_pvalue(F.col("t_stat"), F.col("dof")).alias("p_value"))
    ev = C.event_study(p, "entity_growth_yoy", "treated", "yr", SPEC.baseline_year, CONTROLS[:2])
    evs = ev.filter(F.col("yr") >= SPEC.post_start).agg(F.avg("coef").alias("effect"), F.min("p").alias("p_value")) \
        .select(F.lit("Event study (post mean)").alias("method"), "effect", "p_value")
    out = did.unionByName(psm).unionByName(evs)
    return out.withColumn("verdict", S.verdict("p_value", 0.05, "significant", "not significant"))
