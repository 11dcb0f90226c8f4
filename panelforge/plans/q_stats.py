"""Registered queries: statistics and hypothesis tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.functions import scalar as S
from panelforge.operators import stats as ST
from panelforge.plans.registry import query
from panelforge.sources.panel import panel, with_panel
from panelforge.sources.tables import read_table

_FEATS = ["l_quantity", "l_discount", "l_tax"]


def _li(spark, sf_dir):
    return read_table(spark, sf_dir, "lineitem")


@query("sta1_pearson", "STA-1", " UNION ALL ".join(f"""
SELECT '{f}' AS feature, corr({f}, l_extendedprice) AS r, count(*) FILTER (WHERE {f} IS NOT NULL AND l_extendedprice
       IS NOT NULL) AS n, corr({f}, l_extendedprice) * sqrt((count(*) - 2) / (1 - corr({f}, l_extendedprice) ** 2)) AS t
FROM lineitem""" for f in _FEATS))
def q_sta1(spark, sf_dir):
    return ST.pearson(_li(spark, sf_dir), "l_extendedprice", _FEATS)


@query("sta1_pearson_pvalues", "STA-1,PRJ-13")
def q_sta1p(spark, sf_dir):
    r = ST.with_p(ST.pearson(_li(spark, sf_dir), "l_extendedprice", _FEATS), "t", F.col("n") - 2)
    return r.withColumn("stars", S.stars("p_value"))


_PANEL = ["entity_count", "disc", "tax", "density", "big_deals", "volume", "price", "intensity"]


@query("sta19_significant_features", "STA-19", with_panel("""
WITH r AS (""" + " UNION ALL ".join(f"""
SELECT '{f}' AS feature, corr({f}, funding) AS r, count(*) FILTER (WHERE {f} IS NOT NULL AND funding IS NOT NULL) AS n
FROM panel""" for f in _PANEL) + """)
SELECT feature, r, n FROM r
-- the 5 % point of Student's t from the normal one, first terms of its expansion
WHERE abs(r) * sqrt((n - 2) / (1 - r * r)) > 1.959964 + (1.959964 ** 3 + 1.959964) / (4 * (n - 2))"""))
def q_sta19(spark, sf_dir):
    """Features whose correlation with funding differs from zero at 5 %."""
    tests = ST.with_p(ST.pearson(panel(spark, sf_dir), "funding", _PANEL), "t", F.col("n") - 2)
    return ST.significant(tests).select("feature", "r", "n")


def _rank_sql(col: str, src: str) -> str:
    return f"rank() OVER (ORDER BY {col}) + (count(*) OVER (PARTITION BY {col}) - 1) / 2.0"


@query("sta2_spearman", "STA-2,WIN-8", " UNION ALL ".join(f"""
SELECT '{f}' AS feature, corr(rx, ry) AS rho, count(*) AS n,
       corr(rx, ry) * sqrt((count(*) - 2) / (1 - corr(rx, ry) ** 2)) AS t
FROM (SELECT {_rank_sql('x', 'd')} AS rx, {_rank_sql('y', 'd')} AS ry
      FROM (SELECT CAST({f} AS DOUBLE) x, l_extendedprice y FROM lineitem WHERE {f} IS NOT NULL
            AND l_extendedprice IS NOT NULL) d)""" for f in ["l_quantity", "l_discount"]))
def q_sta2(spark, sf_dir):
    return ST.spearman(_li(spark, sf_dir), "l_extendedprice", ["l_quantity", "l_discount"])


_CM = ["entity_count", "funding", "disc", "tax", "density", "entity_growth_yoy"]


@query("sta3_corr_matrix", "STA-3,TOP-4", with_panel(" UNION ALL ".join(
    f"SELECT '{a}' AS var_a, '{b}' AS var_b, corr({a}, {b}) AS r FROM panel"
    for i, a in enumerate(_CM) for b in _CM[i + 1:])))
def q_sta3(spark, sf_dir):
    return ST.corr_matrix(panel(spark, sf_dir), _CM)


@query("top5_top_correlated", "TOP-5,STA-3", with_panel("""
SELECT * FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, corr({c}, entity_growth_yoy) AS r FROM panel" for c in _CM[:-1])
    + ") ORDER BY abs(r) DESC, feature LIMIT 3"))
def q_top5(spark, sf_dir):
    from panelforge.operators.topk import top_abs
    p = ST.pearson(panel(spark, sf_dir), "entity_growth_yoy", _CM[:-1]).select("feature", "r")
    return top_abs(p, "r", 3, ["feature"])


@query("sta4_linregress", "STA-4", """
SELECT l_returnflag, regr_slope(l_extendedprice, l_quantity) AS slope,
       regr_intercept(l_extendedprice, l_quantity) AS intercept, corr(l_quantity, l_extendedprice) AS r,
       regr_count(l_extendedprice, l_quantity) AS n,
       corr(l_quantity, l_extendedprice) * sqrt((regr_count(l_extendedprice, l_quantity) - 2)
         / (1 - corr(l_quantity, l_extendedprice) ** 2)) AS t
FROM lineitem GROUP BY l_returnflag""")
def q_sta4(spark, sf_dir):
    return ST.linregress(_li(spark, sf_dir), "l_extendedprice", "l_quantity", ["l_returnflag"])


@query("sta5_ols", "STA-5,TOP-4")
def q_sta5(spark, sf_dir):
    res = ST.regression(_li(spark, sf_dir), "l_extendedprice", ["l_quantity", "l_discount", "l_tax"])
    return res.orderBy(F.abs("coef").desc())


@query("sta5_ols_by_group", "STA-5")
def q_sta5g(spark, sf_dir):
    return ST.regression(_li(spark, sf_dir), "l_extendedprice", ["l_quantity", "l_discount"], by=["l_returnflag"])


@query("sta6_nested_models", "STA-6,PRJ-9")
def q_sta6(spark, sf_dir):
    p = panel(spark, sf_dir).withColumn("log_funding", S.log1p("funding"))
    a = ST.regression(p, "log_funding", ["disc", "tax", "density"]).withColumn("model", F.lit("m3"))
    b = ST.regression(p, "log_funding", ["disc", "tax", "density", "big_rate"]).withColumn("model", F.lit("m4"))
    return a.unionByName(b).select("model", "term", "coef", "r2", "adj_r2", "f_stat", "aic", "bic", "n")


@query("sta7_hc3", "STA-7")
def q_sta7(spark, sf_dir):
    return ST.regression(_li(spark, sf_dir), "l_extendedprice", ["l_quantity", "l_discount"], cov="HC3")


@query("sta8_fixed_effects", "STA-8")
def q_sta8(spark, sf_dir):
    return ST.regression(panel(spark, sf_dir), "entity_growth_yoy", ["disc", "tax", "is_post"], absorb="k",
                         cov="HC3")


_T_SQL = """
WITH m AS (SELECT l_returnflag g, count(l_extendedprice) n, avg(l_extendedprice) mu, var_samp(l_extendedprice) v
           FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_extendedprice IS NOT NULL GROUP BY 1),
a AS (SELECT * FROM m WHERE g = 'A'), b AS (SELECT * FROM m WHERE g = 'R')
SELECT (a.mu - b.mu) / sqrt(((a.n - 1) * a.v + (b.n - 1) * b.v) / (a.n + b.n - 2) * (1.0 / a.n + 1.0 / b.n)) AS t_student,
       CAST(a.n + b.n - 2 AS DOUBLE) AS df_student,
       (a.mu - b.mu) / sqrt(a.v / a.n + b.v / b.n) AS t_welch,
       (a.v / a.n + b.v / b.n) ** 2 / ((a.v / a.n) ** 2 / (a.n - 1) + (b.v / b.n) ** 2 / (b.n - 1)) AS df_welch
FROM a, b"""


@query("sta9_ttest_statistics", "STA-9,AGG-16", _T_SQL)
def q_sta9(spark, sf_dir):
    return ST.t_statistics(_li(spark, sf_dir), "l_returnflag", "l_extendedprice", "A", "R")


@query("sta9_ttest", "STA-9")
def q_sta9p(spark, sf_dir):
    return ST.ttest_ind(_li(spark, sf_dir), "l_returnflag", "l_extendedprice", "A", "R")


def _anova_sql(src: str) -> str:
    return f"""
m AS (SELECT g, count(x) n, avg(x) mu, var_samp(x) v FROM {src} WHERE x IS NOT NULL GROUP BY g),
o AS (SELECT count(*) k, sum(n) nt, sum(n * (mu - (SELECT avg(x) FROM {src} WHERE x IS NOT NULL)) ** 2) ssb,
             sum(coalesce((n - 1) * v, 0)) ssw FROM m)
SELECT k - 1 AS df_between, CAST(nt - k AS BIGINT) AS df_within, ssb, ssw, (ssb / (k - 1)) / (ssw / (nt - k)) AS f_stat
FROM o"""


@query("sta10_levene", "STA-10", """
WITH med AS (SELECT l_returnflag, quantile_cont(l_quantity, 0.5) md FROM lineitem GROUP BY 1),
z AS (SELECT l.l_returnflag g, abs(l_quantity - md) x FROM lineitem l JOIN med USING (l_returnflag)),
""" + _anova_sql("z"))
def q_sta10(spark, sf_dir):
    return ST.levene(_li(spark, sf_dir), "l_returnflag", "l_quantity")


@query("sta11_anova", "STA-11", "WITH d AS (SELECT l_linestatus || l_returnflag AS g, l_extendedprice AS x FROM lineitem),"
       + _anova_sql("d"))
def q_sta11(spark, sf_dir):
    li = _li(spark, sf_dir).withColumn("g", F.concat("l_linestatus", "l_returnflag"))
    return ST.anova_oneway(li, "g", "l_extendedprice")


@query("sta11_anova_pvalue", "STA-11,STA-10")
def q_sta11p(spark, sf_dir):
    li = _li(spark, sf_dir)
    a = ST.with_f_p(ST.anova_oneway(li, "l_returnflag", "l_extendedprice")).withColumn("test", F.lit("anova"))
    b = ST.with_f_p(ST.levene(li, "l_returnflag", "l_extendedprice")).withColumn("test", F.lit("levene"))
    return a.unionByName(b)


@query("sta12_kruskal", "STA-12,WIN-8", """
WITH d AS (SELECT l_returnflag g, l_quantity x FROM lineitem WHERE l_quantity IS NOT NULL),
r AS (SELECT g, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS r FROM d),
s AS (SELECT g, sum(r) rs, count(*) n FROM r GROUP BY g),
t AS (SELECT sum(c * c * c - c) tt FROM (SELECT count(*) c FROM d GROUP BY x)),
o AS (SELECT CAST(sum(n) AS BIGINT) nt, count(*) k, sum(rs * rs / n) s FROM s)
SELECT nt AS n_total, k, (12.0 / (nt * (nt + 1.0)) * s - 3 * (nt + 1)) / (1 - (SELECT tt FROM t) / (nt * nt * nt - nt))
       AS h_stat, k - 1 AS dof FROM o""")
def q_sta12(spark, sf_dir):
    return ST.kruskal(_li(spark, sf_dir), "l_returnflag", "l_quantity")


@query("sta13_tukey_meandiff", "STA-13,JN-8", """
WITH m AS (SELECT l_returnflag g, count(*) n, avg(l_extendedprice) mu FROM lineitem GROUP BY 1),
a AS (SELECT sum((l_extendedprice - mu) ** 2) / (count(*) - (SELECT count(*) FROM m)) mse
      FROM lineitem JOIN m ON l_returnflag = g)
SELECT x.g AS group1, y.g AS group2, y.mu - x.mu AS meandiff,
       abs(y.mu - x.mu) / sqrt((SELECT mse FROM a) / 2 * (1.0 / x.n + 1.0 / y.n)) AS q
FROM m x JOIN m y ON x.g < y.g""")
def q_sta13(spark, sf_dir):
    return ST.tukey_hsd(_li(spark, sf_dir), "l_returnflag", "l_extendedprice", with_p=False)


@query("sta13_tukey_hsd", "STA-13")
def q_sta13p(spark, sf_dir):
    p = panel(spark, sf_dir)
    return ST.tukey_hsd(p, "period", "entity_count")


@query("sta14_shapiro", "STA-14")
def q_sta14(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    a = ST.shapiro_wilk(e, "value").withColumn("column_name", F.lit("events.value"))
    b = ST.shapiro_wilk(panel(spark, sf_dir), "funding").withColumn("column_name", F.lit("panel.funding"))
    return a.unionByName(b)


@query("sta15_probplot", "STA-15,PRJ-9")
def q_sta15(spark, sf_dir):
    return ST.probplot(panel(spark, sf_dir), "funding", log1p=True)


@query("sta16_qcut", "STA-16", with_panel("""
WITH e AS (SELECT quantile_cont(funding, [0, 0.25, 0.5, 0.75, 1.0]) q FROM panel)
SELECT k, yr, CASE WHEN funding >= q[1] AND funding <= q[2] THEN 0 WHEN funding > q[2] AND funding <= q[3] THEN 1
                   WHEN funding > q[3] AND funding <= q[4] THEN 2 WHEN funding > q[4] AND funding <= q[5] THEN 3 END AS bin
FROM panel, e"""))
def q_sta16(spark, sf_dir):
    return ST.qcut(panel(spark, sf_dir), "funding", 4).select("k", "yr", "bin")


@query("sta17_fitted_residuals", "STA-17")
def q_sta17(spark, sf_dir):
    li = _li(spark, sf_dir)
    coefs = ST.regression(li, "l_extendedprice", ["l_quantity", "l_discount"])
    return ST.fitted_residuals(li, coefs, "l_extendedprice", ["l_quantity", "l_discount"], ["l_orderkey", "l_linenumber"])


@query("sta18_normal_overlay", "STA-18,AGG-14", """
WITH b AS (SELECT min(l_extendedprice) lo, max(l_extendedprice) hi, avg(l_extendedprice) mu,
                  stddev_samp(l_extendedprice) sd, count(l_extendedprice) n FROM lineitem),
x AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((l_extendedprice - lo) / ((hi - lo) / 20)), 19) END AS INTEGER)
             AS bin FROM lineitem, b WHERE l_extendedprice IS NOT NULL),
h AS (SELECT bin, count(*) n FROM x GROUP BY bin)
SELECT bin, lo + bin * ((hi - lo) / 20) AS bin_lo, lo + (bin + 1) * ((hi - lo) / 20) AS bin_hi, h.n,
       b.n * ((hi - lo) / 20) * exp(-1.0 * pow(((lo + (bin + 0.5) * ((hi - lo) / 20)) - mu) / sd, 2) / 2)
         / (sd * sqrt(2 * pi())) AS expected
FROM h, b""")
def q_sta18(spark, sf_dir):
    return ST.normal_overlay(_li(spark, sf_dir), "l_extendedprice", 20)


@query("sta20_granger", "STA-20,WIN-7")
def q_sta20(spark, sf_dir):
    return ST.granger(panel(spark, sf_dir), "k", "yr", "entity_count", "funding", 2, 5)
