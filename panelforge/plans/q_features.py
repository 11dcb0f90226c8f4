"""Registered queries: outlier treatment, scaling, encoding and composite features."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelforge.functions import scalar as S
from panelforge.operators import features as FE
from panelforge.plans.registry import query
from panelforge.sources.panel import panel, with_panel
from panelforge.sources.tables import read_table


def _mm(x: str, eps: bool) -> str:
    lo, hi = f"min({x}) OVER ()", f"max({x}) OVER ()"
    if eps:
        return f"(({x}) - {lo}) / ({hi} - {lo} + 1e-9)"
    return f"CASE WHEN {hi} = {lo} THEN 0.5 ELSE (({x}) - {lo}) / ({hi} - {lo}) END"


# Panel with proxy columns for the reference roles (FIXTURES.md mapping).
PP_SQL = """pp AS (SELECT *, tax * 1000 AS rank_proxy, disc * 100 AS growth_proxy, tax * 100 AS unemp_proxy,
  CAST(sum(big_deals) OVER (PARTITION BY k ORDER BY yr ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
    AS cum_big FROM panel)"""


def proxied_panel(spark, sf_dir):
    p = panel(spark, sf_dir)
    w = Window.partitionBy("k").orderBy("yr").rowsBetween(Window.unboundedPreceding, 0)
    return p.withColumns({"rank_proxy": F.col("tax") * 1000, "growth_proxy": F.col("disc") * 100,
                          "unemp_proxy": F.col("tax") * 100, "cum_big": F.sum("big_deals").over(w)})


G1_ROLES = {"count": "entity_count", "funding": "funding", "population": "volume", "internet": "price",
            "gdp_pc": "intensity", "rd": "big_rate", "growth": "growth_proxy", "unemployment": "unemp_proxy",
            "pandemic": "is_post"}
G2_ROLES = {"rd": "big_rate", "internet": "price", "rank": "rank_proxy", "gdp_pc": "intensity",
            "unicorns": "big_deals", "funding": "funding", "growth": "growth_proxy", "unemployment": "unemp_proxy",
            "count_growth": "entity_growth_yoy", "funding_growth": "funding_growth_yoy", "gdp": "price",
            "count": "entity_count", "cum_unicorns": "cum_big", "deals": "deals"}


# ------------------------------------------------------------------ outliers
@query("out1_winsorize", "OUT-1", """
WITH q AS (SELECT quantile_cont(l_extendedprice, 0.01) lo1, quantile_cont(l_extendedprice, 0.99) hi1,
                  quantile_cont(l_quantity, 0.01) lo2, quantile_cont(l_quantity, 0.99) hi2 FROM lineitem)
SELECT l_orderkey, l_linenumber, least(greatest(l_extendedprice, lo1), hi1) AS l_extendedprice,
       least(greatest(l_quantity, lo2), hi2) AS l_quantity FROM lineitem, q""")
def q_out1(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return FE.winsorize(li, ["l_extendedprice", "l_quantity"])


@query("out1_winsorize_counts", "OUT-1", """
WITH q AS (SELECT quantile_cont(l_extendedprice, 0.01) lo1, quantile_cont(l_extendedprice, 0.99) hi1,
                  quantile_cont(l_quantity, 0.01) lo2, quantile_cont(l_quantity, 0.99) hi2 FROM lineitem)
SELECT 'l_extendedprice' AS column_name,
       CAST(sum(CASE WHEN l_extendedprice < lo1 OR l_extendedprice > hi1 THEN 1 ELSE 0 END) AS BIGINT) AS n_changed
FROM lineitem, q
UNION ALL SELECT 'l_quantity', CAST(sum(CASE WHEN l_quantity < lo2 OR l_quantity > hi2 THEN 1 ELSE 0 END) AS BIGINT)
FROM lineitem, q""")
def q_out1c(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return FE.winsorize_counts(li, ["l_extendedprice", "l_quantity"])


_CAP_SQL_BOUNDS = """
b AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) q1, quantile_cont(l_extendedprice, 0.75) q3
      FROM lineitem GROUP BY l_returnflag),
f AS (SELECT l_returnflag, CASE WHEN q3 <> q1 THEN q1 - 1.5 * (q3 - q1) END AS lo,
             CASE WHEN q3 <> q1 THEN q3 + 1.5 * (q3 - q1) END AS hi FROM b)"""


@query("out2_cap_outliers", "OUT-2", "WITH " + _CAP_SQL_BOUNDS + """
SELECT l_orderkey, l_linenumber, l.l_returnflag,
       CASE WHEN lo IS NULL THEN l_extendedprice ELSE least(greatest(l_extendedprice, lo), hi) END AS l_extendedprice
FROM lineitem l LEFT JOIN f USING (l_returnflag)""")
def q_out2(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    return FE.cap_outliers(li, ["l_returnflag"], ["l_extendedprice"])


@query("out2_cap_counts", "OUT-2", "WITH " + _CAP_SQL_BOUNDS + """
SELECT 'l_extendedprice' AS column_name,
       CAST(sum(CASE WHEN l_extendedprice < lo OR l_extendedprice > hi THEN 1 ELSE 0 END) AS BIGINT) AS capped_rows
FROM lineitem LEFT JOIN f USING (l_returnflag)""")
def q_out2c(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return FE.cap_counts(li, ["l_returnflag"], ["l_extendedprice"])


# ------------------------------------------------------------------ scaling
@query("scl1_zscore", "SCL-1", with_panel("""
SELECT k, yr, CASE WHEN stddev_pop(funding) OVER () = 0 THEN 0.0
                   ELSE (funding - avg(funding) OVER ()) / stddev_pop(funding) OVER () END AS funding_scaled,
       CASE WHEN stddev_pop(entity_growth_yoy) OVER () = 0 THEN 0.0
            ELSE (entity_growth_yoy - avg(entity_growth_yoy) OVER ()) / stddev_pop(entity_growth_yoy) OVER () END
         AS entity_growth_yoy_scaled FROM panel"""))
def q_scl1(spark, sf_dir):
    p = panel(spark, sf_dir).select("k", "yr", "funding", "entity_growth_yoy")
    return FE.zscore(p, ["funding", "entity_growth_yoy"]).select("k", "yr", "funding_scaled",
                                                                 "entity_growth_yoy_scaled")


@query("scl1_zscore_by_key", "SCL-1", """
SELECT l_orderkey, l_linenumber,
  CASE WHEN stddev_pop(l_extendedprice) OVER w = 0 THEN 0.0
       ELSE (l_extendedprice - avg(l_extendedprice) OVER w) / stddev_pop(l_extendedprice) OVER w END
    AS l_extendedprice_scaled
FROM lineitem WINDOW w AS (PARTITION BY l_returnflag)""")
def q_scl1k(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    return FE.zscore(li, ["l_extendedprice"], keys=["l_returnflag"]).select(
        "l_orderkey", "l_linenumber", "l_extendedprice_scaled")


@query("scl2_minmax", "SCL-2", f"""
SELECT event_id, {_mm('value', False)} AS value_mm, {_mm('user_id', False)} AS user_mm FROM events""")
def q_scl2(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    return e.select("event_id", FE.minmax("value", e).alias("value_mm"), FE.minmax("user_id", e).alias("user_mm"))


@query("scl3_minmax_eps", "SCL-3", f"SELECT event_id, {_mm('value', True)} AS value_mm FROM events")
def q_scl3(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    return e.select("event_id", FE.minmax("value", e, eps=1e-9).alias("value_mm"))


@query("scl4_scaler_roundtrip", "SCL-4", """
SELECT event_id, value / (SELECT max(value) FROM events) AS value_max_scaled,
  ((value - (SELECT min(value) FROM events)) / ((SELECT max(value) FROM events) - (SELECT min(value) FROM events)))
    * ((SELECT max(value) FROM events) - (SELECT min(value) FROM events)) + (SELECT min(value) FROM events) AS value_back
FROM events""")
def q_scl4(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    st = FE.scaler_params(e, ["value"]).select(F.struct("min", "max")).scalar()
    scaled = (F.col("value") - st["min"]) / (st["max"] - st["min"])
    return e.select("event_id", FE.max_scale("value", e).alias("value_max_scaled"),
                    FE.unscale_minmax(scaled, st["min"], st["max"]).alias("value_back"))


@query("scl4_scaler_params", "SCL-1,SCL-4", """
SELECT 'value' AS column_name, avg(value) AS mean, stddev_pop(value) AS scale, min(value) AS min, max(value) AS max
FROM events UNION ALL
SELECT 'user_id', avg(user_id), stddev_pop(user_id), CAST(min(user_id) AS DOUBLE), CAST(max(user_id) AS DOUBLE)
FROM events""")
def q_scl4p(spark, sf_dir):
    return FE.scaler_params(read_table(spark, sf_dir, "events"), ["value", "user_id"])


# ------------------------------------------------------------------ encoding
@query("enc1_one_hot", "ENC-1", """
SELECT o_orderkey, """ + ", ".join(
    f"CAST(o_orderpriority = '{v}' AS INTEGER) AS \"prio_{v}\""
    for v in ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]) + " FROM orders")
def q_enc1(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return FE.one_hot(o, "o_orderpriority", "prio").drop("o_orderpriority")


@query("enc2_one_hot_drop_first", "ENC-2", """
SELECT event_id, """ + ", ".join(
    f"CAST(event_type = '{v}' AS INTEGER) AS \"event_type_{v}\"" for v in ["error", "purchase", "signup", "view"])
    + " FROM events")
def q_enc2(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select("event_id", "event_type")
    return FE.one_hot(e, "event_type", drop_first=True).drop("event_type")


@query("enc1_sparse", "ENC-1,ENC-2", """
WITH x AS (SELECT user_id, dense_rank() OVER (ORDER BY user_id) - 1 AS i FROM (SELECT DISTINCT user_id FROM events))
SELECT event_id, (SELECT count(*) FROM x) AS size, i AS "index", i - 1 AS index_drop_first
FROM events LEFT JOIN x USING (user_id)""")
def q_enc_sparse(spark, sf_dir):
    """One level per user: vectors instead of columns, with all levels and with the first dropped (-1: no entry)."""
    e = read_table(spark, sf_dir, "events").select("event_id", "user_id")
    v = FE.one_hot_sparse(FE.one_hot_sparse(e, "user_id", "v"), "user_id", "w", drop_first=True)
    entry = F.get("w.indices", F.lit(0))
    return v.select("event_id", F.col("v.size").alias("size"), F.get("v.indices", F.lit(0)).alias("index"),
                    F.when(F.col("user_id").isNotNull(), F.coalesce(entry, F.lit(-1))).alias("index_drop_first"))


# ------------------------------------------------------------------ composite features
G1_SQL = with_panel(f"""
WITH {PP_SQL}
SELECT k, yr,
  entity_count / (nullif(volume, 0) / 1e6) AS startup_density,
  funding / (nullif(entity_count, 0) * 1e6) AS funding_per_startup_mn,
  0.4 * {_mm('price', False)} + 0.4 * {_mm('intensity', False)} + 0.2 * {_mm('coalesce(big_rate, 0.0)', False)}
    AS innovation_score,
  0.6 * {_mm('price', False)} + 0.4 * {_mm('intensity', False)} AS digital_readiness_score,
  entity_count / (nullif(funding, 0) / 1e9) AS investment_efficiency,
  growth_proxy - unemp_proxy AS economic_momentum,
  is_post * price AS pandemic_interaction
FROM pp""")


@query("fea_g1_features", "FEA-1,FEA-2,FEA-6,FEA-10,SCL-2,PRJ-4,PRJ-6,PRJ-7", G1_SQL)
def q_fea_g1(spark, sf_dir):
    out = FE.create_features_g1(proxied_panel(spark, sf_dir), G1_ROLES)
    return out.select("k", "yr", "startup_density", "funding_per_startup_mn", "innovation_score",
                      "digital_readiness_score", "investment_efficiency", "economic_momentum", "pandemic_interaction")


@query("fea_g1_rounded", "FEA-1,FEA-2,FEA-6", f"""
SELECT k, yr, round(innovation_score, 4) AS innovation_score, round(digital_readiness_score, 4) AS digital_readiness_score,
       round(investment_efficiency, 4) AS investment_efficiency FROM ({G1_SQL})""")
def q_fea_g1_rounded(spark, sf_dir):
    """The first group's scores as they are stored, with four digits."""
    cols = ["innovation_score", "digital_readiness_score", "investment_efficiency"]
    return S.rounded(q_fea_g1(spark, sf_dir).select("k", "yr", *cols), dict.fromkeys(cols, 4))


@query("prj3_rounded_ratio", "PRJ-3", with_panel("""
SELECT k, yr, round(funding / nullif(entity_count, 0), 4) AS funding_per_entity, round(entity_growth_yoy, 2) AS entity_growth_yoy
FROM panel"""))
def q_prj3_rounded(spark, sf_dir):
    p = panel(spark, sf_dir).select("k", "yr", F.try_divide("funding", F.nullif("entity_count", F.lit(0))).alias("funding_per_entity"),
                                    "entity_growth_yoy")
    return S.rounded(p, {"funding_per_entity": 4, "entity_growth_yoy": 2})


G2_SQL = with_panel(f"""
WITH {PP_SQL},
f AS (SELECT k, yr, period, entity_growth_yoy,
  0.40 * {_mm('big_rate', True)} + 0.35 * {_mm('price', True)} + 0.25 * {_mm('100 - rank_proxy', True)}
    AS innovation_score,
  0.50 * {_mm('price', True)} + 0.30 * {_mm('big_rate', True)} + 0.20 * {_mm('intensity', True)} AS digital_readiness,
  big_deals / (funding / 1000 + 1e-6) AS investment_efficiency,
  0.60 * {_mm('growth_proxy + 10', True)} + 0.40 * {_mm('20 - unemp_proxy', True)} AS economic_stability,
  avg(entity_growth_yoy) OVER (PARTITION BY k ORDER BY yr ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS startup_momentum,
  avg(funding_growth_yoy) OVER (PARTITION BY k ORDER BY yr ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS funding_momentum,
  price * 1e9 / (entity_count + 1) AS gdp_per_startup,
  cum_big / (entity_count + 1) * 1000 AS unicorn_pipeline,
  funding / (deals + 1) AS funding_per_deal,
  yr - min(yr) OVER () AS year_idx FROM pp)
SELECT k, yr, innovation_score, digital_readiness, investment_efficiency, economic_stability, startup_momentum,
  funding_momentum, gdp_per_startup, unicorn_pipeline, funding_per_deal, year_idx,
  coalesce(CAST(period = 'post' AND entity_growth_yoy >
    (SELECT quantile_cont(entity_growth_yoy, 0.5) FROM pp WHERE period = 'pre') AS INTEGER), 0) AS strong_recovery,
  coalesce(CAST(innovation_score > (SELECT quantile_cont(innovation_score, 0.5) FROM f) AS INTEGER), 0)
    AS high_innovation
FROM f""")


@query("fea_g2_features", "FEA-3,FEA-4,FEA-5,FEA-7,FEA-8,FEA-9,FEA-10,SCL-3,PRJ-5,PRJ-11,WIN-3", G2_SQL)
def q_fea_g2(spark, sf_dir):
    out = FE.engineer_features_g2(proxied_panel(spark, sf_dir), G2_ROLES, "k", "yr")
    return out.select("k", "yr", "innovation_score", "digital_readiness", "investment_efficiency",
                      "economic_stability", "startup_momentum", "funding_momentum", "gdp_per_startup",
                      "unicorn_pipeline", "funding_per_deal", "year_idx", "strong_recovery", "high_innovation")


_LISTED = ["funding_scaled", "disc_scaled", "density", "intensity", "period", "period_during", "period_post",
           "period_pre"]


@query("fea11_feature_list", "FEA-11", with_panel(" UNION ALL ".join(
    f"SELECT {i} AS position, '{n}' AS feature, count({n.removesuffix('_scaled').split('_')[0]}) AS n_values FROM panel"
    for i, n in enumerate(_LISTED))))
def q_fea11(spark, sf_dir):
    """The list with the number of rows that have a value, from one aggregate over the frame."""
    p = FE.zscore(proxied_panel(spark, sf_dir), ["funding", "disc"])
    p = FE.one_hot(p, "period", "period")
    names = FE.feature_list(p, ["density", "intensity", "period"])
    counts = p.agg(*[F.struct(F.lit(i).alias("position"), F.lit(n).alias("feature"), F.count(n).alias("n_values")).alias(f"f{i}")
                     for i, n in enumerate(names)])
    return counts.select(F.inline(F.array(*counts.columns)))


@query("fea12_feature_summary", "FEA-12", with_panel(" UNION ALL ".join(f"""
SELECT '{c}' AS feature, avg({c}) AS mean, stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min,
       CAST(max({c}) AS DOUBLE) AS max, count(*) - count({c}) AS n_null FROM panel"""
    for c in ["entity_growth_yoy", "funding", "density", "big_deals"])))
def q_fea12(spark, sf_dir):
    return FE.feature_summary(panel(spark, sf_dir), ["entity_growth_yoy", "funding", "density", "big_deals"])
