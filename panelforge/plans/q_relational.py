"""Registered queries: joins, aggregates, windows, top-k, set ops and reshaping."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelforge.functions import scalar as S
from panelforge.operators import aggs, joins, reshape, topk, windows
from panelforge.operators.features import weighted_score
from panelforge.plans.registry import query
from panelforge.sources.panel import SPEC, demand_source, panel, supply_source, with_panel
from panelforge.sources.tables import read_table

YEARS = list(range(1995, 2002))  # fixture years (FIXTURES.md)


def _yr_cols(expr_fmt: str) -> str:
    return ", ".join(expr_fmt.format(y=y) for y in YEARS)


# ------------------------------------------------------------------ flagship
FLAGSHIP_SQL = with_panel("""
WITH f AS (
  SELECT *,
    avg(entity_growth_yoy) OVER (PARTITION BY k ORDER BY yr ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS momentum,
    0.40 * (big_rate - (SELECT min(big_rate) FROM panel))
         / ((SELECT max(big_rate) FROM panel) - (SELECT min(big_rate) FROM panel) + 1e-9)
  + 0.35 * (price - (SELECT min(price) FROM panel))
         / ((SELECT max(price) FROM panel) - (SELECT min(price) FROM panel) + 1e-9)
  + 0.25 * ((100 - tax * 1000) - (SELECT min(100 - tax * 1000) FROM panel))
         / ((SELECT max(100 - tax * 1000) FROM panel) - (SELECT min(100 - tax * 1000) FROM panel) + 1e-9) AS score
  FROM panel),
g AS (
  SELECT k, nation, avg(entity_growth_yoy) AS mean_growth, arg_max(momentum, yr) AS latest_momentum,
         avg(score) AS mean_score
  FROM f GROUP BY k, nation)
SELECT *, CAST(row_number() OVER (ORDER BY mean_growth DESC, k) AS INTEGER) AS rank
FROM g WHERE mean_growth IS NOT NULL ORDER BY mean_growth DESC, k LIMIT 5
""")


def flagship(spark, sf_dir, top_n: int = 5):
    """Which entities grew fastest, with their latest momentum and mean composite score."""
    p = panel(spark, sf_dir)
    w = Window.partitionBy(SPEC.key).orderBy(SPEC.period).rowsBetween(-2, 0)
    f = p.withColumns({
        "momentum": F.avg("entity_growth_yoy").over(w),
        "score": weighted_score(p, [("big_rate", 0.40), ("price", 0.35), (F.lit(100) - F.col("tax") * 1000, 0.25)]),
    })
    g = (f.groupBy(SPEC.key, SPEC.name)
         .agg(F.avg("entity_growth_yoy").alias("mean_growth"),
              F.max_by("momentum", SPEC.period).alias("latest_momentum"),
              F.avg("score").alias("mean_score")))
    best = (g.filter(F.col("mean_growth").isNotNull())
            .orderBy(F.col("mean_growth").desc(), SPEC.key).limit(top_n))
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.col("mean_growth").desc(), SPEC.key)))


query("flagship_top_growth", "TOP-6,WIN-3,WIN-9,FEA-3,SCL-3,JN-1,WIN-2", FLAGSHIP_SQL)(flagship)


@query("top6_recommend", "TOP-6", with_panel("""
SELECT nation, avg(entity_growth_yoy) AS mean_growth,
       CAST(row_number() OVER (ORDER BY avg(entity_growth_yoy) DESC, nation) AS INTEGER) AS rank
FROM panel GROUP BY nation HAVING avg(entity_growth_yoy) IS NOT NULL
ORDER BY mean_growth DESC, nation LIMIT 10"""))
def q_top6(spark, sf_dir):
    return topk.recommend(panel(spark, sf_dir), "nation", "entity_growth_yoy", 10)


# ------------------------------------------------------------------ joins
@query("jn1_merge_panel", "JN-1,PRJ-1,PRJ-2,PRJ-3,WIN-1,WIN-2", with_panel("SELECT * FROM panel"))
def q_jn1(spark, sf_dir):
    return panel(spark, sf_dir)


@query("jn2_left_normalised", "JN-2,PRJ-16", with_panel("""
, lab AS (SELECT '  ' || upper(n_name) || ' ' AS label_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
          WHERE n_nationkey % 3 <> 0)
SELECT p.k, p.yr, p.nation, l.r_name FROM panel p LEFT JOIN lab l ON lower(trim(p.nation)) = lower(trim(l.label_name))
""".replace("\n, lab", "\nWITH lab", 1)))
def q_jn2(spark, sf_dir):
    p = panel(spark, sf_dir).select("k", "yr", "nation")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    lab = (nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
           .filter(F.col("n_nationkey") % 3 != 0)
           .select(F.concat(F.lit("  "), F.upper("n_name"), F.lit(" ")).alias("label_name"), "r_name"))
    return joins.left_on_normalised(p, "nation", lab, "label_name")


@query("jn3_lookup", "JN-3", with_panel("""
SELECT p.k, p.yr, r_name, p.entity_growth_yoy
FROM panel p JOIN (SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
                   WHERE r_regionkey <> 4) d ON p.k = d.n_nationkey"""))
def q_jn3(spark, sf_dir):
    p = panel(spark, sf_dir).select("k", "yr", "entity_growth_yoy")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region").filter(F.col("r_regionkey") != 4)
    dim = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("n_nationkey").alias("k"), "r_name")
    return joins.lookup(p, "k", dim).select("k", "yr", "r_name", "entity_growth_yoy")


@query("jn4_semi", "JN-4,CAU-1", with_panel("""
SELECT k, yr, funding FROM panel
WHERE k IN (SELECT k FROM panel WHERE yr = 1997
            AND funding >= (SELECT quantile_cont(funding, 0.5) FROM panel WHERE yr = 1997))"""))
def q_jn4(spark, sf_dir):
    p = panel(spark, sf_dir)
    base = p.filter(F.col("yr") == SPEC.baseline_year)
    med = base.select(F.percentile("funding", F.lit(0.5))).scalar()
    keys = base.filter(F.col("funding") >= med).select("k")
    return joins.semi(p.select("k", "yr", "funding"), keys, ["k"])


@query("jn5_anti_gaps", "JN-5,DQ-2,SET-2", """
WITH cy AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS yr FROM orders),
b AS (SELECT min(yr) lo, max(yr) hi FROM cy),
expct AS (SELECT c.o_custkey, y.yr FROM (SELECT DISTINCT o_custkey FROM cy) c,
          (SELECT CAST(unnest(range(lo, hi + 1)) AS INTEGER) AS yr FROM b) y)
SELECT * FROM expct e WHERE NOT EXISTS (SELECT 1 FROM cy WHERE cy.o_custkey = e.o_custkey AND cy.yr = e.yr)""")
def q_jn5(spark, sf_dir):
    from panelforge.operators.quality import panel_gaps
    o = read_table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("yr"))
    return panel_gaps(o, "o_custkey", "yr")


@query("jn6_align_pre_post", "JN-6,AGG-11", with_panel("""
SELECT * FROM (
  SELECT nation, avg(CASE WHEN period = 'pre' THEN funding_growth_yoy END) AS pre_mean,
         avg(CASE WHEN period = 'post' THEN funding_growth_yoy END) AS post_mean
  FROM panel GROUP BY nation) WHERE pre_mean IS NOT NULL AND post_mean IS NOT NULL"""))
def q_jn6(spark, sf_dir):
    p = panel(spark, sf_dir)
    pre = p.filter(F.col("period") == "pre").groupBy("nation").agg(F.avg("funding_growth_yoy").alias("pre_mean"))
    post = p.filter(F.col("period") == "post").groupBy("nation").agg(F.avg("funding_growth_yoy").alias("post_mean"))
    return joins.align_both(pre, post, "nation", ("pre_mean", "post_mean"))


JN7_SQL = """
WITH t AS (SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'),
c AS (SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING'),
pairs AS (SELECT t.c_custkey AS tid, t.c_acctbal AS ts, c.c_custkey AS cid, c.c_acctbal AS cs,
                 abs(t.c_acctbal - c.c_acctbal) AS d FROM t, c)
SELECT tid AS treated_c_custkey, ts AS treated_score, arg_min(cid, (d, cid)) AS control_c_custkey,
       arg_min(cs, (d, cid)) AS control_score, min(d) AS score_diff
FROM pairs GROUP BY tid, ts"""


@query("jn7_nearest_match", "JN-7,CAU-9", JN7_SQL)
def q_jn7(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    t = c.filter(F.col("c_mktsegment") == "BUILDING")
    ctl = c.filter(F.col("c_mktsegment") != "BUILDING")
    return joins.nearest_match(t, ctl, "c_custkey", "c_acctbal")


@query("jn8_group_pairs", "JN-8", """
WITH g AS (SELECT l_returnflag AS g, avg(l_extendedprice) AS m, count(*) AS n FROM lineitem GROUP BY 1)
SELECT a.g AS g_1, b.g AS g_2, a.m AS m_1, b.m AS m_2, a.n AS n_1, b.n AS n_2, b.m - a.m AS meandiff
FROM g a JOIN g b ON a.g < b.g""")
def q_jn8(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    st = li.groupBy(F.col("l_returnflag").alias("g")).agg(F.avg("l_extendedprice").alias("m"),
                                                          F.count(F.lit(1)).alias("n"))
    return joins.group_pairs(st, "g").withColumn("meandiff", F.col("m_2") - F.col("m_1"))


@query("jn10_align_predictions", "JN-10", with_panel("""
SELECT a.k, a.yr, a.funding AS actual, p.predicted FROM panel a
LEFT JOIN (SELECT k, yr + 1 AS yr, funding AS predicted FROM panel WHERE yr >= 1999) p ON a.k = p.k AND a.yr = p.yr
WHERE a.yr >= 2000"""))
def q_jn10(spark, sf_dir):
    p = panel(spark, sf_dir)
    actual = p.filter(F.col("yr") >= 2000).select("k", "yr", F.col("funding").alias("actual"))
    pred = p.filter(F.col("yr") >= 1999).select("k", (F.col("yr") + 1).alias("yr"), F.col("funding").alias("predicted"))
    return joins.align_predictions(actual, pred, ["k", "yr"])


# ------------------------------------------------------------------ aggregates
@query("agg1_grouped", "AGG-1", """
SELECT l_returnflag, l_linestatus, avg(l_quantity) AS mean_qty, sum(l_extendedprice) AS sum_price,
       count(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def q_agg1(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return aggs.grouped(li, ["l_returnflag", "l_linestatus"],
                        {"mean_qty": ("mean", "l_quantity"), "sum_price": ("sum", "l_extendedprice"),
                         "n": ("count", "l_orderkey")})


@query("agg2_period_table", "AGG-2", with_panel("""
SELECT period, avg(entity_count) AS mean_entities, avg(funding) AS mean_funding, avg(deals) AS mean_deals,
       avg(disc) AS mean_disc, CAST(sum(big_deals) AS BIGINT) AS total_big_deals
FROM panel GROUP BY period"""))
def q_agg2(spark, sf_dir):
    p = panel(spark, sf_dir)
    out = aggs.grouped(p, ["period"], {"mean_entities": ("mean", "entity_count"), "mean_funding": ("mean", "funding"),
                                       "mean_deals": ("mean", "deals"), "mean_disc": ("mean", "disc"),
                                       "total_big_deals": ("sum", "big_deals")})
    return aggs.ordered_labels(out, "period", ["pre", "during", "post"]).orderBy("_ord").drop("_ord")


@query("agg3_mean_sem", "AGG-3", """
SELECT l_returnflag, avg(l_extendedprice) AS mean, stddev_samp(l_extendedprice) / sqrt(count(l_extendedprice)) AS sem,
       1.96 * stddev_samp(l_extendedprice) / sqrt(count(l_extendedprice)) AS ci95, count(l_extendedprice) AS n
FROM lineitem GROUP BY l_returnflag""")
def q_agg3(spark, sf_dir):
    return aggs.mean_sem(read_table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice")


@query("agg4_distinct", "AGG-4", """
SELECT count(DISTINCT o_custkey) AS n_o_custkey, count(DISTINCT CAST(year(o_orderdate) AS INTEGER)) AS n_yr,
       count(DISTINCT o_orderpriority) AS n_o_orderpriority FROM orders""")
def q_agg4(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").withColumn("yr", F.year("o_orderdate"))
    return aggs.distinct_counts(o, ["o_custkey", "yr", "o_orderpriority"])


@query("agg5_value_counts", "AGG-5,CLU-10", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def q_agg5(spark, sf_dir):
    return aggs.value_counts(read_table(spark, sf_dir, "events"), "event_type")


@query("agg6_pivot", "AGG-6,RSH-2", with_panel(
    "SELECT nation, " + _yr_cols('avg(CASE WHEN yr = {y} THEN entity_count END) AS "{y}"')
    + " FROM panel GROUP BY nation"))
def q_agg6(spark, sf_dir):
    return aggs.pivot_mean(panel(spark, sf_dir), "nation", "yr", "entity_count", "mean", YEARS)


@query("agg7_quantiles", "AGG-7", """
SELECT l_returnflag, quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.01) AS p01,
       quantile_cont(l_extendedprice, 0.99) AS p99 FROM lineitem GROUP BY l_returnflag""")
def q_agg7(spark, sf_dir):
    from panelforge.functions.quantile import grouped_quantiles
    li = read_table(spark, sf_dir, "lineitem")
    q = grouped_quantiles(li, "l_extendedprice", [0.5, 0.01, 0.99], ["l_returnflag"])
    return q.withColumnsRenamed({"q0": "median", "q1": "p01", "q2": "p99"})


@query("agg8_var_std", "AGG-8", """
SELECT l_linestatus, var_samp(l_quantity) AS var_qty, stddev_samp(l_extendedprice) AS std_price
FROM lineitem GROUP BY l_linestatus""")
def q_agg8(spark, sf_dir):
    return aggs.grouped(read_table(spark, sf_dir, "lineitem"), ["l_linestatus"],
                        {"var_qty": ("var", "l_quantity"), "std_price": ("std", "l_extendedprice")})


@query("agg9_cell_means", "AGG-9,CAU-3", with_panel("""
WITH t AS (SELECT k, CAST(max(CASE WHEN yr = 1997 THEN disc END) >= (SELECT quantile_cont(disc, 0.5) FROM panel
                  WHERE yr = 1997) AS INTEGER) AS treated FROM panel GROUP BY k),
c AS (SELECT avg(CASE WHEN treated = 1 AND is_post = 1 THEN entity_growth_yoy END) AS t_post,
             avg(CASE WHEN treated = 1 AND is_post = 0 THEN entity_growth_yoy END) AS t_pre,
             avg(CASE WHEN treated = 0 AND is_post = 1 THEN entity_growth_yoy END) AS c_post,
             avg(CASE WHEN treated = 0 AND is_post = 0 THEN entity_growth_yoy END) AS c_pre
      FROM panel JOIN t USING (k))
SELECT *, (t_post - t_pre) - (c_post - c_pre) AS did FROM c"""))
def q_agg9(spark, sf_dir):
    from panelforge.operators.causal import did_2x2, treat_by_baseline
    p = treat_by_baseline(panel(spark, sf_dir), "k", "yr", "disc", SPEC.baseline_year)
    return did_2x2(p, "entity_growth_yoy", "treated", "is_post")


@query("agg10_arg_extremes", "AGG-10", with_panel("""
WITH m AS (SELECT k, avg(funding_growth_yoy) AS m FROM panel GROUP BY k)
SELECT arg_max(k, (m, -k)) AS best_key, max(m) AS best_mean, arg_min(k, (m, k)) AS worst_key, min(m) AS worst_mean
FROM m"""))
def q_agg10(spark, sf_dir):
    return aggs.arg_extremes(panel(spark, sf_dir), "k", "funding_growth_yoy")


@query("agg12_metric_dependent", "AGG-12", with_panel("""
SELECT yr, CAST(sum(entity_count) AS BIGINT) AS entity_count, sum(funding) AS funding, avg(disc) AS disc,
       avg(entity_growth_yoy) AS entity_growth_yoy FROM panel GROUP BY yr"""))
def q_agg12(spark, sf_dir):
    return aggs.grouped(panel(spark, sf_dir), ["yr"], {
        "entity_count": ("sum", "entity_count"), "funding": ("sum", "funding"),
        "disc": ("mean", "disc"), "entity_growth_yoy": ("mean", "entity_growth_yoy")})


@query("agg13_entity_vs_all", "AGG-13,SET-1", with_panel("""
SELECT yr, sum(funding) AS total, 'NATION_1' AS series FROM panel WHERE nation = 'NATION_1' GROUP BY yr
UNION ALL SELECT yr, sum(funding), 'ALL' FROM panel GROUP BY yr"""))
def q_agg13(spark, sf_dir):
    return aggs.entity_vs_total(panel(spark, sf_dir), "nation", "yr", "funding", "NATION_1")


@query("agg14_histogram", "AGG-14", """
WITH b AS (SELECT min(l_extendedprice) lo, max(l_extendedprice) hi FROM lineitem),
x AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((l_extendedprice - lo) / ((hi - lo) / 10)), 9) END AS INTEGER)
             AS bin, lo, hi FROM lineitem, b WHERE l_extendedprice IS NOT NULL)
SELECT bin, lo + bin * ((hi - lo) / 10) AS bin_lo, lo + (bin + 1) * ((hi - lo) / 10) AS bin_hi, count(*) AS n
FROM x GROUP BY bin, lo, hi""")
def q_agg14(spark, sf_dir):
    return aggs.histogram(read_table(spark, sf_dir, "lineitem"), "l_extendedprice", 10)


@query("agg15_box_stats", "AGG-15", """
WITH q AS (SELECT l_returnflag, quantile_cont(l_quantity, 0.25) q1, quantile_cont(l_quantity, 0.5) median,
                  quantile_cont(l_quantity, 0.75) q3 FROM lineitem GROUP BY l_returnflag)
SELECT l.l_returnflag, q1, median, q3,
  min(CASE WHEN l_quantity >= q1 - 1.5 * (q3 - q1) THEN l_quantity END) AS whisker_lo,
  max(CASE WHEN l_quantity <= q3 + 1.5 * (q3 - q1) THEN l_quantity END) AS whisker_hi,
  CAST(sum(CASE WHEN l_quantity < q1 - 1.5 * (q3 - q1) OR l_quantity > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END) AS BIGINT)
    AS n_outliers
FROM lineitem l JOIN q USING (l_returnflag) GROUP BY l.l_returnflag, q1, median, q3""")
def q_agg15(spark, sf_dir):
    return aggs.box_stats(read_table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity")


@query("agg16_eda_overview", "AGG-16", with_panel("""
WITH m AS (SELECT k, avg(funding) AS m FROM panel GROUP BY k)
SELECT count(*) AS n_rows, 20 AS n_cols, avg(funding) AS mean, quantile_cont(funding, 0.5) AS median,
       stddev_samp(funding) AS std, min(funding) AS min, max(funding) AS max,
       avg(CASE WHEN period = 'pre' THEN funding END) AS pre_mean,
       avg(CASE WHEN period = 'post' THEN funding END) AS post_mean,
       (SELECT arg_max(k, (m, -k)) FROM m) AS best_key, (SELECT arg_min(k, (m, k)) FROM m) AS worst_key
FROM panel"""))
def q_agg16(spark, sf_dir):
    return aggs.eda_overview(panel(spark, sf_dir), "k", "funding", "period", "pre", "post")


@query("agg17_coverage_filter", "AGG-17", """
WITH cy AS (SELECT o_custkey, count(DISTINCT year(o_orderdate)) AS n_years FROM orders GROUP BY o_custkey)
SELECT o_custkey, n_years FROM cy WHERE n_years >= (SELECT max(n_years) FROM cy) - 1""")
def q_agg17(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    cy = o.select("o_custkey", F.year("o_orderdate").alias("yr")).distinct()
    kept = aggs.coverage_filter(cy, "o_custkey", 1)
    return kept.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_years"))


@query("agg18_dataset_summary", "AGG-18", with_panel("""
SELECT count(*) AS total_rows, count(DISTINCT k) AS n_keys, min(yr) AS first_period, max(yr) AS last_period,
       avg(entity_growth_yoy) AS target_mean, stddev_samp(entity_growth_yoy) AS target_std,
       CAST(sum(entity_count) AS BIGINT) AS total_entity_count, sum(funding) AS total_funding FROM panel"""))
def q_agg18(spark, sf_dir):
    return aggs.dataset_summary(panel(spark, sf_dir), "k", "yr", "entity_growth_yoy", ["entity_count", "funding"])


@query("agg19_treated_trend", "AGG-19", with_panel("""
WITH t AS (SELECT k, CAST(max(CASE WHEN yr = 1997 THEN disc END) >= (SELECT quantile_cont(disc, 0.5) FROM panel
                  WHERE yr = 1997) AS INTEGER) AS treated FROM panel GROUP BY k)
SELECT treated, yr, avg(entity_growth_yoy) AS mean_value FROM panel JOIN t USING (k) GROUP BY treated, yr"""))
def q_agg19(spark, sf_dir):
    from panelforge.operators.causal import treat_by_baseline
    p = treat_by_baseline(panel(spark, sf_dir), "k", "yr", "disc", SPEC.baseline_year)
    return p.groupBy("treated", "yr").agg(F.avg("entity_growth_yoy").alias("mean_value"))


@query("agg20_variance_decomposition", "AGG-20", """
WITH s AS (SELECT avg(l_extendedprice) mu, var_samp(l_extendedprice) v FROM lineitem)
SELECT l_returnflag, avg(l_extendedprice) AS group_mean,
       (avg(l_extendedprice) - (SELECT mu FROM s)) ** 2 * 100 / (SELECT v FROM s) AS share_pct
FROM lineitem GROUP BY l_returnflag""")
def q_agg20(spark, sf_dir):
    return aggs.variance_decomposition(read_table(spark, sf_dir, "lineitem"), "l_returnflag", "l_extendedprice")


# ------------------------------------------------------------------ windows
def _events_ordered(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    return e.withColumn("_ord", F.struct("ts", "event_id"))


@query("win1_lag_bucketed", "WIN-1", """
SELECT event_id, user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS value_lag1
FROM events""")
def q_win1(spark, sf_dir):
    e = _events_ordered(spark, sf_dir).select("event_id", "user_id", "value", "_ord", "ts")
    out = windows.lag(e, ["user_id"], "_ord", ["value"], bucket=F.to_date("ts"))
    return out.select("event_id", "user_id", "value", "value_lag1")


@query("win2_growth", "WIN-2", """
WITH cy AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS yr, sum(o_totalprice) AS spend
            FROM orders GROUP BY 1, 2)
SELECT o_custkey, yr, spend, (spend - lag(spend) OVER w) / nullif(lag(spend) OVER w, 0) * 100 AS spend_growth
FROM cy WINDOW w AS (PARTITION BY o_custkey ORDER BY yr)""")
def q_win2(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    cy = o.groupBy("o_custkey", F.year("o_orderdate").alias("yr")).agg(F.sum("o_totalprice").alias("spend"))
    return windows.growth(cy, ["o_custkey"], "yr", ["spend"])


@query("win2_growth_rounded", "WIN-2", """
WITH cy AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS yr, sum(o_totalprice) AS spend
            FROM orders GROUP BY 1, 2)
SELECT o_custkey, yr, round((spend - lag(spend) OVER w) / nullif(lag(spend) OVER w, 0) * 100, 2) AS spend_growth
FROM cy WINDOW w AS (PARTITION BY o_custkey ORDER BY yr)""")
def q_win2_rounded(spark, sf_dir):
    from panelforge.functions.scalar import rounded
    return rounded(q_win2(spark, sf_dir).select("o_custkey", "yr", "spend_growth"), {"spend_growth": 2})


@query("win3_rolling_mean", "WIN-3", """
SELECT event_id, user_id,
       avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS value_roll3
FROM events""")
def q_win3(spark, sf_dir):
    e = _events_ordered(spark, sf_dir)
    return windows.rolling_mean(e, ["user_id"], "_ord", ["value"], 3, spread=True).select("event_id", "user_id", "value_roll3")


@query("win4_first_difference", "WIN-4", with_panel("""
SELECT k, yr, funding - lag(funding) OVER (PARTITION BY k ORDER BY yr) AS diff FROM panel"""))
def q_win4(spark, sf_dir):
    return windows.first_difference(panel(spark, sf_dir), ["k"], "yr", "funding").select("k", "yr", "diff")


@query("win5_nth_from_end", "WIN-5", with_panel("""
WITH r AS (SELECT k, entity_count, row_number() OVER (PARTITION BY k ORDER BY yr DESC) AS rn FROM panel)
SELECT k, max(CASE WHEN rn = 1 THEN entity_count END) AS last_value,
       max(CASE WHEN rn = 4 THEN entity_count END) AS value_3_before, count(*) AS n_points FROM r GROUP BY k"""))
def q_win5(spark, sf_dir):
    return windows.nth_from_end(panel(spark, sf_dir), ["k"], "yr", "entity_count", 3)


@query("win6_holdout_split", "WIN-6", with_panel("""
SELECT k, yr, CASE WHEN row_number() OVER (PARTITION BY k ORDER BY yr DESC) <= 2 THEN 'test' ELSE 'train' END AS split
FROM panel"""))
def q_win6(spark, sf_dir):
    return windows.holdout_split(panel(spark, sf_dir), ["k"], "yr", 2).select("k", "yr", "split")


@query("win7_lag_matrix", "WIN-7", with_panel("""
SELECT * FROM (SELECT k, yr, entity_count,
  lag(entity_count, 1) OVER w AS entity_count_l1, lag(entity_count, 2) OVER w AS entity_count_l2,
  lag(entity_count, 3) OVER w AS entity_count_l3 FROM panel WINDOW w AS (PARTITION BY k ORDER BY yr))
WHERE entity_count_l1 IS NOT NULL AND entity_count_l2 IS NOT NULL AND entity_count_l3 IS NOT NULL"""))
def q_win7(spark, sf_dir):
    p = panel(spark, sf_dir).select("k", "yr", "entity_count")
    return windows.lag_matrix(p, ["k"], "yr", "entity_count", 3)


@query("win8_average_rank", "WIN-8", """
SELECT DISTINCT l_quantity, rank() OVER (ORDER BY l_quantity)
       + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS avg_rank FROM lineitem""")
def q_win8(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_quantity")
    return windows.global_average_rank(li, "l_quantity").distinct()


@query("win10_running_best", "WIN-10", """
SELECT o_orderkey, o_custkey,
       max(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best_so_far FROM orders""")
def q_win10(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").withColumn("_ord", F.struct("o_orderdate", "o_orderkey"))
    return windows.running_best(o, "_ord", "o_totalprice", ["o_custkey"], spread=True).select(
        "o_orderkey", "o_custkey", "best_so_far")


@query("win11_group_transform", "WIN-11", """
SELECT l_orderkey, l_linenumber, l_suppkey, avg(l_extendedprice) OVER (PARTITION BY l_suppkey) AS supp_mean
FROM lineitem""")
def q_win11(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    return windows.group_transform(li, ["l_suppkey"], "l_extendedprice", "avg", "supp_mean").drop("l_extendedprice")


@query("win12_acf", "WIN-12", with_panel("""
WITH b AS (SELECT k, row_number() OVER (PARTITION BY k ORDER BY yr) AS pos, CAST(entity_count AS DOUBLE) AS x FROM panel),
s AS (SELECT k, avg(x) mu, count(*) n FROM b GROUP BY k),
c AS (SELECT b.k, pos, x - mu AS d, n FROM b JOIN s USING (k)),
den AS (SELECT k, sum(d * d) ss, max(n) n FROM c GROUP BY k),
lags AS (SELECT k, ss, CAST(unnest(range(1, CAST(greatest(floor(n / 2) - 1, 1) AS BIGINT) + 1)) AS INTEGER) AS lag FROM den)
SELECT l.k, l.lag, sum(a.d * b2.d) / nullif(max(l.ss), 0) AS acf
FROM lags l JOIN c a ON a.k = l.k JOIN c b2 ON b2.k = l.k AND b2.pos = a.pos + l.lag GROUP BY l.k, l.lag"""))
def q_win12(spark, sf_dir):
    return windows.acf(panel(spark, sf_dir), ["k"], "yr", "entity_count")


@query("win12_acf_daily", "WIN-12", """
WITH y AS (SELECT o_orderdate AS d, sum(CAST(o_totalprice AS DOUBLE)) AS x FROM orders GROUP BY 1),
b AS (SELECT row_number() OVER (ORDER BY d) AS pos, x - (SELECT avg(x) FROM y) AS d FROM y),
l AS (SELECT CAST(unnest(range(1, CAST(floor(count(*) / 2) AS BIGINT))) AS INTEGER) AS lag FROM y)
SELECT 'orders' AS series, lag, round(sum(a.d * b.d) / (SELECT sum(d * d) FROM b), 6) AS acf
FROM l, b a JOIN b ON TRUE WHERE b.pos = a.pos + lag GROUP BY lag""")
def q_win12_daily(spark, sf_dir):
    """All lags of daily revenue: one long series through the transform in two passes."""
    daily = (read_table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").alias("d"))
             .agg(F.sum(F.col("o_totalprice").cast("double")).alias("x")).withColumn("series", F.lit("orders")))
    out = windows.acf(daily, ["series"], "d", "x", short=256)
    return out.withColumn("acf", F.round("acf", 6) + 0.0)


@query("win13_pacf", "WIN-13")
def q_win13(spark, sf_dir):
    return windows.pacf_from_acf(windows.acf(panel(spark, sf_dir), ["k"], "yr", "entity_count"), ["k"])


# ------------------------------------------------------------------ top-k
@query("top1_nlargest", "TOP-1", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def q_top1(spark, sf_dir):
    return topk.nlargest(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 10,
                         "o_totalprice", ["o_orderkey"])


@query("top2_top_keys_history", "TOP-2", with_panel("""
SELECT k, yr, funding FROM panel WHERE k IN (
  SELECT k FROM panel GROUP BY k ORDER BY avg(funding) DESC, k LIMIT 5)"""))
def q_top2(spark, sf_dir):
    return topk.top_keys_history(panel(spark, sf_dir).select("k", "yr", "funding"), "k", "funding", 5)


@query("top3_top_bottom", "TOP-3,SET-1", with_panel("""
WITH m AS (SELECT nation, avg(entity_growth_yoy) AS mean_value FROM panel GROUP BY nation HAVING mean_value IS NOT NULL)
(SELECT nation, mean_value, 'top' AS "end" FROM m ORDER BY mean_value DESC, nation LIMIT 5)
UNION ALL (SELECT nation, mean_value, 'bottom' FROM m ORDER BY mean_value ASC, nation LIMIT 5)"""))
def q_top3(spark, sf_dir):
    return topk.top_and_bottom(panel(spark, sf_dir), "nation", "entity_growth_yoy", 5)


@query("top4_sort_abs", "TOP-4", """
SELECT * FROM (SELECT event_id, value - (SELECT avg(value) FROM events) AS dev FROM events)
ORDER BY abs(dev) DESC, event_id LIMIT 20""")
def q_top4(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    d = e.select("event_id", (F.col("value") - e.select(F.avg("value")).scalar()).alias("dev"))
    return topk.by_absolute(d, "dev", ["event_id"]).limit(20)


@query("top7_most_variable", "TOP-7", with_panel("""
WITH m AS (SELECT k, avg(disc) disc, avg(tax) tax, avg(density) density, avg(big_rate) big_rate FROM panel GROUP BY k),
l AS (UNPIVOT m ON disc, tax, density, big_rate INTO NAME feature VALUE value)
SELECT feature, var_samp(value) AS variance FROM l GROUP BY feature ORDER BY variance DESC, feature LIMIT 2"""))
def q_top7(spark, sf_dir):
    return topk.most_variable(panel(spark, sf_dir), "k", ["disc", "tax", "density", "big_rate"], 2)


# ------------------------------------------------------------------ set ops, reshaping
@query("set1_union_sources", "SET-1", with_panel("""
SELECT k, yr, 'demand' AS source, CAST(entity_count AS DOUBLE) AS value FROM src_a
UNION ALL SELECT k, yr, 'supply', volume FROM src_b"""))
def q_set1(spark, sf_dir):
    a = demand_source(spark, sf_dir).select("k", "yr", F.lit("demand").alias("source"),
                                            F.col("entity_count").cast("double").alias("value"))
    b = supply_source(spark, sf_dir).select("k", "yr", F.lit("supply").alias("source"), F.col("volume").alias("value"))
    return reshape.union_all(a, b)


@query("set2_except_pairs", "SET-2", with_panel("""
SELECT DISTINCT k, yr FROM src_b EXCEPT SELECT k, yr FROM src_a"""))
def q_set2(spark, sf_dir):
    return reshape.except_pairs(supply_source(spark, sf_dir), demand_source(spark, sf_dir), ["k", "yr"])


@query("set3_union_distinct", "SET-3", """
SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier""")
def q_set3(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nationkey"))
    s = read_table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    return reshape.union_distinct(c, s)


@query("rsh1_unpivot", "RSH-1", with_panel("""
UNPIVOT (SELECT k, yr, disc, tax, price FROM panel) ON disc, tax, price INTO NAME feature VALUE value"""))
def q_rsh1(spark, sf_dir):
    return reshape.wide_to_long(panel(spark, sf_dir), ["k", "yr"], ["disc", "tax", "price"])


@query("rsh2_pivot", "RSH-2", with_panel(
    "SELECT k, " + _yr_cols('first(funding) FILTER (WHERE yr = {y}) AS "{y}"') + " FROM panel GROUP BY k"))
def q_rsh2(spark, sf_dir):
    p = panel(spark, sf_dir)
    return reshape.long_to_wide(p, "k", "yr", "funding", YEARS)


@query("jn9_scalar_attach", "JN-9,FEA-8", """
SELECT event_id, value - (SELECT quantile_cont(value, 0.5) FROM events) AS dev_from_median,
       value / (SELECT max(value) FROM events) AS share_of_max FROM events""")
def q_jn9(spark, sf_dir):
    """Global scalars attached to every row as scalar subqueries (no cross join, no global window)."""
    from panelforge.functions.quantile import quantile_scalars
    e = read_table(spark, sf_dir, "events")
    median = quantile_scalars(e, ["value"], [0.5])["value"][0]
    return e.select("event_id", (F.col("value") - median).alias("dev_from_median"),
                    F.try_divide(F.col("value"), e.agg(F.max("value")).scalar()).alias("share_of_max"))
