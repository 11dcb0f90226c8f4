"""Registered queries: sources, sinks, projections, filters, missing data and data quality."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions import scalar as S
from panelforge.operators import filters, missing, quality
from panelforge.plans.registry import query
from panelforge.sources import sinks, tables
from panelforge.sources.panel import SPEC, panel, with_panel
from panelforge.sources.tables import read_table


# Events with NULLs punched by rule (FIXTURES.md: identical rule in Spark and DuckDB).
EV_SQL = """ev AS (
  SELECT event_id, ts, user_id, event_type,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value_h,
         CASE WHEN event_id % 5 = 0 THEN NULL ELSE props END AS props_h,
         CASE WHEN event_id % 3 = 0 THEN value END AS sparse
  FROM events)"""


def with_ev(sql: str) -> str:
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + EV_SQL + ",\n" + body[5:]
    return "WITH " + EV_SQL + "\n" + body


def events_with_holes(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    return e.select("event_id", "ts", "user_id", "event_type",
                    F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value_h"),
                    F.when(F.col("event_id") % 5 != 0, F.col("props")).alias("props_h"),
                    F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("sparse"))


# ------------------------------------------------------------------ sources
@query("src1_load_stage", "SRC-1", "SELECT * FROM events")
def q_src1(spark, sf_dir):
    return tables.nan_to_null(read_table(spark, sf_dir, "events"))


@query("src2_first_existing", "SRC-2", "SELECT count(*) AS n_rows FROM orders")
def q_src2(spark, sf_dir):
    df = tables.read_first_existing(spark, [f"{sf_dir}/orders_v2.parquet", f"{sf_dir}/orders.parquet"])
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


@query("src3_catalog_read", "SRC-3", "SELECT * FROM supplier")
def q_src3(spark, sf_dir):
    read_table(spark, sf_dir, "supplier").createOrReplaceTempView("supplier_stage")
    return tables.read_catalog_table(spark, "supplier_stage")


_ALL = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
        "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@query("src4_largest_table", "SRC-4", "WITH c AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _ALL)
    + ") SELECT table_name, n_rows FROM c ORDER BY n_rows DESC, table_name LIMIT 1")
def q_src4(spark, sf_dir):
    return tables.largest_table({t: read_table(spark, sf_dir, t) for t in _ALL})


@query("src5_arrays_to_rows", "SRC-5", with_panel("""
SELECT p.k, p.yr, p.entity_count, p.funding, r_name FROM panel p
JOIN nation ON p.k = n_nationkey JOIN region ON n_regionkey = r_regionkey"""))
def q_src5(spark, sf_dir):
    p = panel(spark, sf_dir)
    # per-key arrays indexed by year position, as the array-shaped source stores them
    arr = (p.groupBy("k").agg(F.min("yr").alias("start"),
                              F.sort_array(F.collect_list(F.struct("yr", "entity_count", "funding"))).alias("s"))
           .select("k", "start", F.col("s.entity_count").alias("entity_count"), F.col("s.funding").alias("funding")))
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    lookup = (nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
              .agg(F.map_from_entries(F.collect_list(F.struct("n_nationkey", "r_name")))).scalar())
    return tables.arrays_to_rows(arr, "k", F.col("start"), ["entity_count", "funding"],
                                 {"r_name": F.element_at(lookup, F.col("k"))}, "yr")


@query("src6_resolve_column", "SRC-6", """
SELECT l_returnflag AS flag, sum(l_quantity) AS value FROM lineitem GROUP BY l_returnflag""")
def q_src6(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    df = tables.select_resolved(li, {"flag": ["returnflag"], "value": ["startup_count", "quantity"]})
    return df.groupBy("flag").agg(F.sum("value").alias("value"))


# ------------------------------------------------------------------ sinks
@query("snk1_save_stage", "SNK-1", with_panel("SELECT k, yr, funding, period FROM panel"))
def q_snk1(spark, sf_dir):
    path = sinks.new_scratch(spark, "stage")
    sinks.save_stage(panel(spark, sf_dir).select("k", "yr", "funding", "period"), path, partition_by="period")
    return spark.read.parquet(path).select("k", "yr", "funding", "period")


@query("snk2_replace_table", "SNK-2", with_panel("SELECT k, yr, entity_count FROM panel"))
def q_snk2(spark, sf_dir):
    df = panel(spark, sf_dir).select("k", "yr", "entity_count")
    return sinks.replace_table(df, "panel_stage_snk2", sinks.new_scratch(spark, "tbl"))


CONTRACT = T.StructType([
    T.StructField("country", T.StringType()), T.StructField("year", T.LongType()),
    T.StructField("startup_count", T.DoubleType()), T.StructField("total_funding_usd", T.DoubleType()),
    T.StructField("gdp_growth_rate", T.DoubleType()), T.StructField("pandemic_period", T.LongType()),
])


@query("snk3_conform_contract", "SNK-3", with_panel("""
SELECT nation AS country, CAST(yr AS BIGINT) AS year, CAST(entity_count AS DOUBLE) AS startup_count,
       funding AS total_funding_usd, CAST(is_post AS BIGINT) AS pandemic_period FROM panel"""))
def q_snk3(spark, sf_dir):
    p = panel(spark, sf_dir)
    return sinks.conform(p, CONTRACT, {"nation": "country", "yr": "year", "entity_count": "startup_count",
                                       "funding": "total_funding_usd", "is_post": "pandemic_period"})


@query("snk3_store_contract", "SNK-3", with_panel("""
SELECT nation AS country, CAST(yr AS BIGINT) AS year, CAST(entity_count AS DOUBLE) AS startup_count,
       funding AS total_funding_usd, CAST(is_post AS BIGINT) AS pandemic_period FROM panel"""))
def q_snk3_store(spark, sf_dir):
    """A contract table in the shared folder: loaded with old rows, emptied and loaded again, then read."""
    names = {"nation": "country", "yr": "year", "entity_count": "startup_count", "funding": "total_funding_usd",
             "is_post": "pandemic_period"}
    p = panel(spark, sf_dir)
    path = sinks.new_scratch(spark, "contract")
    table = "contract_" + path.rsplit("-", 1)[1]
    old = sinks.conform(p, CONTRACT, names).where("year < 1994")
    sinks.replace_table(old, table, path)
    try:
        sinks.store(p, table, CONTRACT, names)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # the files of an external table stay
    return spark.read.parquet(path)


@query("snk6_summary_rows", "SNK-6,DQ-7", with_ev("""
SELECT 'total_cells' AS key, CAST(count(*) * 7 AS VARCHAR) AS value FROM ev
UNION ALL SELECT 'missing_cells', CAST(sum((value_h IS NULL)::INT + (props_h IS NULL)::INT + (sparse IS NULL)::INT)
                                       AS VARCHAR) FROM ev"""))
def q_snk6(spark, sf_dir):
    h = quality.health_score(events_with_holes(spark, sf_dir))
    return sinks.summary_rows(h.select("total_cells", "missing_cells"))


# ------------------------------------------------------------------ projections
@query("prj_projections", "PRJ-1,PRJ-2,PRJ-4,PRJ-5,PRJ-6,PRJ-7,PRJ-8,PRJ-9,PRJ-10,PRJ-11,PRJ-12", with_panel("""
SELECT k, yr,
  CASE WHEN yr < 1998 THEN 'pre' WHEN yr < 2000 THEN 'during' ELSE 'post' END AS period_label,
  CAST(yr IN (1998, 1999) AS INTEGER) AS during_flag,
  funding / nullif(deals, 0) AS funding_per_deal,
  big_deals / (entity_count + 1.0) AS offset_ratio,
  is_post * disc AS post_x_disc,
  disc - tax AS momentum,
  funding / nullif(entity_count, 0) AS per_entity,
  CASE WHEN entity_growth_yoy > -1 THEN ln(1 + entity_growth_yoy) END AS log_growth,
  entity_count * pow(1 + disc * 100 / 100.0, yr - 1995) AS compounded,
  make_date(CAST(yr AS INTEGER), 1, 1) AS ds,
  yr - (SELECT min(yr) FROM panel) AS year_idx,
  funding / 1e3 AS funding_k,
  CASE period WHEN 'pre' THEN 0 WHEN 'during' THEN 1 WHEN 'post' THEN 2 END AS period_enc
FROM panel"""))
def q_prj(spark, sf_dir):
    p = panel(spark, sf_dir)
    return p.select(
        "k", "yr",
        S.period_label("yr", SPEC.during_start, SPEC.post_start).alias("period_label"),
        S.flag(F.col("yr").isin(1998, 1999)).alias("during_flag"),
        S.safe_ratio("funding", "deals").alias("funding_per_deal"),
        S.offset_ratio("big_deals", "entity_count", 1.0).alias("offset_ratio"),
        S.interaction("is_post", "disc").alias("post_x_disc"),
        S.difference("disc", "tax").alias("momentum"),
        S.rebuild_if_missing(p.columns, "per_entity", "funding", "entity_count").alias("per_entity"),
        S.log1p("entity_growth_yoy").alias("log_growth"),
        S.compounded("entity_count", F.col("disc") * 100, F.col("yr") - 1995).alias("compounded"),
        S.year_start("yr").alias("ds"),
        (F.col("yr") - p.select(F.min("yr")).scalar()).alias("year_idx"),
        (F.col("funding") / 1e3).alias("funding_k"),
        S.recode("period", {"pre": 0, "during": 1, "post": 2}).alias("period_enc"))


@query("prj13_stars_verdicts", "PRJ-13", """
WITH s AS (SELECT l_returnflag, l_discount AS p, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT l_returnflag, p, n,
  CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**' WHEN p < 0.05 THEN '*' ELSE '' END AS stars,
  CASE WHEN p < 0.05 THEN 'significant' ELSE 'not significant' END AS decision FROM s""")
def q_prj13(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    s = li.groupBy("l_returnflag", F.col("l_discount").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    return s.withColumns({"stars": S.stars("p"),
                          "decision": S.verdict("p", 0.05, "significant", "not significant")})


@query("prj14_rule_score", "PRJ-14", with_panel("""
SELECT k, yr, 2.0 + 0.8 * funding_growth_yoy + 0.3 * (disc * 1000 / 10.0) - 0.2 * (tax * 100)
              + 3.0 * coalesce(density * 100, 0.5) AS predicted FROM panel"""))
def q_prj14(spark, sf_dir):
    p = panel(spark, sf_dir)
    return p.select("k", "yr", S.rule_score("funding_growth_yoy", F.col("disc") * 1000, F.col("tax") * 100,
                                            F.col("density") * 100).alias("predicted"))


@query("prj15_regex_checks", "PRJ-15,DQ-1", r"""
SELECT count(*) FILTER (WHERE regexp_matches(text, '^\s|\s$')) AS n_edge_whitespace,
       count(*) FILTER (WHERE regexp_matches(source, '^[a-z]+_\d+$')) AS n_placeholder FROM documents""")
def q_prj15(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return d.agg(F.sum(S.flag(S.has_edge_whitespace("text"))).cast("long").alias("n_edge_whitespace"),
                 F.sum(S.flag(S.is_placeholder_name("source", r"^[a-z]+_\d+$"))).cast("long").alias("n_placeholder"))


# ------------------------------------------------------------------ filters
@query("flt1_row_filters", "FLT-1", """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE l_returnflag = 'R' AND l_quantity >= 10 AND l_quantity <= 30 AND l_linestatus IN ('F')
  AND l_tax NOT IN (0.0, 0.08) AND l_shipdate IS NOT NULL""")
def q_flt1(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    out = filters.where(li, eq={"l_returnflag": "R"}, between={"l_quantity": (10, 30)},
                        isin={"l_linestatus": ["F"]}, not_in={"l_tax": [0.0, 0.08]}, not_null=["l_shipdate"])
    return out.select("l_orderkey", "l_linenumber")


@query("flt2_dropna", "FLT-2", with_ev("""
SELECT event_type, count(*) AS n FROM ev WHERE value_h IS NOT NULL AND props_h IS NOT NULL GROUP BY event_type"""))
def q_flt2(spark, sf_dir):
    e = filters.drop_missing(events_with_holes(spark, sf_dir), ["value_h", "props_h"])
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("flt3_latest_snapshot", "FLT-3", with_panel("SELECT k, yr, funding FROM panel WHERE yr = (SELECT max(yr) FROM panel)"))
def q_flt3(spark, sf_dir):
    return filters.latest_snapshot(panel(spark, sf_dir), "yr").select("k", "yr", "funding")


@query("flt4_select_features", "FLT-4", with_panel("""
SELECT k, entity_count, funding, deals, big_deals, volume, disc, tax, price, is_partial, density, intensity,
       big_rate, is_during, is_post FROM panel"""))
def q_flt4(spark, sf_dir):
    p = panel(spark, sf_dir)
    return filters.select_features(p, drop_suffixes=["_yoy"], drop_substrings=["yr", "k"], keep=["k"])


@query("flt5_housekeeping", "FLT-5", """
SELECT o_orderkey AS order_id, CAST(trunc(o_totalprice) AS BIGINT) AS price, o_orderstatus AS status FROM orders""")
def q_flt5(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return filters.housekeeping(o.select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate"),
                                rename={"o_orderkey": "order_id", "o_totalprice": "price", "o_orderstatus": "status"},
                                drop=["o_orderdate"], cast={"o_totalprice": "bigint"})


# ------------------------------------------------------------------ missing data
@query("mis1_null_profile", "MIS-1", with_ev("""
SELECT column_name, n_null, n_null * 100.0 / n AS null_pct, CAST(n_null * 100.0 / n > 50 AS INTEGER) AS above_threshold
FROM (SELECT count(*) AS n, count(*) - count(event_id) AS event_id, count(*) - count(ts) AS ts,
             count(*) - count(user_id) AS user_id, count(*) - count(event_type) AS event_type,
             count(*) - count(value_h) AS value_h, count(*) - count(props_h) AS props_h,
             count(*) - count(sparse) AS sparse FROM ev)
UNPIVOT (n_null FOR column_name IN (event_id, ts, user_id, event_type, value_h, props_h, sparse))"""))
def q_mis1(spark, sf_dir):
    return missing.null_profile(events_with_holes(spark, sf_dir))


@query("mis2_drop_high_missing", "MIS-2", with_ev("SELECT event_id, ts, user_id, event_type, value_h, props_h FROM ev"))
def q_mis2(spark, sf_dir):
    return missing.drop_high_missing(events_with_holes(spark, sf_dir), 0.6)


MIS3_SQL = with_ev("""
SELECT event_id, user_id, coalesce(
  last_value(value_h IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(value_h IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value_h FROM ev""")


@query("mis3_ffill_bfill", "MIS-3", MIS3_SQL)
def q_mis3(spark, sf_dir):
    e = events_with_holes(spark, sf_dir).withColumn("_ord", F.struct("ts", "event_id"))
    out = missing.ffill_bfill(e, ["user_id"], "_ord", ["value_h"], bucket=F.to_date("ts"))
    return out.select("event_id", "user_id", "value_h")


@query("mis4_global_median", "MIS-4", with_ev("""
SELECT event_id, coalesce(value_h, (SELECT quantile_cont(value_h, 0.5) FROM ev)) AS value_h,
       coalesce(sparse, (SELECT quantile_cont(sparse, 0.5) FROM ev)) AS sparse FROM ev"""))
def q_mis4(spark, sf_dir):
    out = missing.fill_global_median(events_with_holes(spark, sf_dir), ["value_h", "sparse"])
    return out.select("event_id", "value_h", "sparse")


@query("mis5_key_median", "MIS-5", with_ev("""
SELECT event_id, user_id, coalesce(value_h, quantile_cont(value_h, 0.5) OVER (PARTITION BY user_id)) AS value_h FROM ev"""))
def q_mis5(spark, sf_dir):
    out = missing.fill_key_median(events_with_holes(spark, sf_dir), ["user_id"], ["value_h"])
    return out.select("event_id", "user_id", "value_h")


@query("mis6_constant_fill", "MIS-6", with_ev("SELECT event_id, coalesce(value_h, 0) AS value_h, coalesce(sparse, 0) AS sparse FROM ev"))
def q_mis6(spark, sf_dir):
    return missing.fill_constant(events_with_holes(spark, sf_dir), 0.0, ["value_h", "sparse"]).select(
        "event_id", "value_h", "sparse")


@query("mis7_missing_matrix", "MIS-7", with_ev("""
SELECT event_id, CAST(value_h IS NULL AS INTEGER) AS value_h_missing, CAST(props_h IS NULL AS INTEGER) AS props_h_missing
FROM ev"""))
def q_mis7(spark, sf_dir):
    return missing.missing_matrix(events_with_holes(spark, sf_dir), ["event_id"], ["value_h", "props_h"])


@query("mis8_before_after", "MIS-8", with_ev("""
SELECT (SELECT count(*) - count(value_h) FROM ev) AS missing_before,
       CAST(0 AS BIGINT) AS missing_after"""))
def q_mis8(spark, sf_dir):
    before = events_with_holes(spark, sf_dir).withColumn("_ord", F.struct("ts", "event_id"))
    after = missing.ffill_bfill(before, ["user_id"], "_ord", ["value_h"], bucket=F.to_date("ts"))
    return missing.missing_before_after(before.select("value_h"), after.select("value_h"))


# ------------------------------------------------------------------ data quality
@query("dq1_check_schema", "DQ-1", r"""
SELECT 'missing_column' AS "check", 'c_phone' AS column_name, CAST(1 AS BIGINT) AS n_issues
UNION ALL SELECT 'whitespace', 'c_name', count(*) FILTER (WHERE regexp_matches(c_name, '^\s|\s$')) FROM customer
UNION ALL SELECT 'whitespace', 'c_mktsegment', count(*) FILTER (WHERE regexp_matches(c_mktsegment, '^\s|\s$')) FROM customer""")
def q_dq1(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    return quality.check_schema(c, ["c_custkey", "c_name", "c_phone"])


@query("dq2_panel_gaps", "DQ-2", """
WITH cy AS (SELECT DISTINCT o_custkey, year(o_orderdate) AS yr FROM orders)
SELECT count(DISTINCT o_custkey) * (max(yr) - min(yr) + 1) - count(*) AS panel_gaps FROM cy""")
def q_dq2(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("yr"))
    return quality.count_panel_gaps(o, "o_custkey", "yr")


@query("dq3_duplicates", "DQ-3", """
SELECT (SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) FROM (SELECT count(*) c FROM lineitem
        GROUP BY ALL_COLUMNS_PLACEHOLDER)) AS exact_duplicates,
       (SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) FROM (SELECT count(*) c FROM lineitem GROUP BY l_orderkey))
        AS key_duplicates""".replace("ALL_COLUMNS_PLACEHOLDER",
                                      "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
                                      "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"))
def q_dq3(spark, sf_dir):
    return quality.duplicates(read_table(spark, sf_dir, "lineitem"), ["l_orderkey"])


BOUNDS = {"l_quantity": (1.0, 45.0), "l_discount": (0.0, 0.08), "l_tax": (0.01, 0.08)}


@query("dq4_range_violations", "DQ-4", "SELECT * FROM (SELECT " + ", ".join(
    f"CAST(sum(CASE WHEN {c} IS NOT NULL AND ({c} < {lo} OR {c} > {hi}) THEN 1 ELSE 0 END) AS BIGINT) AS {c}"
    for c, (lo, hi) in BOUNDS.items()) + " FROM lineitem) UNPIVOT (n_out FOR column_name IN ("
    + ", ".join(BOUNDS) + "))")
def q_dq4(spark, sf_dir):
    return quality.range_violations(read_table(spark, sf_dir, "lineitem"), BOUNDS)


_DQ5 = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("dq5_iqr_outliers", "DQ-5", " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, CAST(sum(CASE WHEN {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END)
       AS BIGINT) AS n_outliers, q1, q3
FROM lineitem, (SELECT quantile_cont({c}, 0.25) q1, quantile_cont({c}, 0.75) q3 FROM lineitem)
GROUP BY q1, q3 HAVING q3 <> q1""" for c in _DQ5))
def q_dq5(spark, sf_dir):
    return quality.iqr_outliers(read_table(spark, sf_dir, "lineitem"), _DQ5)


@query("dq6_flag_mismatch", "DQ-6", with_panel("""
SELECT CAST(sum(CASE WHEN is_partial IS DISTINCT FROM CAST(yr >= 2000 AS INTEGER) THEN 1 ELSE 0 END) AS BIGINT)
       AS flag_mismatch FROM panel"""))
def q_dq6(spark, sf_dir):
    return quality.flag_mismatch(panel(spark, sf_dir), "is_partial", S.flag(F.col("yr") >= 2000))


@query("dq7_health_score", "DQ-7", with_ev("""
SELECT total_cells, missing_cells, 100.0 * (1 - missing_cells / total_cells) AS health_pct,
       CASE WHEN 100.0 * (1 - missing_cells / total_cells) >= 80 THEN 'PASS' ELSE 'NEEDS CLEANING' END AS status
FROM (SELECT count(*) * 7 AS total_cells,
             CAST(sum((value_h IS NULL)::INT + (props_h IS NULL)::INT + (sparse IS NULL)::INT) AS BIGINT) AS missing_cells
      FROM ev)"""))
def q_dq7(spark, sf_dir):
    return quality.health_score(events_with_holes(spark, sf_dir))


@query("dq8_validate", "DQ-8", with_panel("""
SELECT count(*) AS total_rows, count(DISTINCT k) AS n_keys, list_sort(list_distinct(list(yr))) AS periods,
  CAST(sum(CASE WHEN period = 'pre' THEN 1 ELSE 0 END) AS BIGINT) AS n_pre,
  CAST(sum(CASE WHEN period = 'during' THEN 1 ELSE 0 END) AS BIGINT) AS n_during,
  CAST(sum(CASE WHEN period = 'post' THEN 1 ELSE 0 END) AS BIGINT) AS n_post,
  min(entity_count) AS entity_count_min, max(entity_count) AS entity_count_max,
  min(disc) AS disc_min, max(disc) AS disc_max FROM panel"""))
def q_dq8(spark, sf_dir):
    return quality.validate_panel(panel(spark, sf_dir), "k", "yr", "period", ["pre", "during", "post"],
                                  ["entity_count", "disc"])


@query("dq9_flat_series", "DQ-9", """
WITH r AS (SELECT o_custkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey
           ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
SELECT o_custkey, max(o_orderpriority) AS flat_value FROM r WHERE rn <= 4 GROUP BY o_custkey
HAVING count(*) = 4 AND count(DISTINCT o_orderpriority) = 1""")
def q_dq9(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").withColumn("_ord", F.struct("o_orderdate", "o_orderkey"))
    return quality.flat_series(o, "o_custkey", "_ord", "o_orderpriority", 4)


@query("dq10_fanout", "DQ-10", """
SELECT o_custkey, o_orderdate, count(*) AS n_rows FROM orders GROUP BY 1, 2 HAVING count(*) > 1""")
def q_dq10(spark, sf_dir):
    return quality.fanout(read_table(spark, sf_dir, "orders"), ["o_custkey", "o_orderdate"])


@query("dq11_stage_trace", "DQ-11", with_panel("""
SELECT coalesce(a.yr, b.yr) AS yr, raw_sum, panel_sum FROM
  (SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, sum(o_totalprice) AS raw_sum FROM orders GROUP BY 1) a
  FULL OUTER JOIN (SELECT yr, sum(funding) AS panel_sum FROM panel GROUP BY yr) b ON a.yr = b.yr"""))
def q_dq11(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("yr"),
                                                   F.col("o_totalprice").alias("v"))
    p = panel(spark, sf_dir).select("yr", F.col("funding").alias("v"))
    return quality.stage_trace({"raw": o, "panel": p}, "yr", "v")


@query("dq12_cluster_sanity", "DQ-12", with_panel(r"""
SELECT count(DISTINCT nation) AS n_keys,
       CAST(sum(CASE WHEN regexp_matches(nation, '^Country_\d+$') THEN 1 ELSE 0 END) AS BIGINT) AS n_placeholder,
       CASE WHEN count(DISTINCT nation) BETWEEN 5 AND 25
            AND sum(CASE WHEN regexp_matches(nation, '^Country_\d+$') THEN 1 ELSE 0 END) = 0 THEN 'PASS' ELSE 'FAIL' END
       AS status FROM panel"""))
def q_dq12(spark, sf_dir):
    return quality.cluster_sanity(panel(spark, sf_dir), "nation")
