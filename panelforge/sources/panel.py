"""The test panel: entity = nation, period = year, two keyed sources merged.

Both sources are derived from the row-level star schema, so the work grows with
the tables.  Each source pre-aggregates its fact table on (foreign key, year)
before the join: the join then moves one row per (customer|supplier, year)
instead of one per order/line, and the customer/supplier dimension is joined
with a shuffle join (it grows with the data).  ``nation`` is a fixed 25-row
dimension and is broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelforge.functions import scalar as S
from panelforge.sources.tables import read_table


@dataclass(frozen=True)
class PanelSpec:
    """Column roles of a panel; operators take these names as parameters."""
    key: str = "k"
    name: str = "nation"
    period: str = "yr"
    # Fixed values of the fixture (FIXTURES.md): period boundaries, partial and baseline year.
    during_start: int = 1998
    post_start: int = 2000
    partial_year: int = 2001
    baseline_year: int = 1997
    big_deal_price: float = 450000.0


SPEC = PanelSpec()


def demand_source(spark: SparkSession, sf_dir: str, spec: PanelSpec = SPEC) -> DataFrame:
    """Source A: per (nation, year) distinct customers, order value, orders, big orders."""
    orders = read_table(spark, sf_dir, "orders", ["o_custkey", "o_totalprice", "o_orderdate"])
    per_cust = (orders
                .groupBy(F.col("o_custkey").alias("custkey"), F.year("o_orderdate").alias(spec.period))
                .agg(F.sum("o_totalprice").alias("funding"),
                     F.count(F.lit(1)).alias("deals"),
                     F.sum(F.when(F.col("o_totalprice") >= spec.big_deal_price, 1).otherwise(0)).alias("big_deals")))
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    return (per_cust
            .join(customer, per_cust["custkey"] == customer["c_custkey"])
            .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy(F.col("n_nationkey").alias(spec.key), F.col("n_name").alias(spec.name), spec.period)
            .agg(F.count(F.lit(1)).alias("entity_count"),
                 F.sum("funding").alias("funding"),
                 F.sum("deals").alias("deals"),
                 F.sum("big_deals").alias("big_deals")))


def supply_source(spark: SparkSession, sf_dir: str, spec: PanelSpec = SPEC) -> DataFrame:
    """Source B: per (nation, year) shipped volume and mean discount, tax and price."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_suppkey", "l_quantity", "l_discount", "l_tax", "l_extendedprice", "l_shipdate"])
    per_supp = (li.groupBy(F.col("l_suppkey").alias("suppkey"), F.year("l_shipdate").alias(spec.period))
                .agg(F.sum("l_quantity").alias("q"), F.sum("l_discount").alias("d"),
                     F.sum("l_tax").alias("t"), F.sum("l_extendedprice").alias("p"),
                     F.count(F.lit(1)).alias("n")))
    supplier = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    return (per_supp
            .join(supplier, per_supp["suppkey"] == supplier["s_suppkey"])
            .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
            .groupBy(F.col("n_nationkey").alias(spec.key), F.col("n_name").alias(spec.name), spec.period)
            .agg(F.sum("q").alias("volume"),
                 (F.sum("d") / F.sum("n")).alias("disc"),
                 (F.sum("t") / F.sum("n")).alias("tax"),
                 (F.sum("p") / F.sum("n")).alias("price")))


def merge_sources(a: DataFrame, b: DataFrame, spec: PanelSpec = SPEC) -> DataFrame:
    """JN-1: inner equi-join of the two sources on (key, name, period)."""
    return a.join(b, [spec.key, spec.name, spec.period], "inner")


def with_merge_features(df: DataFrame, spec: PanelSpec = SPEC) -> DataFrame:
    """Derived columns of the merge stage (PRJ-1/2/3, WIN-1/2).

    growth columns are NULL in each entity's first period, as in the reference.
    """
    w = Window.partitionBy(spec.key).orderBy(spec.period)
    y = F.col(spec.period)
    return df.withColumns({
        "period": S.period_label(y, spec.during_start, spec.post_start),
        "is_partial": S.flag(y == spec.partial_year),
        "density": S.safe_ratio("entity_count", "volume"),
        "intensity": S.safe_ratio("funding", "price"),
        "big_rate": S.safe_ratio("big_deals", "entity_count", 1000.0),
        "entity_growth_yoy": growth_pct(F.col("entity_count"), w),
        "funding_growth_yoy": growth_pct(F.col("funding"), w),
        "is_during": S.flag(y.isin(list(range(spec.during_start, spec.post_start)))),
        "is_post": S.flag(y >= spec.post_start),
    })


def growth_pct(x, w) -> "F.Column":
    """WIN-2: (x − lag x) / lag x · 100; NULL in the first row and for a zero lag."""
    prev = F.lag(x, 1).over(w)
    return S.safe_ratio(x - prev, prev, 100.0)


def panel(spark: SparkSession, sf_dir: str, spec: PanelSpec = SPEC) -> DataFrame:
    """The merged panel with merge-stage features."""
    return with_merge_features(merge_sources(demand_source(spark, sf_dir, spec),
                                             supply_source(spark, sf_dir, spec), spec), spec)


# --- DuckDB twin of the panel, used by oracle SQL (same definitions as above) ---
PANEL_SQL = """
src_a AS (
  SELECT n_nationkey AS k, n_name AS nation, CAST(year(o_orderdate) AS INTEGER) AS yr,
         count(DISTINCT o_custkey) AS entity_count, sum(o_totalprice) AS funding, count(*) AS deals,
         CAST(sum(CASE WHEN o_totalprice >= 450000 THEN 1 ELSE 0 END) AS BIGINT) AS big_deals
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY n_nationkey, n_name, year(o_orderdate)),
src_b AS (
  SELECT n_nationkey AS k, n_name AS nation, CAST(year(l_shipdate) AS INTEGER) AS yr,
         sum(l_quantity) AS volume, avg(l_discount) AS disc, avg(l_tax) AS tax, avg(l_extendedprice) AS price
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY n_nationkey, n_name, year(l_shipdate)),
merged AS (
  SELECT a.k, a.nation, a.yr, entity_count, funding, deals, big_deals, volume, disc, tax, price
  FROM src_a a JOIN src_b b ON a.k = b.k AND a.nation = b.nation AND a.yr = b.yr),
panel AS (
  SELECT *,
    CASE WHEN yr < 1998 THEN 'pre' WHEN yr < 2000 THEN 'during' ELSE 'post' END AS period,
    CAST(yr = 2001 AS INTEGER) AS is_partial,
    entity_count / nullif(volume, 0) AS density,
    funding / nullif(price, 0) AS intensity,
    big_deals / nullif(entity_count, 0) * 1000 AS big_rate,
    (entity_count - lag(entity_count) OVER (PARTITION BY k ORDER BY yr))
      / nullif(lag(entity_count) OVER (PARTITION BY k ORDER BY yr), 0) * 100 AS entity_growth_yoy,
    (funding - lag(funding) OVER (PARTITION BY k ORDER BY yr))
      / nullif(lag(funding) OVER (PARTITION BY k ORDER BY yr), 0) * 100 AS funding_growth_yoy,
    CAST(yr IN (1998, 1999) AS INTEGER) AS is_during,
    CAST(yr >= 2000 AS INTEGER) AS is_post
  FROM merged)"""


def with_panel(sql: str) -> str:
    """Prefix a query with the panel CTEs; the query may add its own CTEs after a comma."""
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + PANEL_SQL + ",\n" + body[5:]
    return "WITH " + PANEL_SQL + "\n" + body
