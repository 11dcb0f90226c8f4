"""Connected components of a link table as iterated Spark joins; nothing is collected to the driver but one flag a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import cut


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``; component is the smallest node reachable.

    Alternating star contraction: every node hands its smallest neighbour to its larger
    neighbours (large star), then to its smaller ones (small star), until the links are
    stars.  Each neighbour minimum is a map-side combined aggregate, written
    before it is joined back, so that a node with very many links is split by AQE.
    Self links and repeated links are allowed; null ends are dropped; no links give no rows.
    """
    edges = (links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
             .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("u") != F.col("v"))).distinct())
    edges = cut(edges)
    for _ in range(rounds):
        if _are_stars(edges):
            break
        edges = _star(_star(edges, large=True), large=False)
    else:
        raise RuntimeError("components did not settle")
    own = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return own.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour only and that one has none: the links then name the components."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up")).union(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up")))
    each = ends.groupBy("x").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return each.where("ups > 1 or (ups = 1 and least = 0)").limit(1).count() == 0


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u > v)."""
    if large:  # neighbours of x on both sides; the larger ones move to the smallest
        sides = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).union(
            edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = cut(sides.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m")))
        out = (sides.where(F.col("y") > F.col("x")).join(least, "x")
               .select(F.col("y").alias("u"), F.col("m").alias("v")))
        # every x itself stays linked with its smallest neighbour
        out = out.union(least.where(F.col("x") > F.col("m")).select(F.col("x").alias("u"), F.col("m").alias("v")))
    else:  # smaller neighbours and x itself move to the smallest of them
        least = cut(edges.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m")))
        out = (edges.withColumnRenamed("u", "x").join(least, "x").where(F.col("v") != F.col("m"))
               .select(F.col("v").alias("u"), F.col("m").alias("v")))
        out = out.union(least.select(F.col("x").alias("u"), F.col("m").alias("v")))
    return cut(out.where(F.col("u") > F.col("v")).distinct())
