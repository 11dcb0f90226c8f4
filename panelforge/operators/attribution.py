"""Tree attributions (path-dependent Shapley values) on relations.

A fitted ensemble becomes a path table: one row per (tree, leaf, feature) with the interval
the path leaves open and the share of training rows that follow the path where the feature
is unknown.  Rows of data fall into cells of the grid of all thresholds, and rows of a cell
share their attributions.  A cell's values are joined with the path table by interval; the
features that hold on a leaf's path form a bit mask, and the Shapley weights of a mask come
from the coefficients of prod(share + holds * t) over the other features, folded column
by column.  Leaves on whose path nothing holds add a constant, so only leaves with a bit set
are joined.  Everything runs in the JVM; work follows the number of cells.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.session import materialize

#: Path rows up to this number are broadcast; above it the join is left to the planner.
BROADCAST_ROWS = 200_000


def model_nodes(model) -> tuple[DataFrame, int]:
    """Nodes (tree, id, left, right, feature, threshold, cover, value) of a fitted Spark ensemble, and its depth.

    The model's own writer stores the node table, which is read back as a relation.  Values
    carry the tree's weight: forests average their trees, boosted trees are a weighted sum.
    """
    from pyspark.ml.regression import RandomForestRegressionModel
    from pyspark.sql import SparkSession

    from panelforge.sources.sinks import new_scratch
    spark = SparkSession.getActiveSession()
    path = new_scratch(spark, "ensemble")
    model.write().overwrite().save(path)
    scale = 1.0 / model.getNumTrees if isinstance(model, RandomForestRegressionModel) else 1.0
    weights = spark.createDataFrame([(i, float(w) * scale) for i, w in enumerate(model.treeWeights)], "tree int, weight double")
    d = F.col("nodeData")
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").cast("int").alias("tree"), d["id"].alias("id"), d["leftChild"].alias("left"),
        d["rightChild"].alias("right"), d["split"]["featureIndex"].alias("feature"),
        F.get(d["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        F.coalesce(F.get(d["impurityStats"], F.lit(0)), d["rawCount"].cast("double")).alias("cover"), d["prediction"].alias("p"))
    nodes = nodes.join(F.broadcast(weights), "tree").withColumn("value", F.col("p") * F.col("weight")).drop("p", "weight")
    return nodes, max((t.depth for t in model.trees), default=0)


def path_table(nodes: DataFrame, depth: int) -> DataFrame:
    """Leaves (tree, leaf, value, items): items holds (feature, lo, hi, share) once per feature of the path, lo < x <= hi.

    Splits of one feature on a path are merged: the tightest interval, the product of the shares.
    Trees of a single leaf have no items.
    """
    child = nodes.select(F.col("tree").alias("t"), F.col("id").alias("c"), F.col("cover").alias("child_cover"))
    inf = F.lit(float("inf"))
    sides = F.explode(F.array(
        F.struct(F.col("left").alias("child"), (-inf).alias("lo"), F.col("threshold").alias("hi")),
        F.struct(F.col("right").alias("child"), F.col("threshold").alias("lo"), inf.alias("hi")))).alias("s")
    edges = nodes.where("left >= 0").select("tree", F.col("id").alias("parent"), "feature", "cover", sides)
    edges = (edges.join(child, (F.col("tree") == F.col("t")) & (F.col("s.child") == F.col("c")))
             .select("tree", "parent", F.col("s.child").alias("child"),
                     F.struct("feature", "s.lo", "s.hi", (F.col("child_cover") / F.col("cover")).alias("share")).alias("item")))
    edges = materialize(edges)
    none = F.array().cast("array<struct<feature:int,lo:double,hi:double,share:double>>")
    level = nodes.where("id = 0").select("tree", F.col("id").alias("at"), none.alias("items"))
    ends = nodes.where("left < 0").select("tree", F.col("id").alias("at"), "value")
    leaves = [level.join(ends, ["tree", "at"])]
    for _ in range(depth):
        level = (level.withColumnRenamed("at", "parent").join(edges, ["tree", "parent"])
                 .select("tree", F.col("child").alias("at"), F.concat("items", F.array("item")).alias("items")))
        level = materialize(level)
        leaves.append(level.join(ends, ["tree", "at"]))
    whole = reduce(DataFrame.unionByName, leaves).withColumnRenamed("at", "leaf")
    merged = F.transform(F.array_sort(F.array_distinct(F.transform("items", lambda i: i["feature"]))), lambda f: F.struct(
        f.alias("feature"),
        F.array_max(F.transform(F.filter("items", lambda i: i["feature"] == f), lambda i: i["lo"])).alias("lo"),
        F.array_min(F.transform(F.filter("items", lambda i: i["feature"] == f), lambda i: i["hi"])).alias("hi"),
        F.aggregate(F.filter("items", lambda i: i["feature"] == f), F.lit(1.0), lambda a, i: a * i["share"]).alias("share")))
    return materialize(whole.select("tree", "leaf", "value", merged.alias("items")))


def _total(items: Column, start: Column) -> Column:
    return F.aggregate(items, start, lambda a, i: a * i["share"])


def _bit(slot: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), slot)


def _holds(mask: Column, slot: Column) -> Column:
    return F.call_function("shiftright", mask, slot).bitwiseAND(F.lit(1)).cast("double")


def mask_weights(leaves: DataFrame, masks: DataFrame) -> DataFrame:
    """(tree, leaf, mask, feature, phi): what a leaf adds to a feature where exactly the mask's path features hold,
    less what it adds where none does; and as feature -1 its value where all hold."""
    m = F.size("items")
    of = leaves.join(masks, ["tree", "leaf"])
    of = of.select("tree", "leaf", "mask", "value", "items", F.posexplode("items").alias("slot", "own"))
    others = F.transform("items", lambda i, j: F.struct(i["share"].alias("z"), _holds(F.col("mask"), j).alias("o"), j.alias("j")))
    others = F.filter(others, lambda i: i["j"] != F.col("slot"))
    zero = F.array(F.lit(0.0))
    poly = F.aggregate(others, F.array(F.lit(1.0)), lambda a, i: F.zip_with(
        F.concat(a, zero), F.concat(zero, a), lambda same, up: i["z"] * same + i["o"] * up))
    shapley = F.aggregate(F.transform(poly, lambda c, k: c * F.factorial(k) * F.factorial(m - 1 - k) / F.factorial(m)),
                          F.lit(0.0), lambda a, c: a + c)
    phi = (_holds(F.col("mask"), F.col("slot")) - F.col("own.share")) * F.col("value") * shapley
    none = -_total(F.col("items"), F.col("value")) / m
    rows = of.select("tree", "leaf", "mask", F.col("own.feature").alias("feature"), (phi - none).alias("phi"))
    full = leaves.join(masks, ["tree", "leaf"]).where(F.col("mask") == _bit(m) - 1)
    return rows.unionByName(full.select("tree", "leaf", "mask", F.lit(-1).alias("feature"), F.col("value").alias("phi")))


def cell_attributions(data: DataFrame, nodes: DataFrame, depth: int, features: Sequence[str]) -> tuple[DataFrame, Callable]:
    """Cells (cell, n, phi, expected, prediction) of ``data`` and a function that adds the column cell to rows.

    phi is an array over ``features``.  Rows with a null or NaN feature must be gone.
    """
    feats = list(features)
    spark = data.sparkSession
    leaves = path_table(nodes, depth)
    paths = leaves.select("tree", "leaf", F.posexplode("items").alias("slot", "i")).select(
        "tree", "leaf", _bit(F.col("slot")).alias("bit"), "i.*")
    ends = paths.select("feature", F.explode(F.array("lo", "hi")).alias("t")).where(F.abs("t") < float("inf"))
    ends = ends.groupBy("feature").agg(F.sort_array(F.collect_set("t")).alias("ts"))
    cuts = materialize(ends.agg(F.map_from_entries(F.collect_list(F.struct("feature", "ts"))).alias("_cuts")))  # one row

    def below(i: int, name: str) -> Column:
        own = F.coalesce(F.try_element_at("_cuts", F.lit(i)), F.array().cast("array<double>"))
        return F.size(F.filter(own, lambda t: t < F.col(name).cast("double")))

    def celled(rows: DataFrame) -> DataFrame:
        own = F.array(*[below(i, f) for i, f in enumerate(feats)])
        return rows.join(F.broadcast(cuts)).withColumn("cell", own).drop("_cuts")

    cells = (celled(data).select("cell", F.array(*[F.col(f).cast("double") for f in feats]).alias("x"))
             .groupBy("cell").agg(F.any_value("x").alias("x"), F.count(F.lit(1)).alias("n")))
    cells = materialize(cells.withColumn("c", F.monotonically_increasing_id()))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    values = cells.select("c", "x").repartition(n, "c").select("c", F.posexplode("x").alias("feature", "v"))
    side = F.broadcast(paths) if paths.count() <= BROADCAST_ROWS else paths
    hits = (values.join(side, "feature").where((F.col("v") > F.col("lo")) & (F.col("v") <= F.col("hi")))
            .groupBy("c", "tree", "leaf").agg(F.sum("bit").cast("int").alias("mask")))
    hits = materialize(hits)
    weights = materialize(mask_weights(leaves, hits.select("tree", "leaf", "mask").distinct()))
    found = (hits.join(weights, ["tree", "leaf", "mask"]).groupBy("c", "feature").agg(F.sum("phi").alias("phi"))
             .groupBy("c").agg(F.map_from_entries(F.collect_list(F.struct("feature", "phi"))).alias("found")))
    base = leaves.where(F.size("items") > 0).select(
        F.explode("items").alias("i"), (-_total(F.col("items"), F.col("value")) / F.size("items")).alias("b"))
    base = base.groupBy("i.feature").agg(F.sum("b").alias("b"))
    base = base.agg(F.map_from_entries(F.collect_list(F.struct("feature", "b")))).scalar()
    expected = leaves.agg(F.sum(_total(F.col("items"), F.col("value")))).scalar()
    lone = leaves.agg(F.coalesce(F.sum(F.when(F.size("items") == 0, F.col("value"))), F.lit(0.0))).scalar()

    def of(m: Column, key: int) -> Column:
        return F.coalesce(F.try_element_at(m, F.lit(key)), F.lit(0.0))
    out = cells.join(found, "c", "left").select(
        "cell", "n", F.array(*[of(F.col("found"), i) + of(base, i) for i in range(len(feats))]).alias("phi"),
        expected.alias("expected"), (of(F.col("found"), -1) + lone).alias("prediction"))
    return materialize(out), celled


def attributions(data: DataFrame, nodes: DataFrame, depth: int, features: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """XAI-1: long rows (ids, feature, value, phi) plus the row's ``expected`` and ``prediction``; rows with a null feature are dropped."""
    feats = list(features)
    rows = data.select(*ids, *feats).dropna(subset=feats)
    cells, celled = cell_attributions(rows, nodes, depth, feats)
    long = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"),
                                        F.get("phi", F.lit(i)).alias("phi")) for i, f in enumerate(feats)])).alias("a")
    return (celled(rows).join(cells, "cell")
            .select(*ids, long, "expected", "prediction").select(*ids, "a.*", "expected", "prediction"))
