"""Centroid clustering whose lower bounds are loosened by geometry instead of by full drift.

All vectors of a cluster lie in a sphere around its centroid whose radius is the largest
upper bound among them.  When another centroid moves from a to b, the distance of a vector
x to it shrinks by |x - a| - |x - b|.  With m the middle of a and b and w = x - m this is
2 |b - a| |w| cos / (|x - a| + |x - b|), where cos belongs to the angle between w and the
move; as |x - a| + |x - b| lies between 2 |w| and 2 |w| + |b - a|, the loss is at most
|b - a| cos, and negative where cos is.  In the plane through a, b and the sphere's centre the
smallest angle of any x of the sphere is the centre's angle less the half angle under
which m sees the sphere.  So a centroid that moves past a sphere or away from it takes little
or nothing from the bounds of the vectors inside, where drift alone would take it all.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import Rounds
from panelforge.llm.lloyd import SLACK, constants, finite, integer_vectors, lloyd, measured


def loss(a: np.ndarray, b: np.ndarray, centre: np.ndarray, radius: float) -> float:
    """Largest |x - a| - |x - b| of any x in the sphere, bounded from above; negative if all of them get further away."""
    drift = float(np.linalg.norm(b - a))
    if not drift:
        return 0.0
    middle = (a + b) / 2
    away = float(np.linalg.norm(centre - middle))
    if radius >= away:
        return drift
    angle = np.arccos(np.clip((centre - middle) @ (b - a) / (away * drift), -1, 1)) - np.arcsin(radius / away)
    if angle <= 0:
        return drift
    cos = float(np.cos(angle))
    near = away - radius
    return drift * cos if cos >= 0 else drift * cos * near / (near + drift / 2)


class SphereBounds:
    """Bounds carried from round to round: upper ones grow by their centroid's drift, each lower one loses what geometry demands.

    Every centroid is a group of its own; a vector of cluster i keeps a bound for each other
    centroid j, which loses the bound of the sphere of i against the move of j.
    """

    def start(self, books: np.ndarray) -> None:
        pass

    def moved(self, state: DataFrame, old: np.ndarray, new: np.ndarray) -> DataFrame:
        code = F.col("code")[0]
        radius = dict(state.groupBy(code.alias("c")).agg(F.max(F.col("upper")[0]).alias("r")).collect())
        a, b = old[0].astype(float), new[0].astype(float)
        n = len(a)
        drift = np.linalg.norm(b - a, axis=1)
        taken = np.array([[loss(a[j], b[j], a[i], radius.get(i, 0.0) + SLACK) + SLACK for j in range(n)] for i in range(n)])
        # any x of cluster i with an upper bound u is at least |b_i - b_j| - u away from b_j
        apart = np.linalg.norm(b[:, None] - b[None], axis=2)
        state = state.withColumn("upper", F.array(F.col("upper")[0] + F.get(constants(drift), code)))
        lost, gap = constants(taken), constants(apart)
        least = F.transform("lower", lambda l, j: F.when(j == code, F.lit(1e300)).otherwise(F.greatest(
            l - F.get(lost, code * n + j), F.get(gap, code * n + j) - F.col("upper")[0])))
        state = state.withColumn("least", least)
        return (state.withColumn("lower", F.transform("least", lambda l: F.least(l, F.lit(3e38)).cast("float") - F.lit(1.0).cast("float") / 64))
                .withColumn("most", F.col("upper")))


def cluster(vectors: DataFrame, clusters: int = 8, rounds: int = 10, size: int = 64, salt: str = "3:",
            scanned: list[tuple[int, int]] | None = None) -> DataFrame:
    """Clusters of all vectors with exactly ``size`` components, none null or non-finite; other rows are dropped.

    Returns vec_id, cluster, distance (squared, to the final centroid), cluster_inertia and
    inertia (distance summed over the cluster, over all) and centroid_sha256 (of the final
    centroid's components as decimal integers joined by commas), one row per vector kept.
    Components become floor(1024 * x); one of 2^16 or more raises an error.  The first
    centroids are the vectors with the smallest sha256 of salt + vec_id, ties by the
    components; rows with a null vec_id come last there and are clustered like all others.
    Repeated rows count as often as they occur; with fewer vectors than clusters there are
    fewer centroids; no vectors give no rows.  Other columns are ignored.  ``scanned``
    receives (vectors read, distances computed) of each assignment.
    """
    spark = vectors.sparkSession
    rows = integer_vectors(vectors, finite(size), [])
    order = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(order.asc_nulls_last(), "x").limit(clusters).select("x").collect()
    if not first:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
                                         "centroid_sha256 string")
    books = np.array([r.x for r in first], np.int64)[None]
    tables = Rounds(spark, "centroids")
    state, books, seen = lloyd(rows, books, rounds, books.shape[1], SphereBounds(), tables)
    if scanned is not None:
        scanned += seen
    out = measured(rows, state, books, []).select("vec_id", F.col("code")[0].alias("cluster"), "distance")
    tables.clear()
    sums = {r.cluster: int(r.s) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
            .collect()}
    named = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in books[0].tolist()]
    table = spark.createDataFrame([(c, s, sum(sums.values()), named[c]) for c, s in sums.items()],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # one row a cluster: bounded by the parameter
    return out.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
