"""Clustering entities (CLU-1..10) with k-means.

K-means: Spark ML picks the first centers of every restart; all restarts, whatever their k or
their weights, then share the rounds, so a round reads the points once and is one job.

Silhouette: the Euclidean form needs every point's distance to every other point;
points are dealt to strips, pairs of strips meet in tiles that give distance sums per point
and cluster, and these are added up.  Several clusterings of the same points share the distances.  The squared-Euclidean form decomposes into per-cluster sums
(count, Σy, Σ‖y‖²) and costs one pass.  The metric is a parameter and means the same at any size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.operators.features import zscore
from panelforge.operators.filters import numeric_columns
from panelforge.session import at_once, materialize

SILHOUETTE_STRIP = 16_384  # points of a strip of the Euclidean silhouette; a tile holds two strips and is a task of its own
#: Squared distances below this share of the squared norms are taken from the differences instead of the products.
NEAR = 1e-6
BLOCK = 2048  # points that a k-means round multiplies at once
TASK = 2 * BLOCK  # least points of a task of such a round, while there are more cores than that takes
FEATURES = "features"


def prepare_cluster_features(df: DataFrame, key: str, exclude_substrings: Sequence[str] = (),
                             drop_suffix: str = "_scaled") -> tuple[DataFrame, list[str]]:
    """CLU-1: numeric columns minus exclusions → mean per key → NULL→0 → z-score (population σ)."""
    feats = [c for c in numeric_columns(df) if c != key and not c.endswith(drop_suffix)
             and not any(s.lower() in c.lower() for s in exclude_substrings)]
    means = df.groupBy(key).agg(*[F.avg(c).alias(c) for c in feats]).na.fill(0.0, subset=feats)
    z = zscore(means, feats, suffix="_z")
    return z.select(key, *[F.col(f"{c}_z").alias(c) for c in feats]), feats


def vectors(df: DataFrame, features: Sequence[str] | str) -> DataFrame:
    """Feature vector column from named columns or from one array column."""
    if isinstance(features, str):
        from pyspark.ml.functions import array_to_vector
        return df.withColumn(FEATURES, array_to_vector(F.col(features).cast("array<double>")))
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES).transform(df)


class Centers(NamedTuple):
    """A fitted k-means: its centers and the inertia of its last round."""
    centers: np.ndarray
    cost: float

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the number of the nearest center (ties: the smaller) as ``prediction``."""
        centers = self.centers

        def near(x: pd.Series) -> pd.Series:
            points = np.stack(x.to_numpy())
            return pd.Series(_squares(points, centers).argmin(axis=1).astype("int32"))

        return df.withColumn("prediction", F.pandas_udf(near, "int")(vector_to_array(FEATURES)))


def _squares(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of points (rows) to centers (columns)."""
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * (x @ centers.T) + (centers * centers).sum(axis=1), 0.0)


def first_centers(jobs: Sequence[tuple[DataFrame, int, int]], weight: str | None = None) -> list[np.ndarray]:
    """First centers of k-means (k-means|| init) for each (points, k, seed), several at a time."""
    def start(points: DataFrame, k: int, seed: int) -> np.ndarray:
        km = KMeans(k=k, seed=seed, featuresCol=FEATURES, maxIter=0, initMode="k-means||")
        if weight:
            km = km.setWeightCol(weight)
        return np.array(km.fit(points).clusterCenters(), dtype=float)

    return at_once(jobs[0][0].sparkSession, [lambda job=job: start(*job) for job in jobs])


def point_blocks(df: DataFrame, weights: str | None = None) -> RDD:
    """Points as blocks (x, w): a matrix of features and, per point, its weights (an array column) or None.

    Spread over all cores, but no thinner than TASK points a task: a round over few points is as long as its tasks take to start.
    """
    n = min(df.sparkSession.sparkContext.defaultParallelism, max(1, -(-df.count() // TASK)))
    rows = df.select(vector_to_array(FEATURES), *([F.col(weights).cast("array<double>")] if weights else [])).repartition(n)

    def blocks(rows: Iterator) -> Iterator:
        held = []
        for row in rows:
            held.append(row)
            if len(held) == BLOCK:
                yield packed(held)
                held = []
        if held:
            yield packed(held)

    def packed(held: list) -> tuple[np.ndarray, np.ndarray | None]:
        return np.array([r[0] for r in held], float), np.array([r[1] for r in held], float) if weights else None

    return rows.rdd.mapPartitions(blocks).persist(StorageLevel.MEMORY_AND_DISK)


def lloyd(blocks: RDD, starts: Sequence[np.ndarray], max_iter: int = 300, tol: float = 1e-6,
          own_weight: bool = True) -> list[Centers]:
    """Rounds of k-means from every set of first centers at once; a set whose centers move no more than ``tol`` is done.

    With weights in the blocks, set r counts points by their weight r (``own_weight``) or all sets by the only one.
    """
    found = [Centers(c, 0.0) for c in starts]
    active = list(range(len(starts)))
    for _ in range(max_iter):
        if not active:
            break
        sets = [(r, found[r].centers) for r in active]
        every = np.concatenate([c for _, c in sets])
        ends = np.cumsum([len(c) for _, c in sets]).tolist()

        def sums(part: Iterator, sets=sets, every=every, ends=ends) -> Iterator:
            total, cost = np.zeros((len(every), every.shape[1] + 1)), np.zeros(len(sets))
            for x, w in part:
                squares, member = _squares(x, every), np.zeros((len(x), len(every)))
                at = np.arange(len(x))
                for i, (r, centers) in enumerate(sets):
                    own = squares[:, ends[i] - len(centers): ends[i]]
                    near = own.argmin(axis=1)
                    weight = 1.0 if w is None else w[:, r if own_weight else 0]
                    member[at, ends[i] - len(centers) + near] = weight
                    cost[i] += (own[at, near] * weight).sum()
                total[:, :-1] += member.T @ x
                total[:, -1] += member.sum(axis=0)
            yield total, cost

        total, cost = blocks.mapPartitions(sums).treeReduce(lambda a, b: (a[0] + b[0], a[1] + b[1]))
        left = []
        for i, (r, centers) in enumerate(sets):
            own = total[ends[i] - len(centers): ends[i]]
            held = own[:, -1:] > 0
            moved = np.where(held, own[:, :-1] / np.where(held, own[:, -1:], 1.0), centers)
            if (((moved - centers) ** 2).sum(axis=1) > tol * tol).any():
                left.append(r)
            found[r] = Centers(moved, float(cost[i]))
        active = left
    return found


def _lowest(fits: Sequence[Centers]) -> Centers:
    """The fit of the lowest inertia; the first of those that differ by rounding only."""
    least = min(f.cost for f in fits)
    return next(f for f in fits if not f.cost > least + 1e-9 * abs(least))


def fit_kmeans_of(df: DataFrame, ks: Sequence[int], restarts: int = 50, seed: int = 42, weight: str | None = None,
                  max_iter: int = 300) -> list[tuple[Centers, float]]:
    """The best fit over ``restarts`` seeds for every k; all restarts of all k share their rounds."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    starts = first_centers([(held, k, seed + r) for k in ks for r in range(restarts)], weight)
    points = held.withColumn("_w", F.array(F.col(weight).cast("double"))) if weight else held
    blocks = point_blocks(points, "_w" if weight else None)
    fits = lloyd(blocks, starts, max_iter, own_weight=False)
    blocks.unpersist()
    held.unpersist()
    best = [_lowest(fits[i * restarts: (i + 1) * restarts]) for i in range(len(ks))]
    return [(m, m.cost) for m in best]


def fit_kmeans(df: DataFrame, k: int, restarts: int = 50, seed: int = 42, weight: str | None = None,
               max_iter: int = 300) -> tuple[Centers, float]:
    """CLU-3: k-means (k-means|| init) over ``restarts`` seeds; the lowest inertia wins."""
    return fit_kmeans_of(df, [k], restarts, seed, weight, max_iter)[0]


def silhouette(df: DataFrame, label: str, metric: str = "euclidean", id_col: str | None = None) -> DataFrame:
    """CLU-4: per-point silhouette (b − a)/max(a, b) under ``metric`` ("euclidean" or "sqeuclidean")."""
    pts = df.select(*([id_col] if id_col else []), label, vector_to_array(FEATURES).alias("_x"))
    if metric == "sqeuclidean":
        return _silhouette_sq(pts, label, id_col)
    if metric != "euclidean":
        raise ValueError(f"unknown metric {metric}")
    return _silhouette_tiles(pts, label, id_col)


def strips_of(n: int) -> int:
    """Strips for n points: as many as a strip's size bound needs, at least a few for parallel tiles."""
    return max(1, -(-n // SILHOUETTE_STRIP), min(12, -(-n // 256)))


def _tiles(pts: DataFrame, n: int) -> DataFrame:
    """Points (_pid, _x, ...) dealt to strips (_s) and copied to every tile (_i, _j) of their strip, _i <= _j."""
    g = strips_of(n)
    own = pts.withColumn("_s", F.pmod(F.xxhash64("_pid"), F.lit(g)).cast("int"))
    both = own.withColumn("_o", F.explode(F.sequence(F.lit(0), F.lit(g - 1))))
    return both.withColumns({"_i": F.least("_s", "_o"), "_j": F.greatest("_s", "_o")}).drop("_o")


def _by_tile(tiles: DataFrame, n: int, sums: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """``sums`` of every tile of n points, one task a tile: a hash would deal several to some tasks, and few bytes of a tile are long work."""
    g = strips_of(n)
    tile = (F.col("_j") * (F.col("_j") + 1) / 2).cast("int") + F.col("_i")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield from sums(pa.Table.from_batches(held)).to_batches(max_chunksize=BLOCK)

    return tiles.repartitionById(g * (g + 1) // 2, tile).mapInArrow(whole, schema)


def _strips(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, points, places of strip _i, places of strip _j) of a tile."""
    strip, pid = table.column("_s").to_numpy(), table.column("_pid").to_numpy()
    x = table.column("_x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(pid), -1)
    return pid, x, np.flatnonzero(strip == table.column("_i")[0].as_py()), np.flatnonzero(strip == table.column("_j")[0].as_py())


def _distances(a: np.ndarray, b: np.ndarray, aa: np.ndarray, bb: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows of a to rows of b with squared norms aa, bb.

    From the products, which cancel for points that are close for their norms: those (and
    values that are not finite) are taken from the differences.
    """
    with np.errstate(all="ignore"):
        top = aa[:, None] + bb[None, :]
        d = a @ b.T
        d *= -2
        d += top
        i, j = np.nonzero(~(d > NEAR * top))
        for at in range(0, len(i), 8192):
            p, q = i[at: at + 8192], j[at: at + 8192]
            d[p, q] = ((a[p] - b[q]) ** 2).sum(axis=1)
        return np.sqrt(d, out=d)


def _pair_sums(x: np.ndarray, rows: np.ndarray, cols: np.ndarray, member: np.ndarray) -> np.ndarray:
    """Per point of a tile its distances to the other strip, added up by the columns of ``member`` (weights of the points)."""
    total, norms = np.zeros((len(x), member.shape[1])), (x * x).sum(axis=1)
    same = len(rows) > 0 and len(cols) > 0 and rows[0] == cols[0]
    for start in range(0, len(cols), 1024):
        c = cols[start: start + 1024]
        b, bb, mb = x[c], norms[c], member[c]
        for at in range(0, len(rows), 512):
            r = rows[at: at + 512]
            d = _distances(x[r], b, norms[r], bb)
            total[r] += d @ mb
            if not same:
                total[c] += d.T @ member[r]
    return total


def _silhouette_tiles(pts: DataFrame, label: str, id_col: str | None) -> DataFrame:
    """Distance sums from a triangle of tiles: points are dealt to g strips, and a tile holds two strips (or one, on the diagonal).

    Every pair of strips meets in one tile, which adds its distances to both sides, so a point
    is copied g times, about the square root of twice the number of tiles, and no distance is
    computed twice.  A strip has a bounded number of points whatever the size of the data.
    """
    keep = [*([id_col] if id_col else []), label]
    pts = materialize(pts.withColumn("_pid", F.monotonically_increasing_id()))
    n = pts.count()
    tiles = _tiles(pts.select("_pid", F.col(label).alias("_l"), "_x"), n)
    kind = pts.schema[label].dataType.simpleString()

    def sums(table: pa.Table) -> pa.Table:
        pid, x, rows, cols = _strips(table)
        codes = table.column("_l").combine_chunks().dictionary_encode()
        lab, names = codes.indices.to_numpy(zero_copy_only=False), codes.dictionary
        member = np.eye(len(names))[lab]
        total = _pair_sums(x, rows, cols, member)
        seen = np.zeros_like(total)
        seen[rows] = member[cols].sum(axis=0)
        seen[cols] = member[rows].sum(axis=0)
        p, m = np.nonzero(seen)
        return pa.table({"_pid": pid[p], "_l": names.take(pa.array(lab[p])), "_m": names.take(pa.array(m)),
                         "_total": total[p, m], "_n": seen[p, m].astype(np.int64)})

    part = _by_tile(tiles, n, sums, f"_pid long, _l {kind}, _m {kind}, _total double, _n long")
    per = part.groupBy("_pid", "_l", "_m").agg(F.sum("_total").alias("_total"), F.sum("_n").alias("_n"))
    same = F.col("_l") == F.col("_m")
    ab = per.groupBy("_pid").agg(
        F.max(F.when(same & (F.col("_n") > 1), F.try_divide(F.col("_total"), F.col("_n") - 1))).alias("_a"),
        F.min(F.when(~same, F.try_divide(F.col("_total"), F.col("_n")))).alias("_bb"))
    b = F.coalesce("_bb", F.lit(0.0))
    value = F.when(F.col("_a").isNull(), 0.0).otherwise(
        F.coalesce(F.try_divide(b - F.col("_a"), F.greatest(F.col("_a"), b)), F.lit(0.0)))
    return pts.join(ab, "_pid", "left").select(*keep, value.alias("silhouette"))


def _silhouette_sq(pts: DataFrame, label: str, id_col: str | None) -> DataFrame:
    """The squared-Euclidean form from per-cluster count, sum and sum of squares: one row of k * d numbers, joined to all points."""
    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda t, v: t + v)

    per_dim = (pts.select(label, F.posexplode("_x").alias("_d", "_v")).groupBy(label, "_d").agg(F.sum("_v").alias("_s"))
               .groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("_d", "_s"))), lambda r: r["_s"]).alias("s")))
    sizes = pts.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.sum(dot(F.col("_x"), F.col("_x"))).alias("ss"))
    stats = sizes.join(per_dim, label).agg(F.collect_list(F.struct(F.col(label).alias("l"), "n", "ss", "s")).alias("_stats"))
    rows = pts.join(F.broadcast(materialize(stats))).withColumn("_xx", dot(F.col("_x"), F.col("_x")))
    mean = F.transform("_stats", lambda c: F.struct(c["l"].alias("l"), c["n"].alias("n"), (
        (F.col("_xx") * c["n"] - 2 * dot(F.col("_x"), c["s"]) + c["ss"]) / c["n"]).alias("m")))
    rows = rows.withColumn("_means", mean)
    own = F.get(F.filter("_means", lambda c: c["l"] == F.col(label)), F.lit(0))
    a = own["m"] * F.try_divide(own["n"], own["n"] - 1)
    b = F.coalesce(F.array_min(F.transform(F.filter("_means", lambda c: c["l"] != F.col(label)), lambda c: c["m"])), F.lit(0.0))
    value = F.when((own["n"] > 1) & (F.greatest(a, b) > 0), F.try_divide(b - a, F.greatest(a, b))).otherwise(0.0)
    return rows.select(*([id_col] if id_col else []), label, value.alias("silhouette"))


def mean_silhouettes(df: DataFrame, fits: Sequence[Centers], weights: str | None = None) -> list[float]:
    """Mean Euclidean silhouette of the points under each fit, from one pass over all distances.

    With ``weights`` (array column of whole numbers) fit f counts a point weights[f] times, as if its copies were rows.
    """
    ends = np.cumsum([len(f.centers) for f in fits]).tolist()
    begins = [0, *ends[:-1]]
    centers, q, one = [f.centers for f in fits], ends[-1], weights is None
    pts = df.select(vector_to_array(FEATURES).alias("_x"), *([] if one else [F.col(weights).cast("array<double>").alias("_w")]))
    pts = materialize(pts.withColumn("_pid", F.monotonically_increasing_id()))
    n_points = pts.count()
    tiles = _tiles(pts, n_points)

    def members(x: np.ndarray, w: pa.ChunkedArray | pa.Array | None) -> np.ndarray:
        out, at = np.zeros((len(x), q)), np.arange(len(x))
        w = None if one else w.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
        for f, c in enumerate(centers):
            out[at, begins[f] + _squares(x, c).argmin(axis=1)] = 1.0 if one else w[:, f]
        return out

    def sums(table: pa.Table) -> pa.Table:
        pid, x, rows, cols = _strips(table)
        member = members(x, None if one else table.column("_w").combine_chunks())
        total = _pair_sums(x, rows, cols, member)
        return pa.table({"_pid": pid, "_t": pa.ListArray.from_arrays(np.arange(0, total.size + 1, q, dtype=np.int32), total.ravel())})

    def sizes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(q)
        for batch in batches:
            x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            n += members(x, None if one else batch.column("_w")).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"m": np.arange(q), "n": n})

    sizes = np.zeros(q)
    for m, n in pts.mapInArrow(sizes_of, "m long, n double").groupBy("m").agg(F.sum("n")).collect():  # q rows
        sizes[m] = n

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, n = np.zeros(len(centers)), np.zeros(len(centers))
        for batch in batches:
            x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            member = members(x, None if one else batch.column("_w"))
            total = batch.column("_t").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, q)
            for f, (lo, hi) in enumerate(zip(begins, ends)):
                own, of, size = member[:, lo:hi], total[:, lo:hi], sizes[lo:hi]
                home = own > 0
                with np.errstate(all="ignore"):
                    a = np.where(home & (size > 1), of / (size - 1), 0.0).sum(axis=1)
                    b = np.where(home | (size == 0), np.inf, of / size).min(axis=1)
                    b = np.where(np.isinf(b), 0.0, b)
                    s = np.where((home & (size > 1)).any(axis=1) & (np.maximum(a, b) != 0), (b - a) / np.maximum(a, b), 0.0)
                weight = own.sum(axis=1)
                score[f] += (s * weight).sum()
                n[f] += weight.sum()
        yield pa.RecordBatch.from_pydict({"f": np.arange(len(centers), dtype=np.int32), "s": score, "n": n})

    part = _by_tile(tiles, n_points, sums, "_pid long, _t array<double>")
    whole = part.groupBy("_pid").agg(F.array(*[F.sum(F.get("_t", F.lit(m))) for m in range(q)]).alias("_t"))
    rows = pts.join(whole, "_pid").mapInArrow(scores, "f int, s double, n double")
    means = dict(rows.groupBy("f").agg(F.try_divide(F.sum("s"), F.sum("n"))).collect())  # one row a fit
    return [means.get(f) for f in range(len(fits))]


def select_k(df: DataFrame, ks: Sequence[int], restarts: int = 5, seed: int = 42) -> DataFrame:
    """CLU-2: inertia and mean silhouette per k; ``best`` = highest silhouette."""
    fits = fit_kmeans_of(df, ks, restarts, seed)
    means = mean_silhouettes(df, [m for m, _ in fits])
    rows = [(int(k), float(cost), float(s)) for k, (_, cost), s in zip(ks, fits, means)]
    best = max(rows, key=lambda r: r[2])[0]
    return df.sparkSession.createDataFrame([(k, c, s, k == best) for k, c, s in rows],
                                           "k int, inertia double, silhouette double, best boolean")


def pca_2d(df: DataFrame, ids: Sequence[str]) -> tuple[DataFrame, list[float]]:
    """CLU-5: centred 2-component PCA scores and explained-variance ratios."""
    from pyspark.ml.feature import StandardScaler
    centred = StandardScaler(inputCol=FEATURES, outputCol="_c", withMean=True, withStd=False).fit(df).transform(df)
    model = PCA(k=2, inputCol="_c", outputCol="_pc").fit(centred)
    scores = model.transform(centred).select(*ids, vector_to_array("_pc")[0].alias("pc1"),
                                             vector_to_array("_pc")[1].alias("pc2"))
    return scores, [float(v) for v in model.explainedVariance.toArray()]


def profiles(df: DataFrame, label: str, features: Sequence[str], eps: float = 1e-9) -> DataFrame:
    """CLU-6: feature mean per cluster, min-max normalised across clusters (long form)."""
    means = df.groupBy(label).agg(*[F.avg(c).alias(c) for c in features])
    long = means.unpivot([label], list(features), "feature", "mean")
    rng = long.groupBy("feature").agg(F.min("mean").alias("_lo"), F.max("mean").alias("_hi"))
    return long.join(rng, "feature").select(label, "feature", "mean", ((F.col("mean") - F.col("_lo"))
                                                                       / (F.col("_hi") - F.col("_lo") + eps)).alias("normalised"))


def name_clusters(df: DataFrame, label: str, key: str, features: Sequence[str]) -> DataFrame:
    """CLU-7: every member with its cluster's size and most distinctive feature (largest |mean| of z-scored features).

    One row per member: a cluster is never gathered, only its size and means are.
    """
    size = df.groupBy(label).agg(F.count(F.lit(1)).alias("size"))
    means = df.groupBy(label).agg(*[F.avg(c).alias(c) for c in features]).unpivot(
        [label], list(features), "feature", "mean")
    top = means.groupBy(label).agg(F.max_by("feature", F.struct(F.abs("mean"), F.col("feature"))).alias("top_feature"),
                                   F.max_by("mean", F.struct(F.abs("mean"), F.col("feature"))).alias("top_mean"))
    return df.select(label, key).join(size.join(top, label), label)


def pre_post_by_cluster(df: DataFrame, assignments: DataFrame, key: str, label: str, value: str,
                        period: str, cut) -> DataFrame:
    """CLU-8: mean ``value`` before / from ``cut`` per cluster (JN-3 lookup + conditional means)."""
    j = df.join(assignments.select(key, label), key)
    return j.groupBy(label).agg(F.avg(F.when(F.col(period) < cut, F.col(value))).alias("pre_mean"),
                                F.avg(F.when(F.col(period) >= cut, F.col(value))).alias("post_mean"))


def bootstrap_stability(df: DataFrame, k: int, n_boot: int = 50, seed: int = 42, restarts: int = 1) -> DataFrame:
    """CLU-9: Poisson bootstrap (each point repeated Poisson(1) times), refit, silhouette; per-draw rows.

    A draw is a weight of every point.  All draws share the rounds of k-means and the distances.
    """
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    draws = F.array(*[_poisson1(F.rand(seed * 1000 + b)) for b in range(n_boot)])
    drawn = held.withColumn("_w", draws).persist(StorageLevel.MEMORY_AND_DISK)

    def rows_of(b: int) -> DataFrame:
        w = drawn.withColumn("_w", F.get("_w", F.lit(b)))
        return w.filter(F.col("_w") > 0).withColumn("_rep", F.explode(F.sequence(F.lit(1), F.col("_w")))).drop("_rep")

    starts = first_centers([(rows_of(b), k, seed + b + r) for b in range(n_boot) for r in range(restarts)])
    each = F.flatten(F.transform("_w", lambda w: F.array_repeat(w, restarts)))
    blocks = point_blocks(drawn.withColumn("_w", each), "_w")
    fits = lloyd(blocks, starts)
    blocks.unpersist()
    best = [_lowest(fits[b * restarts: (b + 1) * restarts]) for b in range(n_boot)]
    rows = [(b, float(s)) for b, s in enumerate(mean_silhouettes(drawn, best, "_w"))]
    drawn.unpersist()
    held.unpersist()
    return df.sparkSession.createDataFrame(rows, "draw int, silhouette double")


def _poisson1(u):
    """Inverse-CDF Poisson(1) draw from a uniform column (tail above 9 folded into 10)."""
    import math
    cdf = np.cumsum([math.exp(-1.0) / math.factorial(k) for k in range(10)])
    expr = F.lit(10)
    for k in range(9, -1, -1):
        expr = F.when(u < F.lit(float(cdf[k])), F.lit(k)).otherwise(expr)
    return expr


def assignments(df: DataFrame, key: str, label: str) -> DataFrame:
    """SNK-5: (key, cluster_id, 'Cluster <id+1>')."""
    return df.select(key, F.col(label).cast("int").alias("cluster_id"),
                     F.concat(F.lit("Cluster "), (F.col(label) + 1).cast("string")).alias("cluster_label"))


def sizes(assigned: DataFrame, label: str = "cluster_id") -> DataFrame:
    """CLU-10: rows per cluster."""
    return assigned.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


__all__ = ["prepare_cluster_features", "vectors", "fit_kmeans", "silhouette", "select_k", "pca_2d", "profiles",
           "name_clusters", "pre_post_by_cluster", "bootstrap_stability", "assignments", "sizes"]
