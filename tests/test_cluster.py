"""K-means restarts that share their rounds, silhouettes of several clusterings from one pass, distances of close points."""

import numpy as np
import pytest


def _points(spark, x):
    from panelforge.operators.cluster import vectors
    rows = [(i, [float(v) for v in p]) for i, p in enumerate(x)]
    return vectors(spark.createDataFrame(rows, "i long, x array<double>").repartition(3), "x").checkpoint()


def test_restarts_share_rounds_and_equal_single_fits(spark):
    from panelforge.operators import cluster
    from pyspark.ml.clustering import KMeans
    from panelforge.session import checkpoint_dir
    checkpoint_dir(spark)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(90, 3)) + np.repeat(rng.normal(scale=4, size=(6, 3)), 15, axis=0)
    df = _points(spark, x)
    jobs = [(df, k, 7 + r) for k in (2, 5) for r in range(4)]
    starts = cluster.first_centers(jobs)
    rounds = []
    blocks = cluster.point_blocks(df)
    whole = blocks.mapPartitions
    blocks.mapPartitions = lambda f: rounds.append(1) or whole(f)
    fits = cluster.lloyd(blocks, starts)
    most = 0
    for (_, k, seed), fit in zip(jobs, fits):
        own = KMeans(k=k, seed=seed, maxIter=300, tol=1e-6).fit(df)
        most = max(most, own.summary.numIter)
        np.testing.assert_allclose(fit.centers, np.array(own.clusterCenters()), atol=1e-9)
        assert fit.cost == pytest.approx(own.summary.trainingCost, rel=1e-6)
        want = {r.i: r.prediction for r in own.transform(df).collect()}
        assert {r.i: r.prediction for r in fit.transform(df).collect()} == want
    assert len(rounds) == most  # not the sum over the restarts
    best = cluster.fit_kmeans(df, 5, restarts=4, seed=7)[0]
    assert best.cost == min(f.cost for f in fits[4:])


@pytest.mark.parametrize("n, tasks", [(90, 1), (3 * 4096, 3), (9 * 4096, 4)])
def test_a_round_over_few_points_starts_few_tasks(spark, n, tasks):
    from panelforge.operators import cluster
    df = cluster.vectors(spark.range(0, n, 1, 8).selectExpr("array(cast(id as double), 1d) AS x"), "x")
    blocks = cluster.point_blocks(df)
    assert blocks.getNumPartitions() == min(tasks, spark.sparkContext.defaultParallelism)
    assert blocks.map(lambda b: len(b[0])).sum() == n
    blocks.unpersist()


def test_every_tile_is_a_task_of_its_own(spark):
    import pyarrow as pa
    from pyspark.sql import functions as F
    from panelforge.operators import cluster
    n = 2000
    g = cluster.strips_of(n)
    pts = spark.range(n).select(F.col("id").alias("_pid"))
    tiles = cluster._tiles(pts, n)

    def seen(table):
        pairs = set(zip(table.column("_i").to_pylist(), table.column("_j").to_pylist()))
        assert len(pairs) == 1
        return pa.table({"i": [min(pairs)[0]], "j": [min(pairs)[1]], "n": [table.num_rows]})

    got = cluster._by_tile(tiles, n, seen, "i long, j long, n long")
    rows = got.withColumn("task", F.spark_partition_id()).collect()
    assert g > 1 and sorted((r.i, r.j) for r in rows) == [(i, j) for i in range(g) for j in range(i, g)]
    assert len({r.task for r in rows}) == len(rows) and sum(r.n for r in rows) == n * g


def test_selection_over_k_reads_all_distances_once(spark, monkeypatch):
    from panelforge.operators import cluster
    rng = np.random.default_rng(5)
    df = _points(spark, np.concatenate([rng.normal(m, 0.3, size=(20, 2)) for m in (0, 4, 9)]))
    passes = []
    tiles = cluster._tiles
    monkeypatch.setattr(cluster, "_tiles", lambda *a: passes.append(1) or tiles(*a))
    got = {r.k: r for r in cluster.select_k(df, [2, 3, 4], restarts=3).collect()}
    assert len(passes) == 1 and [k for k, r in got.items() if r.best] == [3]
    for k, r in got.items():
        fit, cost = cluster.fit_kmeans(df, k, restarts=3)
        one = cluster.silhouette(fit.transform(df).withColumnRenamed("prediction", "c"), "c").agg({"silhouette": "avg"}).first()[0]
        assert r.silhouette == pytest.approx(one) and r.inertia == pytest.approx(cost)


def test_draws_by_weight_equal_repeated_rows(spark):
    from pyspark.sql import functions as F
    from panelforge.operators import cluster
    rng = np.random.default_rng(6)
    df = _points(spark, rng.normal(size=(40, 3)))
    got = [r.silhouette for r in cluster.bootstrap_stability(df, 2, n_boot=4).collect()]
    for b, s in enumerate(got):
        w = df.withColumn("_w", cluster._poisson1(F.rand(42_000 + b)))
        boot = w.where("_w > 0").withColumn("_rep", F.explode(F.sequence(F.lit(1), F.col("_w")))).drop("_rep")
        fit, _ = cluster.fit_kmeans(boot, 2, 1, 42 + b)
        one = cluster.silhouette(fit.transform(boot).withColumnRenamed("prediction", "c"), "c")
        assert s == pytest.approx(one.agg({"silhouette": "avg"}).first()[0], rel=1e-9)


def test_distances_of_close_points_are_exact():
    from panelforge.operators.cluster import _distances, _pair_sums
    rng = np.random.default_rng(7)
    a = rng.normal(size=(50, 8)) + 1e4
    b = np.concatenate([a[:20], a[20:40] + 1e-7 * rng.normal(size=(20, 8)), rng.normal(size=(10, 8)), np.full((1, 8), np.inf)])
    want = np.sqrt(((a[:, None] - b[None]) ** 2).sum(-1))
    got = _distances(a, b, (a * a).sum(1), (b * b).sum(1))
    np.testing.assert_allclose(got, want, rtol=1e-8)
    assert (got[np.arange(20), np.arange(20)] == 0).all()
    rows = np.arange(50)
    np.testing.assert_allclose(_pair_sums(a, rows, rows, np.ones((50, 1)))[:, 0],
                               np.sqrt(((a[:, None] - a[None]) ** 2).sum(-1)).sum(1), rtol=1e-8)


def test_a_tile_takes_no_pair_by_component():
    import time
    from panelforge.operators.cluster import _pair_sums
    x = np.random.default_rng(8).normal(size=(6000, 64))
    rows = np.arange(3000)
    begun = time.process_time()
    _pair_sums(x, rows, rows + 3000, np.ones((6000, 10)))
    new = time.process_time() - begun
    begun = time.process_time()
    for at in range(0, 600, 64):
        np.sqrt(((x[at: at + 64][:, None, :] - x[None, 3000:, :]) ** 2).sum(-1))
    assert new < (time.process_time() - begun) * 5 / 2  # 3000 rows against 640 by component
