"""Tree attributions against subset enumeration; permutations without sorting."""

import itertools
import math

import numpy as np
import pytest


def _forest(rng, trees, depth, n_features):
    """Random trees as node rows (tree, id, left, right, feature, threshold, cover, value), ids in preorder."""
    rows = []
    for t in range(trees):
        count = itertools.count()

        def grow(level, cover, t=t, count=count):
            i = next(count)
            if level == depth or (level and rng.random() < 0.2):
                rows.append((t, i, -1, -1, -1, 0.0, cover, float(rng.normal())))
                return i
            share = rng.uniform(0.1, 0.9)
            at = len(rows)
            rows.append(None)
            f, thr = int(rng.integers(0, n_features)), float(rng.integers(-2, 3))
            left, right = grow(level + 1, cover * share), grow(level + 1, cover * (1 - share))
            rows[at] = (t, i, left, right, f, thr, cover, 0.0)
            return i
        grow(0, 100.0)
    return rows


def _game(rows, x, known):
    """Expected output if only the features in ``known`` are known."""
    at = {(r[0], r[1]): r for r in rows}

    def value(t, i):
        _, _, left, right, f, thr, cover, v = at[(t, i)]
        if left < 0:
            return v
        if f in known:
            return value(t, left if x[f] <= thr else right)
        return sum(value(t, c) * at[(t, c)][6] / cover for c in (left, right))
    return sum(value(t, 0) for t in {r[0] for r in rows})


def _shapley(rows, x):
    n = len(x)
    out = np.zeros(n)
    for f in range(n):
        rest = [k for k in range(n) if k != f]
        for size in range(n):
            w = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
            for known in itertools.combinations(rest, size):
                out[f] += w * (_game(rows, x, {*known, f}) - _game(rows, x, set(known)))
    return out


@pytest.mark.parametrize("trees,depth", [(3, 4), (1, 1), (2, 0)])
def test_attributions_match_subset_enumeration(spark, trees, depth):
    from panelforge.operators.attribution import attributions
    rng = np.random.default_rng(depth)
    rows = _forest(rng, trees, depth, 4)
    nodes = spark.createDataFrame(rows, "tree int, id int, left int, right int, feature int, threshold double, cover double, value double")
    x = rng.integers(-3, 4, size=(25, 4)).astype(float)  # values on the thresholds too
    data = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)] + [(0, *map(float, x[0])), (99, None, 1.0, 1.0, 1.0)],
                                 "i int, a double, b double, c double, d double")
    got = attributions(data, nodes, depth, ["a", "b", "c", "d"], ["i"]).collect()
    assert len(got) == 26 * 4
    for i, v in enumerate(x):
        own = {r.feature: r for r in got if r.i == i}
        np.testing.assert_allclose([own[f].phi for f in "abcd"], _shapley(rows, v), atol=1e-12)
        assert own["a"].expected == pytest.approx(_game(rows, v, set()))
        assert own["a"].prediction == pytest.approx(_game(rows, v, {0, 1, 2, 3}))
        assert [own[f].value for f in "abcd"] == v.tolist()


def test_attribution_uses_no_python_worker(spark):
    from panelforge.operators.attribution import attributions
    nodes = spark.createDataFrame(_forest(np.random.default_rng(1), 2, 2, 2),
                                  "tree int, id int, left int, right int, feature int, threshold double, cover double, value double")
    out = attributions(spark.createDataFrame([(1, 0.0, 1.0)], "i int, a double, b double"), nodes, 2, ["a", "b"], ["i"])
    plan = out._jdf.queryExecution().toString()
    assert "Arrow" not in plan and "Pandas" not in plan and "Python" not in plan


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_keyed_permutations_are_one_to_one(spark, n):
    from pyspark.sql import functions as F

    from panelforge.operators.explain import keyed_permutation
    rows = spark.range(n).crossJoin(spark.range(5).withColumnRenamed("id", "k"))
    got = rows.withColumn("p", keyed_permutation(F.col("id"), n, F.col("k"))).collect()
    orders = {}
    for r in got:
        orders.setdefault(r.k, {})[r.id] = r.p
    assert all(sorted(o.values()) == list(range(n)) for o in orders.values())
    if n == 1000:
        assert len({tuple(o[i] for i in range(n)) for o in orders.values()}) == 5
        moved = [abs(o[i] - i) for o in orders.values() for i in range(n)]
        assert 250 < np.mean(moved) < 420  # a random permutation moves a third of n on average


def test_row_numbers_have_no_gaps(spark):
    from panelforge.operators.explain import numbered
    df, n = numbered(spark.range(0, 1000, 1, 7).where("id % 3 = 0 or id > 900"), "at")
    assert n == df.count() and sorted(r.at for r in df.collect()) == list(range(n))
    empty, n = numbered(spark.range(0), "at")
    assert n == 0 and empty.count() == 0
