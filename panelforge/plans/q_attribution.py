"""Registered query: attributions of a small forest of fixed splits over all order lines, with a twin that enumerates subsets.

Node covers and leaf values are counts and means over the table, so the forest follows the data.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from panelforge.operators.attribution import cell_attributions
from panelforge.plans.registry import query

FEATURES = ["l_quantity", "l_discount", "l_tax"]
LABEL = "l_extendedprice"
DEPTH = 3
#: (tree, id, left, right, feature, threshold); leaves have no children.  Tree 0 splits twice on one feature.
NODES = [
    (0, 0, 1, 6, 0, 25.5), (0, 1, 2, 3, 1, 0.055), (0, 2, -1, -1, -1, 0.0), (0, 3, 4, 5, 0, 12.5), (0, 4, -1, -1, -1, 0.0),
    (0, 5, -1, -1, -1, 0.0), (0, 6, 7, 8, 2, 0.045), (0, 7, -1, -1, -1, 0.0), (0, 8, -1, -1, -1, 0.0),
    (1, 0, 1, 4, 1, 0.035), (1, 1, 2, 3, 2, 0.025), (1, 2, -1, -1, -1, 0.0), (1, 3, -1, -1, -1, 0.0), (1, 4, 5, 6, 0, 40.5),
    (1, 5, -1, -1, -1, 0.0), (1, 6, 7, 8, 1, 0.075), (1, 7, -1, -1, -1, 0.0), (1, 8, -1, -1, -1, 0.0),
]
TREES = 2


def _steps() -> dict[tuple[int, int], list[tuple[int, str, float, int]]]:
    """By node: the path's splits as (feature, comparison, threshold, child)."""
    at = {(n[0], n[1]): n for n in NODES}
    out = {(t, 0): [] for t in range(TREES)}
    for t, i, left, right, f, thr in NODES:
        if left >= 0:
            out[(t, left)] = [*out[(t, i)], (f, "<=", thr, left)]
            out[(t, right)] = [*out[(t, i)], (f, ">", thr, right)]
    return {k: out[k] for k in at}


def _condition(steps) -> str:
    return " AND ".join(f"CAST({FEATURES[f]} AS DOUBLE) {op} CAST('{thr}' AS DOUBLE)" for f, op, thr, _ in steps) or "true"


def _twin() -> str:
    steps = _steps()
    stats = [f"count(*) FILTER (WHERE {_condition(s)}) AS c{t}_{i}, "
             f"avg(CAST({LABEL} AS DOUBLE)) FILTER (WHERE {_condition(s)}) / {TREES} AS v{t}_{i}" for (t, i), s in steps.items()]
    cuts = {f: sorted({n[5] for n in NODES if n[4] == f}) for f in range(len(FEATURES))}
    bins = ", ".join(" + ".join(f"CAST(CAST({FEATURES[f]} AS DOUBLE) > CAST('{c}' AS DOUBLE) AS INTEGER)" for c in cuts[f])
                     + f" AS b{f}" for f in range(len(FEATURES)))
    games = []
    for known in product((0, 1), repeat=len(FEATURES)):
        terms = []
        for t, i, left, *_ in NODES:
            if left >= 0:
                continue
            term, parent = [f"v{t}_{i}"], 0
            for f, op, thr, child in steps[(t, i)]:
                if known[f]:
                    at = cuts[f].index(thr)
                    term.append(f"CAST(b{f} {'<=' if op == '<=' else '>'} {at} AS INTEGER)")
                else:
                    term.append(f"(c{t}_{child} * 1.0 / c{t}_{parent})")
                parent = child
            terms.append(" * ".join(term))
        games.append(f"{' + '.join(terms)} AS g{''.join(map(str, known))}")
    n = len(FEATURES)
    weight = {0: 1 / 3, 1: 1 / 6, 2: 1 / 3}
    rows = []
    for f in range(n):
        phi = []
        for known in product((0, 1), repeat=n):
            if not known[f]:
                with_f = "".join(str(1 if k == f else v) for k, v in enumerate(known))
                phi.append(f"{weight[sum(known)]!r} * (g{with_f} - g{''.join(map(str, known))})")
        rows.append(f"SELECT b0 || '-' || b1 || '-' || b2 AS cell, n, '{FEATURES[f]}' AS feature, {' + '.join(phi)} AS phi, "
                    f"g{'0' * n} AS expected, g{'1' * n} AS prediction FROM g")
    whole = " AND ".join(f"{c} IS NOT NULL" for c in FEATURES)
    return f"""
WITH d AS (SELECT * FROM lineitem WHERE {whole}),
s AS (SELECT {", ".join(stats)} FROM d),
b AS (SELECT b0, b1, b2, count(*) AS n FROM (SELECT {bins} FROM d) GROUP BY b0, b1, b2),
g AS (SELECT b0, b1, b2, n, {", ".join(games)} FROM b, s)
SELECT cell, n, feature, round(phi, 4) AS phi, round(expected, 4) AS expected, round(prediction, 4) AS prediction
FROM ({" UNION ALL ".join(rows)})
"""


@query("xai1_path_attribution", "XAI-1", _twin())
def q_path_attribution(spark, sf_dir):
    """Attribution of every cell of order lines under a forest whose covers and values are taken from all lines."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").dropna(subset=FEATURES)
    steps = _steps()
    stats = [F.struct(F.lit(t).alias("tree"), F.lit(i).alias("id"), F.lit(left).alias("left"), F.lit(right).alias("right"),
                      F.lit(f).alias("feature"), F.lit(thr).alias("threshold"),
                      F.count_if(F.expr(_condition(steps[(t, i)]))).cast("double").alias("cover"),
                      (F.avg(F.when(F.expr(_condition(steps[(t, i)])), F.col(LABEL).cast("double"))) / TREES).alias("value"))
             for t, i, left, right, f, thr in NODES]
    nodes = lines.agg(*[s.alias(f"s{k}") for k, s in enumerate(stats)])
    nodes = nodes.select(F.explode(F.array(*[F.col(f"s{k}") for k in range(len(NODES))])).alias("s")).select("s.*")
    cells, _ = cell_attributions(lines, nodes, DEPTH, FEATURES)
    each = F.explode(F.arrays_zip(F.array(*map(F.lit, FEATURES)).alias("feature"), F.col("phi"))).alias("a")
    return cells.select(F.concat_ws("-", F.transform("cell", lambda b: b.cast("string"))).alias("cell"), "n", each,
                        F.round("expected", 4).alias("expected"), F.round("prediction", 4).alias("prediction")).select(
        "cell", "n", F.col("a.feature").alias("feature"), F.round("a.phi", 4).alias("phi"), "expected", "prediction")
