"""DuckDB twins of the clustering queries: one materialized step a round, over all distances."""

from __future__ import annotations

_USABLE = """embedding IS NOT NULL AND len(list_filter(embedding, lambda a: a IS NULL OR NOT isfinite(a))) = 0"""
_INTEGERS = "list_transform(CAST(embedding AS DOUBLE[]), lambda a: floor(1024 * a))"


def _rounds(rounds: int, size: int) -> str:
    """Steps a0, e1, a1, ... over v(r, p, x) and e0(p, c, m): assignments a(r, p, x, c, d) and entries e."""
    steps = []
    for t in range(rounds + 1):
        if t:
            steps.append(f"""
e{t} AS MATERIALIZED (
  SELECT o.p, o.c, coalesce(n.m, o.m) AS m FROM e{t - 1} o LEFT JOIN (
    SELECT p, c, list(s ORDER BY i) AS m FROM (
      SELECT p, c, i, floor(sum(x[i]) / count(*)) AS s FROM a{t - 1}, generate_series(1, {size}) AS g(i) GROUP BY p, c, i)
    GROUP BY p, c) n USING (p, c))""")
        steps.append(f"""
a{t} AS MATERIALIZED (
  SELECT r, p, any_value(x) AS x, min({{'d': d, 'c': c}})['c'] AS c, min(d) AS d FROM (
    SELECT r, p, x, c, list_dot_product(x, x) - 2 * list_dot_product(x, m) + list_dot_product(m, m) AS d
    FROM v JOIN e{t} USING (p)) GROUP BY r, p)""")
    return ",".join(steps)


def centroids_sql(clusters: int = 8, rounds: int = 10, size: int = 64, salt: str = "3:") -> str:
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, 0 AS p, vec_id, {_INTEGERS} AS x FROM embeddings
  WHERE {_USABLE} AND len(embedding) = {size}),
e0 AS MATERIALIZED (
  SELECT 0 AS p, row_number() OVER (ORDER BY sha256('{salt}' || vec_id) NULLS LAST, x) - 1 AS c, x AS m FROM v
  QUALIFY c < {clusters}),{_rounds(rounds, size)},
i AS (SELECT c, sum(d) AS inertia FROM a{rounds} GROUP BY c)
SELECT v.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(i.inertia AS BIGINT) AS cluster_inertia,
       CAST((SELECT sum(inertia) FROM i) AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(e.m, lambda a: CAST(CAST(a AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (r) JOIN i USING (c) JOIN e{rounds} e ON e.c = a.c
"""


def codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4, size: int = 64) -> str:
    own = size // parts
    return f"""
WITH w AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, x) AS r, * FROM (
    SELECT vec_id, label, {_INTEGERS} AS x FROM embeddings WHERE {_USABLE} AND len(embedding) = {size})),
v AS MATERIALIZED (SELECT r, p, x[p * {own} + 1:(p + 1) * {own}] AS x FROM w, generate_series(0, {parts - 1}) AS g(p)),
e0 AS MATERIALIZED (SELECT p, r - 1 AS c, x AS m FROM v WHERE r <= {entries}),{_rounds(rounds, own)},
b AS (SELECT sha256(string_agg(CAST(CAST(m[i] AS BIGINT) AS VARCHAR), ',' ORDER BY p, c, i)) AS h
      FROM e{rounds}, generate_series(1, {own}) AS g(i)),
o AS MATERIALIZED (SELECT r, string_agg(format('{{:02x}}', c), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
                   FROM a{rounds} GROUP BY r)
SELECT w.vec_id, o.code, o.error, CAST(sum(o.error) OVER (PARTITION BY w.label) AS BIGINT) AS label_error,
       (SELECT h FROM b) AS codebooks_sha256
FROM o JOIN w USING (r)
"""
