"""Registered queries against their DuckDB twins at the smallest scale, and the driver contract."""

import duckdb
import pytest

from conftest import SF001

FAST = ["flagship_top_growth", "jn1_merge_panel", "jn7_nearest_match", "agg15_box_stats", "win1_lag_bucketed",
        "mis3_ffill_bfill", "out2_cap_outliers", "dq5_iqr_outliers", "sta2_spearman", "sta12_kruskal",
        "cau4_did_basic_coef", "clu4_silhouette_given_labels", "fc11_model_comparison", "fea_g2_features"]


def _norm(v):
    if isinstance(v, float):
        return None if v != v else float(f"{v:.6g}")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    from panelforge.sources.tables import STAR_TABLES
    con = duckdb.connect()
    for t in STAR_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF001)
    s = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    d = cur.fetchall()
    dcols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, s) == _rows(dcols, d)


def test_entry_contract(spark):
    import __spark_entry__ as E
    out = E.entry(spark)
    assert out.columns == ["k", "nation", "mean_growth", "latest_momentum", "mean_score", "rank"]
    assert out.count() >= 0
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) > 150
