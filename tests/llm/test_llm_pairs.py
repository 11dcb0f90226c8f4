"""Similarity joins, components and shards against brute force on small fixtures."""

import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long, sig long, n long, v string, key string"


def _components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def _shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return set()
    return {tuple(words[i: i + width]) for i in range(max(1, len(words) - width + 1))}


def _texts():
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)] + ["Straße", "naïve", " x"]
    base = [[rnd.choice(vocabulary) for _ in range(n)] for n in (3, 12, 60, 150, 400, 900)]
    out = [None, "", " \t\n ", "one", "one", "ONE\tTwo three", "one two three"]
    for words in base:
        for _ in range(12):
            own = list(words)
            for _ in range(rnd.randint(0, max(1, len(own) // 25))):
                own[rnd.randrange(len(own))] = rnd.choice(vocabulary)
            out.append(rnd.choice([" ", "\n"]).join(own))
        out += [" ".join(words)] * 4
    passage = " ".join(rnd.choice(vocabulary) for _ in range(40))
    out += [passage + " " + " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(5, 90))) for _ in range(40)]
    return out


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates_match_brute_force(spark, width):
    from panelforge.llm.minhash import near_duplicates
    texts = _texts()
    ids = list(range(10, 10 + len(texts)))
    random.Random(1).shuffle(ids)
    rows = [(i, t, "en", "s", 1, 7, 8, "x", "y") for i, t in zip(ids, texts, strict=True)] + [(None, texts[20]) + (None,) * 7]
    got = near_duplicates(spark.createDataFrame(rows, DOCS).repartition(3), width).collect()
    sets = {i: _shingles(t, width) for i, t in zip(ids, texts, strict=True)}
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = _components(ids, links)
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is not None} == {
        i: (len(sets[i]), want[i], want[i] == i) for i in ids}
    lone = [r for r in got if r.doc_id is None]
    assert len(lone) == 1 and lone[0].component_id is None and lone[0].kept is False


def test_one_document_of_each_group_stays(spark):
    from panelforge.llm.minhash import drop_near_duplicates
    long = " ".join(f"w{i}" for i in range(100))
    rows = [(3, long), (1, long + " end"), (2, "other words here now and then"), (2, "other words here now and then"),
            (5, None), (6, ""), (None, long)]
    docs = spark.createDataFrame([(i, t, None, None, None, 1, 2, "", "") for i, t in rows], DOCS)
    got = drop_near_duplicates(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in got.collect()) == sorted(
        [(1, long + " end"), (2, "other words here now and then"), (5, ""), (6, ""), (0, long)])


def test_rows_of_repeated_ids_are_dropped_one_by_one(spark):
    from panelforge.llm.minhash import drop_near_duplicates
    a, b, c = (" ".join(f"{x}{i}" for i in range(100)) for x in "abc")
    rows = [(3, b), (5, a), (5, b + " end"), (5, a.upper()), (5, a + " end"), (7, a), (8, c), (8, c), (8, ""), (8, None), (9, c), (None, a)]
    docs = spark.createDataFrame([(i, t, None, None, None, 1, 2, "", "") for i, t in rows], DOCS)
    got = drop_near_duplicates(docs)
    assert got.columns == docs.columns
    got = [(r.doc_id, r.text) for r in got.collect()]
    of_a = [t for i, t in got if i == 5]
    assert len(of_a) == 1 and of_a[0].lower().startswith("a0 ")
    assert sorted((i or 0, t or "") for i, t in got if i != 5) == sorted([(3, b), (8, c), (8, ""), (8, ""), (0, a)])


def test_block_links_join_what_brute_force_joins():
    from panelforge.llm.minhash import block_links
    rnd = np.random.default_rng(3)
    core = rnd.choice(1000, 100, replace=False)
    sets = [np.unique(np.concatenate([rnd.choice(core, 95, replace=False), rnd.integers(0, 10**6, rnd.integers(1, 12))]))
            .astype(np.int64) for _ in range(60)]
    left, right, comp = np.arange(30), np.arange(30, 60), np.arange(60)
    links = [(i, j) for i in left for j in right
             if 180 * len(np.intersect1d(sets[i], sets[j])) >= 80 * (len(sets[i]) + len(sets[j]))]
    got = block_links(sets, left, right, comp, 80)
    assert set(got) <= set(links) and links
    assert _components(range(60), got) == _components(range(60), links)


def test_components_of_chains_stars_and_nothing(spark):
    from panelforge.llm.graph import components
    rnd = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7)]
    links += [(rnd.randint(200, 260), rnd.randint(200, 260)) for _ in range(40)]
    df = spark.createDataFrame([*links, (None, 5)], "a long, b long")
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert {r.node: r.component for r in components(df).collect()} == _components(nodes, [x for x in links if x[0] != x[1]])
    assert components(df.limit(0)).count() == 0


def test_shards_are_even_and_keep_equal_texts_together(spark):
    from panelforge.llm.sharding import document_shards
    texts = ["hot copy"] * 170 + [f"pair {i // 2}" for i in range(60)] + [f"single {i}" for i in range(250)] + [None, None, "", ""]
    rows = [(i, t, None, None, None, 1, 2, "", "k") for i, t in enumerate(texts)] + [(0, "hot copy") + (None,) * 7] * 2
    got = document_shards(spark.createDataFrame(rows, DOCS).repartition(3), 10).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
        text = texts[r.doc_id]
        assert r["size"] == len((text or "").encode()) + 16 and r.law == "rows" and r.grown_shard is None
        assert r.text_crc32 == (None if text is None else zlib.crc32(text.encode()))
    assert sorted(by) == list(range(10)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    spread = {}
    for r in got:
        spread.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert len(spread["hot copy"]) <= 6 and sum(len(spread[f"pair {i}"]) == 1 for i in range(30)) >= 28
    empty = document_shards(spark.createDataFrame([], DOCS), 10)
    assert empty.count() == 0


def test_similar_vectors_match_brute_force(spark):
    from panelforge.llm.embed_join import similar_vectors
    rnd = np.random.default_rng(4)
    rows, i = [], 0
    for _ in range(8):
        centre = rnd.normal(size=6)
        for _ in range(9):
            rows.append((i, [float(x) for x in centre + rnd.normal(size=6) * 0.35], int(rnd.integers(0, 2))))
            i += 1
    same = [1.0, 2.0, 0.0, 0.0, 1.0, 1.0]
    rows += [(100 + k, same, 1) for k in range(20)] + [(130, [2 * x for x in same], 1), (131, same, None), (132, None, 1),
             (133, [0.0] * 6, 1), (134, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (135, [math.nan] * 6, 1), (136, [math.inf] * 6, 1),
             (137, [], 1), (138, [1.0, 2.0], 1), (139, [-0.0, 0.0, 0.0, 0.0, 0.0, 1.0], 0), (140, [0.0, 0.0, 0.0, 0.0, 0.0, 1.0], 0)]

    def usable(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    links = []
    for a, u, la in rows:
        for b, v, lb in rows:
            if a < b and la is not None and la == lb and usable(u) and usable(v) and len(u) == len(v):
                if np.dot(u, v) / math.sqrt(np.dot(u, u) * np.dot(v, v)) >= 0.93:
                    links.append((a, b))
    ids = [r[0] for r in rows]
    comp = _components(ids, links)
    n = {i: sum(i in x for x in links) for i in ids}
    schema = "vec_id long, embedding array<double>, label int"
    df = spark.createDataFrame(rows, schema).selectExpr("*", "1 as sig", "'x' as v").repartition(3)
    got = similar_vectors(df).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {i: (n[i], comp[i], comp[i] == i) for i in ids}
    assert similar_vectors(spark.createDataFrame([], schema)).count() == 0


def test_spanning_links_connect_what_is_linked():
    from panelforge.llm.embed_join import spanning
    rnd = np.random.default_rng(1)
    for _ in range(20):
        linked = rnd.random((9, 7)) < 0.15
        one, two = spanning(linked)
        assert all(linked[i, j] for i, j in zip(one, two, strict=True))
        nodes = range(16)
        assert _components(nodes, [(i, 9 + j) for i, j in zip(one, two, strict=True)]) == _components(
            nodes, [(i, 9 + j) for i, j in zip(*np.nonzero(linked), strict=True)])


def test_vectors_of_any_magnitude_are_linked(spark):
    from panelforge.llm.embed_join import similar_vectors
    rnd = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rnd.normal(size=8)], 0) for i in range(40)]
    rows += [(50, [1e-200] * 8, 1), (51, [1e200] * 8, 2), (52, [5e-324] * 8, 2), (53, [1.0] * 8, 2),
             (54, [1.7e308] * 7 + [1.6e308], 2), (55, [3e-310] * 8, 2), (56, [-1e200] * 8, 2)]
    got = {r.vec_id: r for r in similar_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert len(got) == len(rows) and got[50].n_links == 0 and got[56].n_links == 0
    assert all(got[i].n_links == 4 and got[i].component_id == 51 for i in (51, 52, 53, 54, 55))


def test_propagation_runs_until_the_cut_stays(spark):
    from panelforge.llm.sharding import cut_links, document_shards
    texts = [f"group {i % 60}" for i in range(1200)] + [f"alone {i}" for i in range(400)] + [None] * 7
    docs = spark.createDataFrame([(i if i % 13 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = document_shards(docs, 8)
    links = cut_links(out.withColumn("key", F.col("text_crc32"))).first()
    assert links.links == 60 * 190 and links.across <= 0.1 * links.links
    sizes = [r["count"] for r in out.groupBy("shard").count().collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 1
    assert document_shards(docs.limit(0), 8).count() == 0
