"""Clustering, vector codes and packing against brute force on small fixtures."""

import functools
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

VECTORS = "vec_id long, embedding array<double>, label int, row string, x long, code int"


def _vectors(size, n=150, seed=3):
    rnd = np.random.default_rng(seed)
    rows = []
    centres = rnd.normal(size=(6, size))
    for i in range(n):
        v = centres[i % 6] + rnd.normal(size=size) * (0.1 if i % 3 else 0.6)
        rows.append((int(rnd.integers(0, 10**6)) if i % 9 else i, [float(a) for a in v], int(i % 4) if i % 5 else None))
    rows += [rows[7]] * 30 + [(rows[8][0], rows[9][1], 1), (None, rows[3][1], 2), (None, rows[4][1], None)]
    bad = [(900001, None, 1), (900002, [math.nan] * size, 1), (900003, [math.inf] + [0.0] * (size - 1), 1),
           (900004, [None] + [0.0] * (size - 1), 2), (900005, [], 1), (900006, [0.5] * (size - 1), 1)]
    return rows, bad


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "r", 1, 2) for r in rows], VECTORS).repartition(3)


def _integers(rows):
    return np.array([[math.floor(1024 * a) for a in r[1]] for r in rows], np.int64)


def _rounds(x, entries, rounds):
    entries = entries.copy()
    for t in range(rounds + 1):
        d = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
        code = d.argmin(axis=1)
        if t < rounds:
            for j in set(code.tolist()):
                own = x[code == j]
                entries[j] = own.sum(axis=0) // len(own)
    return entries, code, d[np.arange(len(x)), code]


@pytest.mark.parametrize("rounds", [0, 1, 7])
def test_clusters_match_brute_force(spark, rounds):
    from panelforge.llm.centroids import cluster
    rows, bad = _vectors(16)
    x = _integers(rows)
    key = [(1, "") if r[0] is None else (0, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest()) for r in rows]
    first = sorted(range(len(rows)), key=lambda i: (key[i], x[i].tolist()))[:5]
    entries, code, d = _rounds(x, x[first], rounds)
    inertia = Counter()
    for c, e in zip(code.tolist(), d.tolist()):
        inertia[c] += e
    names = [hashlib.sha256(",".join(map(str, e)).encode()).hexdigest() for e in entries.tolist()]
    want = Counter((r[0], c, e, inertia[c], sum(inertia.values()), names[c])
                   for r, c, e in zip(rows, code.tolist(), d.tolist()))
    work = []
    got = cluster(_frame(spark, rows + bad), clusters=5, rounds=rounds, size=16, scanned=work).collect()
    assert Counter(map(tuple, got)) == want
    assert work[0][0] == len(rows) and len(work) <= rounds + 1


def test_clusters_of_few_and_no_vectors(spark):
    from panelforge.llm.centroids import cluster
    none = cluster(_frame(spark, _vectors(4)[1]), size=4)
    assert none.count() == 0 and none.columns[:3] == ["vec_id", "cluster", "distance"]
    got = cluster(_frame(spark, [(1, [0.0, 1.0], 1), (1, [0.0, 1.0], 1), (2, [5.0, -5.0], 1)]), size=2).collect()
    assert sorted((r.vec_id, r.distance) for r in got) == [(1, 0), (1, 0), (2, 0)]
    with pytest.raises(Exception, match="do not fit a long"):
        cluster(_frame(spark, [(1, [1e9, 1.0], 1)]), size=2).count()


def test_sphere_loss_bounds_every_vector_inside():
    from panelforge.llm.centroids import loss
    rnd = np.random.default_rng(0)
    less = 0
    for _ in range(300):
        a, b, centre = rnd.normal(size=(3, 5)) * rnd.choice([0.2, 1, 5], size=(3, 1))
        radius = float(rnd.random() * 2)
        way = rnd.normal(size=(400, 5))
        x = centre + way / np.linalg.norm(way, axis=1, keepdims=True) * radius * rnd.random((400, 1)) ** 0.1
        bound = loss(a, b, centre, radius)
        assert (np.linalg.norm(x - a, axis=1) - np.linalg.norm(x - b, axis=1)).max() <= bound + 1e-9
        less += bound < np.linalg.norm(b - a) * 0.9
    assert less > 50


@pytest.mark.parametrize("groups", [1, 3, 12])
def test_codes_match_brute_force(spark, groups):
    from panelforge.llm.codes import compress
    rows, bad = _vectors(12, seed=5)
    x = _integers(rows)
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, x[i].tolist()))[:12]
    code, error, books = [""] * len(rows), np.zeros(len(rows), np.int64), []
    for p in range(3):
        own = x[:, 4 * p: 4 * p + 4]
        entries, c, d = _rounds(own, own[first], 4)
        books += entries.ravel().tolist()
        error += d
        code = [a + f"{b:02x}" for a, b in zip(code, c.tolist())]
    by = defaultdict(int)
    for r, e in zip(rows, error.tolist()):
        by[r[2]] += e
    name = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    want = Counter((r[0], c, e, by[r[2]], name) for r, c, e in zip(rows, code, error.tolist()))
    work = []
    got = compress(_frame(spark, rows + bad), parts=3, entries=12, groups=groups, scanned=work).collect()
    assert Counter(map(tuple, got)) == want
    assert len(work) == 5 and (groups == 1 or work[-1][1] < work[0][1])


def test_net_displacement_is_less_than_the_sum_of_drifts():
    from panelforge.llm.codes import NetBounds
    bounds = NetBounds(1)
    there, back = np.zeros((1, 2, 2)), np.array([[[3.0, 4.0], [0.0, 0.0]]])
    bounds.history = [there, back, there]
    assert bounds.displacements().tolist() == [[[0.0, 0.0]], [[5.0, 0.0]]]


def test_codes_of_few_and_no_vectors(spark):
    from panelforge.llm.codes import compress
    assert compress(_frame(spark, _vectors(4)[1][:5])).count() == 0
    got = compress(_frame(spark, [(2, [1.0] * 8, None), (1, [2.0] * 8, None), (1, [2.0] * 8, 3)])).collect()
    assert sorted((r.vec_id, r.code, r.error) for r in got) == [(1, "00000000", 0), (1, "00000000", 0), (2, "02020202", 0)]


# ---------------------------------------------------------------- packing

DOCS = "doc_id long, text string, ids string, length long, task string"


@functools.cache
def _tokenizer():
    from tokenizers import Tokenizer

    from panelforge.llm.packing import byte_pair_file
    return Tokenizer.from_file(byte_pair_file())


def _plain(text):
    return _tokenizer().encode(text or "", add_special_tokens=False).ids


def test_encoder_agrees_with_the_library_of_the_file():
    from panelforge.llm.packing import Encoder, byte_pair_file
    encoder = Encoder(byte_pair_file())
    assert encoder.quick is not None
    rnd = random.Random(1)
    letters = ["a", "B", "é", "ß", "日", "𝔘", " ", "  ", "\n", "\t", " ", "　", "1", "½", "Ⅷ", "'s", "'ll", "<|endoftext|>", "<|", "|>",
               "́", "‍", "😀", "!", "\x00", "\r\n", " ", "\x85", "\x1c", "﻿", "_", "-"]
    texts = ["", " ", "<|endoftext|>", "a" * 5000, " " * 5000 + "x", "\n" * 3000, "ab " * 4000, "日本" * 3000]
    texts += ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 60))) for _ in range(1500)]
    for text in texts:
        assert encoder.ids(text).tolist() == _plain(text), repr(text)


def test_encoder_falls_back_to_the_library():
    from panelforge.llm.packing import Encoder, byte_pair_file

    class Broken:
        def encode_to_numpy(self, *args, **kwargs):
            raise ValueError("too long a run")
    encoder = Encoder(byte_pair_file())
    encoder.quick = Broken()
    assert encoder.ids("naïve  <|endoftext|> text").tolist() == _plain("naïve  <|endoftext|> text")


def _documents():
    rnd = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "Straße", "日本", "x1", "<|endoftext|>"]
    texts = [None, "", " ", "one"] + [" ".join(rnd.choice(words) for _ in range(rnd.choice([1, 5, 20, 60, 130]))) for _ in range(120)]
    texts += ["copy of one hot document"] * 80 + [" ".join(rnd.choice(words) for _ in range(900))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (5, "same id"), (5, "same id")]
    return [(i, t, "c", 1, "k") for i, t in rows]


@pytest.mark.parametrize("documents,attention", [(None, None), (3, None), (None, 2500)])
def test_sequences_keep_every_capacity(spark, documents, attention):
    from panelforge.llm.packing import pack, sequences
    rows, tokens = _documents(), 50
    got = pack(spark.createDataFrame(rows, DOCS).repartition(4), tokens=tokens, documents=documents, attention=attention)
    pieces = got.collect()
    want = Counter()
    for i, t, *_ in rows:
        ids = _plain(t) + [0]
        start = 0
        for k, end in enumerate(range(len(ids) % tokens or tokens, len(ids) + 1, tokens)):
            want[(i, k, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes()))] += 1
            start = end
    assert Counter((r.doc_id, r.piece, r.start, r.length, zlib.crc32(bytes(r.ids))) for r in pieces) == want
    bins = defaultdict(list)
    for r in pieces:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= tokens and len(own) <= (documents or tokens)
        assert sum(n * n for _, n in own) <= (attention or tokens * tokens)
    whole = {r.sequence_id: r for r in sequences(got).collect()}
    for s, own in bins.items():
        assert whole[s].length == sum(n for _, n in own) and whole[s].parts == [n for _, n in own]
        assert len(whole[s].ids) == 4 * whole[s].length
    if documents is None and attention is None:
        lower = -(-sum(r.length for r in pieces) // tokens)
        assert len(bins) <= _best_fit([r.length for r in pieces], tokens) and len(bins) <= lower * 1.05 + 1


def _best_fit(lengths, tokens):
    """Plain best fit decreasing, item by item."""
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, f in enumerate(free) if f >= n]
        if fits:
            free[min(fits, key=lambda k: free[k])] -= n
        else:
            free.append(tokens - n)
    return len(free)


def test_plan_places_every_item_once():
    from panelforge.llm.packing import Plan
    rnd = random.Random(2)
    for rule in ("dot", "norm"):
        for _ in range(20):
            counts = {rnd.randint(1, 60): rnd.randint(1, 40) for _ in range(rnd.randint(1, 30))}
            plan = Plan(counts, (60, rnd.choice([3, 60]), 3600), rule, (1.0, 0.5, 0.5))
            placed = Counter()
            for times, contents in zip(plan.times.tolist(), plan.contents):
                assert sum(n * e for n, e in contents) <= 60
                for length, each in contents:
                    placed[length] += times * each
            assert placed == counts
            for length, first, last, *_ in plan.intervals():
                placed[length] -= last - first + 1
            assert not any(placed.values())
    assert Plan({}, (60, 60, 3600), "dot").bins == 0
    with pytest.raises(ValueError):
        Plan({61: 1}, (60, 60, 3600), "dot")


def test_packing_of_no_documents(spark):
    from panelforge.llm.packing import pack
    empty = pack(spark.createDataFrame([], DOCS))
    assert empty.count() == 0 and "sequence_id" in empty.columns
