"""Text quality from weak labels: overlapping heuristic labellers, their accuracies by
expectation-maximisation, and a hashed linear scorer trained on the posterior labels.

Every labeller votes good (1), bad (0) or abstains (2).  The votes of all documents are
counted by pattern (at most 3 to the number of labellers), the accuracies are estimated
from these counts alone, and the posterior of a document is that of its pattern.  A linear
scorer over hashed words and word shapes then learns the posteriors of a bounded sample.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import hand_back, share, tidy
from panelforge.llm.tokencount import slices

#: Documents that the linear scorer is fitted on, chosen by a hash of doc_id and text; at most twice as many.
SAMPLE = 4_000
WORD_CELLS, SHAPE_CELLS = 1 << 15, 1 << 12
#: Documents whose score is below are rejected.
THRESHOLD = 0.5
_REMEMBERED = 1 << 18

# Frequent function words of the corpus languages.
FUNCTION_WORDS = frozenset(
    "the of and a to in is that it was for on are with as be at by this from or an not "
    "der die das und ist in den von zu mit für auf dem des sich ein eine nicht im "
    "le la les de des et un une est que dans pour qui sur du au pas par "
    "el los las y que en un una es por con para se del al no lo su".split())
LABELLERS = ("repetition", "distinct", "capitals", "shouting", "symbols", "function_words", "separators", "suffixes")
_SHAPES = re.compile(r"[a-zß-öø-ÿ]+|[A-ZÀ-ÖØ-Þ]+|[0-9]+")
_CASED = frozenset(v for w in FUNCTION_WORDS for v in (w, w.capitalize(), w.upper()))


def _byte_set(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_BLANK = _byte_set(b" \t\n\v\f\r")
_SYMBOL = _byte_set(b"#$%&*+/<=>@\\^_`{|}~")
_MARK = _SYMBOL | _byte_set(b"!\"'(),-.:;?[]")


class Distinct:
    """Number of distinct words in bounded memory.

    Exact up to ``most`` words; beyond, only words whose checksum ends in ``level`` zero bits
    are remembered and stand for 2^level each (an error of about 0.3 %).
    """

    def __init__(self, most: int = _REMEMBERED):
        self.most, self.level, self.words = most, 0, set()

    def add(self, words: list[str]) -> None:
        self.words.update(self._chosen(words) if self.level else words)
        while len(self.words) > self.most:
            self.level += 1
            self.words = set(self._chosen(self.words))

    def _chosen(self, words):
        mask = (1 << self.level) - 1
        return (w for w in words if not zlib.crc32(w.encode("utf-8", "replace")) & mask)

    def __len__(self) -> int:
        return len(self.words) << self.level


def votes(text: str | None) -> str:
    """One character per labeller: 1 good, 0 bad, 2 abstains.  Texts under 5 words only get votes on their form."""
    n = repeated = functions = separators = upper = letters = bangs = symbols = chars = suffixes = 0
    seen = Distinct()
    for part in slices(text or ""):
        words = part.split()
        n += len(words)
        repeated += sum(map(eq, words, words[1:]))
        seen.add(words)
        functions += sum(map(_CASED.__contains__, words))
        x = np.frombuffer(part.encode("utf-8", "replace") + b"\n", np.uint8)
        counts = np.bincount(x, minlength=256)
        up = int(counts[65:91].sum())
        upper += up
        letters += up + int(counts[97:123].sum())
        bangs += int(counts[33])
        chars += len(part)
        symbols += int(counts[_SYMBOL].sum())
        blank, symbol = _BLANK[x], _SYMBOL[x]
        separators += int(np.count_nonzero(blank[:-2] & _MARK[x[1:-1]] & blank[2:]))
        suffixes += int(np.count_nonzero(symbol[:-2] & symbol[1:-1] & blank[2:]))
    if not n:
        return "2" * len(LABELLERS)

    def vote(x: float, good: float, bad: float) -> str:
        return "1" if x <= good else "0" if x >= bad else "2"

    short = n < 5
    return "".join((
        "2" if short else vote(repeated / n, 0.05, 0.3),
        "2" if n < 50 else vote(n / max(1, len(seen)) / np.log2(n + 2), 0.8, 3.0),
        vote(upper / max(1, letters), 0.2, 0.6),
        vote(bangs / n, 0.05, 0.5),
        vote(symbols / max(1, chars), 0.03, 0.12),
        "2" if n < 12 else vote(-functions / n, -0.08, -0.02),
        vote(separators / n, 0.05, 0.3),
        vote(suffixes / n, 0.03, 0.4)))


def accuracies(patterns: dict[str, int], rounds: int = 200) -> tuple[float, np.ndarray, dict[str, float]]:
    """Expectation-maximisation over vote patterns: (share of good, accuracy per labeller and class, posteriors).

    Junk comes in kinds that trip different labellers, so the latent classes are good and one kind of
    bad per labeller; within a class votes are independent.  Labellers vote bad on clear signs only: the start
    deals a document with bad votes to the kinds of these labellers, which also fixes which class is which.
    Accuracy [j, y] is the chance that labeller j, when it votes, votes y for a document of class y (1 good, 0 bad).
    """
    names = sorted(patterns)
    kinds = len(LABELLERS)
    weight = np.array([patterns[p] for p in names], float)
    v = np.array([[int(c) for c in p] for p in names], int).reshape(len(names), kinds)
    good, bad = (v == 1).astype(float), (v == 0).astype(float)
    some = bad.sum(axis=1, keepdims=True)
    post = np.column_stack([np.where(some > 0, 0.1, 0.98), np.where(some > 0, 0.9 * bad / np.maximum(some, 1), 0.02 / kinds)])
    share, chance = np.full(kinds + 1, 1 / (kinds + 1)), np.full((kinds + 1, kinds), 0.5)
    for _ in range(rounds):
        mass = weight[:, None] * post
        share = (mass.sum(axis=0) + 1) / (weight.sum() + kinds + 1)
        chance = (mass.T @ good + 0.5) / (mass.T @ (good + bad) + 1)  # of a good vote, per class and labeller
        log = np.log(share) + good @ np.log(chance).T + bad @ np.log(1 - chance).T
        new = np.exp(log - log.max(axis=1, keepdims=True)) if len(names) else log
        new /= new.sum(axis=1, keepdims=True)
        settled = not len(names) or np.abs(new - post).max() < 1e-8
        post = new
        if settled:
            break
    mass = weight[:, None] * post
    junk = mass[:, 1:].sum(axis=1)
    table = np.column_stack([(junk @ bad + 0.5) / (junk @ (good + bad) + 1), chance[0]])
    return float(share[0]), table, dict(zip(names, post[:, 0].tolist(), strict=True))


@dataclass
class Model:
    share: float
    accuracy: np.ndarray
    posterior: dict[str, float]
    weights: np.ndarray
    bias: float


def _cells(word: str) -> tuple[int, int]:
    low = zlib.crc32(word.lower().encode("utf-8", "replace")) % WORD_CELLS
    shape = _SHAPES.sub(lambda m: "x" if m[0][0].islower() else "9" if m[0][0].isdigit() else "X" * min(2, len(m[0])), word)
    return low, WORD_CELLS + zlib.crc32(shape[:12].encode("utf-8", "replace")) % SHAPE_CELLS


_REPEAT = WORD_CELLS + SHAPE_CELLS
CELLS = _REPEAT + 1


def _sparse(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Cells and their shares of the words."""
    counts: dict[int, int] = {}
    cells: dict[str, tuple[int, int]] = {}
    n = repeat = 0
    for part in slices(text or ""):
        words = part.split()
        n += len(words)
        repeat += sum(map(eq, words, words[1:]))
        for w in words:
            own = cells.get(w)
            if own is None:
                own = _cells(w)
                if len(cells) < _REMEMBERED:
                    cells[w] = own
            for c in own:
                counts[c] = counts.get(c, 0) + 1
    if repeat:
        counts[_REPEAT] = repeat
    return np.array(list(counts), np.int32), np.array(list(counts.values()), float) / max(1, n)


def sampled(texts: DataFrame, total: int) -> DataFrame:
    """(text): about SAMPLE of ``total`` rows(doc_id, text), those with the smallest hashes of id and text.

    Rows without an id differ by their texts.  Rows equal in both come in together, and if
    that gives more than twice SAMPLE rows, the smallest hashes stay.
    """
    cut_off = min(1 << 30, int((1 << 30) * SAMPLE / max(1, total)) + 1)
    return (texts.withColumn("_h", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))).where(F.col("_h") < cut_off)
            .orderBy("_h", "text").limit(2 * SAMPLE).select("text"))


def fit(docs: DataFrame) -> Model:
    """Accuracies from the votes of all rows, and a scorer from a bounded sample of them."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def vote(batches):
        for batch in batches:
            total: dict[str, int] = {}
            for t in batch.column("text"):
                p = votes(t.as_py())
                total[p] = total.get(p, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()),
                                              pa.array(list(total.values()), pa.int64())], ["pattern", "n"])

    patterns = {r["pattern"]: r["n"] for r in texts.select("text").mapInArrow(tidy(vote), "pattern string, n long")
                .groupBy("pattern").agg(F.sum("n").alias("n")).collect()}
    good, table, posterior = accuracies(patterns)

    def describe(batches):
        for batch in batches:
            cells, shares, post = [], [], []
            for t in batch.column("text"):
                c, s = _sparse(t.as_py())
                cells.append(c)
                shares.append(s)
                post.append(posterior.get(votes(t.as_py()), 0.5))
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float64())),
                                              pa.array(post, pa.float64())], ["cells", "shares", "post"])

    sample = (sampled(texts, sum(patterns.values()))
              .mapInArrow(tidy(describe), "cells array<int>, shares array<double>, post double").toArrow().combine_chunks())
    weights, bias = _linear(*(c.chunk(0) if c.num_chunks else None for c in sample.columns)) if sample.num_rows else _linear()
    del sample
    hand_back()
    return Model(good, table, posterior, weights, bias)


def _linear(cells: pa.ListArray | None = None, shares: pa.ListArray | None = None, target: pa.Array | None = None,
            rounds: int = 150) -> tuple[np.ndarray, float]:
    """Logistic weights over cells for soft targets, by adaptive full-batch steps with a small ridge."""
    w, bias = np.zeros(CELLS), 0.0
    if cells is None:
        return w, bias
    lengths = np.diff(cells.offsets.to_numpy())
    some = np.flatnonzero(lengths)
    row = np.repeat(np.arange(len(cells), dtype=np.int32), lengths)
    begin = np.concatenate([[0], np.cumsum(lengths)])[some]
    col = cells.flatten().to_numpy()
    val = shares.flatten().to_numpy().astype(np.float32)
    target = target.to_numpy()
    m, v, mb, vb = np.zeros(CELLS), np.zeros(CELLS), 0.0, 0.0
    for t in range(1, rounds + 1):
        z = np.full(len(cells), bias)
        z[some] += np.add.reduceat(w[col] * val, begin) if len(some) else 0.0
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / len(cells)
        g, gb = np.bincount(col, error[row] * val, CELLS) + 1e-7 * w, error.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        fix = np.sqrt(1 - 0.99 ** t) / (1 - 0.9 ** t)
        w = w - 0.4 * fix * m / (np.sqrt(v) + 1e-9)
        bias -= 0.4 * fix * mb / (np.sqrt(vb) + 1e-9)
    return w, float(bias)


class _Weights(dict):
    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= _REMEMBERED:
            self.clear()
        a, b = _cells(word)
        out = float(self.weights[a] + self.weights[b])
        if len(word) <= 64:
            self[word] = out
        return out


def _scorer(model: Model):
    """Function from a text to the probability that it is good, built inside a task."""
    known = _Weights(model.weights)
    repeat_weight = float(model.weights[_REPEAT])

    def score(text: str | None) -> float:
        n, total = 0, 0.0
        for part in slices(text or ""):
            words = part.split()
            n += len(words)
            total += sum(map(known.__getitem__, words)) + repeat_weight * sum(map(eq, words, words[1:]))
        if not n:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(total / n + model.bias, -30, 30))))
    return score


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, votes, posterior, score and accepted (score >= THRESHOLD) of every row's whole text.

    Null, empty and blank texts hold no words: all labellers abstain, the score is 0 and the
    row is rejected.  Null and repeated doc_ids are scored row by row; other columns are ignored.
    """
    shared = share(docs.sparkSession, model)

    def run(batches):
        m = shared()
        score = _scorer(m)
        for batch in batches:
            texts = [t.as_py() for t in batch.column("text")]
            pattern = [votes(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(pattern, pa.string()),
                 pa.array([m.posterior.get(p, m.share) for p in pattern], pa.float64()),
                 pa.array([score(t) for t in texts], pa.float64())], ["doc_id", "votes", "posterior", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(tidy(run), "doc_id long, votes string, posterior double, score double")
    return out.withColumn("accepted", F.col("score") >= THRESHOLD)


def drop_rejected(docs: DataFrame, model: Model) -> DataFrame:
    """The accepted rows of ``docs`` with all their columns."""
    shared = share(docs.sparkSession, model)
    at = docs.columns.index("text")

    def run(batches):
        score = _scorer(shared())
        for batch in batches:
            yield batch.filter(pa.array([score(t.as_py()) >= THRESHOLD for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)
