"""Toxicity of texts: a learned lexicon, matched with misspellings, weighed by context.

Terms whose documents are mostly labelled toxic form a trie.  The trie is intersected with
Levenshtein automata: a state is a set of (trie node, edits used), built when first needed
and remembered, so a word costs one look-up per character and most words end in the empty
state after a few.  Hits inside quotation marks or beside reporting words count less, hits
beside a second person more; a small logistic model maps the weighed hits to a probability.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import WordHasher, cut, fold_of, hand_back, share, shingle_hashes, tidy
from panelforge.llm.tokencount import slices

#: Labelled rows that the lexicon and the model are fitted on: those with the smallest hash of doc_id.
TRAINING_ROWS = 30_000
#: A term stands in this many unlike toxic documents and its likelihood ratio against chance is this high.
MIN_DOCUMENTS, MIN_RATIO = 6, 30.0
THRESHOLD = 0.3
WINDOW = 8
EDIT_FACTOR, QUOTE_FACTOR, REPORT_FACTOR, ADDRESS_FACTOR = 0.6, 0.25, 0.5, 1.25
_REMEMBERED, _STATES = 1 << 18, 1 << 17

# Words that report speech and words that address the reader, in the languages of the corpus.
REPORTING = frozenset("said says say wrote writes called calls calling quote quoted quotes word words term terms insult "
                      "slur sagte sagt nannte wort begriff dit mot terme insulte dijo dice palabra insulto".split())
ADDRESSING = frozenset("you your yours u ur youre du dich dir dein euch ihr tu te toi vous votre usted eres vos".split())
_WORD = re.compile(r"\w+")
#: Words of a text that is scored: @ and $ may stand for letters.
_SPELLED = re.compile(r"[@$]*\w+(?:[@$]+\w+)*[@$]*")
_QUOTES = {"“": "”", "«": "»", "„": "“", "‹": "›"}
_MARK = re.compile("[\n\"" + "".join({*_QUOTES, *_QUOTES.values()}) + "]")
_LEET = str.maketrans("013457@$", "oieastas")


#: Terms of fewer letters match as they are only; terms of so many match with an edit beside an address or another hit.
SHORT = 4


def edits_allowed(term: str) -> int:
    return 0 if len(term) < SHORT else 1 if len(term) < 10 else 2


class FuzzyLexicon:
    """Lazily determinised product of a lexicon trie with Levenshtein automata."""

    def __init__(self, terms: dict[str, float], harmless: frozenset[str] = frozenset()):
        self.terms, self.harmless = terms, harmless
        self.child: list[dict[str, int]] = [{}]
        self.weight, self.allowed, self.slack, self.size = [0.0], [0], [0], [0]
        for term, weight in terms.items():
            at, k = 0, edits_allowed(term)
            self.slack[0] = max(self.slack[0], k)
            for c in term:
                to = self.child[at].get(c)
                if to is None:
                    to = len(self.child)
                    self.child[at][c] = to
                    self.child.append({})
                    self.weight.append(0.0)
                    self.allowed.append(0)
                    self.slack.append(0)
                    self.size.append(self.size[at] + 1)
                at = to
                self.slack[at] = max(self.slack[at], k)
            self.weight[at], self.allowed[at] = weight, k
        self._reset()

    def _reset(self) -> None:
        self.ids: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.accept: list[tuple[float, int, float]] = []
        self.step: dict[tuple[int, str], int] = {}
        self.start = self._state({0: 0}) if self.terms else -1

    def _state(self, reach: dict[int, int]) -> int:
        """Id of the closed state; -1 if it is empty."""
        todo = list(reach)
        while todo:  # letters of a term that the text leaves out
            v = todo.pop()
            for u in self.child[v].values():
                e = reach[v] + 1
                if e <= self.slack[u] and e < reach.get(u, 99):
                    reach[u] = e
                    todo.append(u)
        if not reach:
            return -1
        key = frozenset(reach.items())
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(key)
            ends = [(self.weight[v] * EDIT_FACTOR ** e, -e, e == 0 or self.size[v] > SHORT) for v, e in reach.items()
                    if self.weight[v] and e <= self.allowed[v]]
            best = max(ends, default=(0.0, 0, True))
            self.accept.append((best[0], -best[1], max((x for x, _, sure in ends if sure), default=0.0)))
        return self.ids[key]

    def _next(self, state: int, c: str) -> int:
        reach: dict[int, int] = {}

        def add(v: int, e: int) -> None:
            if e <= self.slack[v] and e < reach.get(v, 99):
                reach[v] = e

        for v, e in self.sets[state]:
            for letter, u in self.child[v].items():
                add(u, e + (letter != c))
            add(v, e + 1)
        return self._state(reach)

    def match(self, word: str) -> tuple[float, int, float]:
        """(strength, edits, strength without edited SHORT terms) of the best term within its allowed edits; 0 if none."""
        word = word.lower()
        found = self._match(word)
        if "@" in word or "$" in word:  # the signs may also divide words
            found = max(found, *(self._match(w) for w in _WORD.findall(word)))
        return found

    def _match(self, word: str) -> tuple[float, int, float]:
        if word in self.terms:
            return self.terms[word], 0, self.terms[word]
        if word in self.harmless:
            return 0.0, 0, 0.0
        if any(c.isdigit() or c in "@$" for c in word) and any(c.isalpha() for c in word):
            word = word.translate(_LEET)
            if word in self.harmless:
                return 0.0, 0, 0.0
        if len(self.sets) > _STATES:
            self._reset()
        state = self.start
        for c in word:
            if state < 0:
                return 0.0, 0, 0.0
            to = self.step.get((state, c))
            if to is None:
                to = self.step[state, c] = self._next(state, c)
            state = to
        return self.accept[state] if state >= 0 else (0.0, 0, 0.0)


class _Matches(dict):
    def __init__(self, lexicon: FuzzyLexicon):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> tuple[float, int, float] | None:
        if len(self) >= _REMEMBERED:
            self.clear()
        found = self.lexicon.match(word)
        found = found if found[0] else None
        if len(word) <= 64:
            self[word] = found
        return found


def _quotations(text: str) -> tuple[list[int], list[int]]:
    """Starts and ends of the quotations of a text, in order and apart; each begins and ends on one line.

    A straight mark opens where a word may begin and closes otherwise; a mark that opens
    again takes the place of one left open.  A mark that closes one kind does not open another.
    """
    spans, begun = [], {}
    for m in _MARK.finditer(text):
        c, at = m.group(), m.start()
        if c == "\n":
            begun.clear()
        elif c == '"':
            after_word = at > 0 and not text[at - 1].isspace()
            before_word = at + 1 < len(text) and text[at + 1].isalnum()
            if c in begun and (after_word or not before_word):
                spans.append((begun.pop(c), at))
            elif not (after_word and text[at - 1].isalnum()):
                begun[c] = at
        else:
            closed = [a for a, b in _QUOTES.items() if b == c and a in begun]
            spans += [(begun.pop(a), at) for a in closed]
            if c in _QUOTES and not closed:
                begun.setdefault(c, at)
    starts, ends = [], []
    for a, b in sorted(spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def _quoted(quotations: tuple[list[int], list[int]], at: int) -> bool:
    """Whether the position stands inside one of the quotations."""
    k = bisect_right(quotations[0], at) - 1
    return k >= 0 and at < quotations[1][k]


def features(text: str, matches: _Matches) -> tuple[float, float, float, int]:
    """(abuse, densest window, quoted, hits) of a whole text."""
    abuse = densest = quoted = 0.0
    hits, begin, end, quotations = 0, 0, 0, None
    for part in slices(text):
        begin, end = end, end + len(part)
        words = _SPELLED.findall(part)
        found = [i for i, m in enumerate(map(matches.__getitem__, words)) if m]
        if not found:
            continue
        quotations = quotations or _quotations(text)
        certain = [i for i in found if matches[words[i]][2]]
        lower = [w.lower() for w in words] if len(found) * WINDOW * 4 > len(words) else None
        wanted, spans = set(found), {}
        for i, m in enumerate(_SPELLED.finditer(part)):
            if i in wanted:
                spans[i] = m.span()
        recent: list[tuple[int, float]] = []
        total = 0.0
        for i in found:
            near = range(max(0, i - WINDOW), min(len(words), i + WINDOW + 1))
            around = [lower[j] if lower else words[j].lower() for j in near if j != i]
            strength, _, sure = matches[words[i]]
            k = bisect_left(certain, i - WINDOW)
            beside = any(j != i for j in certain[k: k + 2] if j <= i + WINDOW)
            if strength > sure and not beside and not any(w in ADDRESSING for w in around):
                strength = sure
            if not strength:
                continue
            hits += 1
            factor = 1.0
            if _quoted(quotations, begin + spans[i][0]):
                quoted += strength
                factor *= QUOTE_FACTOR
            if any(w in REPORTING for w in around):
                factor *= REPORT_FACTOR
            elif any(w in ADDRESSING for w in around):
                factor *= ADDRESS_FACTOR
            strength *= factor
            abuse += strength
            recent.append((i, strength))
            total += strength
            while recent[0][0] < i - 2 * WINDOW:
                total -= recent.pop(0)[1]
            densest = max(densest, total)
    return math.log1p(abuse), math.log1p(densest), math.log1p(quoted), hits


@dataclass
class Model:
    terms: dict[str, float]
    harmless: frozenset[str]
    bias: float
    weights: tuple[float, float, float]


def _training(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts of a bounded number of labelled rows that are not held out, with fold and label."""
    ids = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
           .where("doc_id is not null and toxic is not null").where(fold_of(F.col("doc_id")) != 2)
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAINING_ROWS))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return cut(texts.where("text is not null").join(F.broadcast(ids), "doc_id")
               .select("text", (F.col("toxic") > 0).cast("int").alias("toxic"),
                       fold_of(F.col("doc_id")).cast("int").alias("fold")))


def _toxic_words(rows: DataFrame) -> DataFrame:
    """(word, t): words of toxic rows that may be terms, and the unlike documents they stand in; near copies count once."""
    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            out: list[tuple[str, int]] = []
            for (_, hashes), text in zip(hasher.rows(batch.column("text")), batch.column("text"), strict=True):
                own = shingle_hashes(hashes, 4)
                if len(own):
                    words: set[str] = set()
                    for part in slices(text.as_py()):
                        words.update(_WORD.findall(part.lower()))
                    out += [(w, int(own[0])) for w in words if len(w) > 2 and not w.isdigit()]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in out], pa.string()),
                                              pa.array([k for _, k in out], pa.int64())], ["word", "kind"])

    found = rows.where("toxic = 1").select("text").mapInArrow(tidy(run), "word string, kind long").distinct()
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("t")).where(F.col("t") >= MIN_DOCUMENTS)


def _counted(rows: DataFrame, choose, word: re.Pattern = _WORD) -> DataFrame:
    """(word, n): documents in which a ``word`` that ``choose`` (built in the task) accepts stands."""
    def run(batches):
        chosen = choose()
        for batch in batches:
            total: dict[str, int] = {}
            for text in batch.column("text"):
                words: set[str] = set()
                for part in slices(text.as_py()):
                    words.update(word.findall(part.lower()))
                for w in words:
                    if chosen(w):
                        total[w] = total.get(w, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()),
                                              pa.array(list(total.values()), pa.int64())], ["word", "n"])

    return rows.select("text").mapInArrow(tidy(run), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _likelihood_ratio(t: Column, n_t: int, c: Column, n_c: int) -> Column:
    """Twice the log likelihood ratio of separate against common rates."""
    def part(k: Column, n: int, p: Column) -> Column:
        return F.when(k > 0, k * F.log(p)).otherwise(0.0) + F.when(k < n, (n - k) * F.log(1 - p)).otherwise(0.0)
    p = (t + c) / (n_t + n_c)
    ratio = 2 * (part(t, n_t, t / n_t) + part(c, n_c, c / n_c) - part(t, n_t, p) - part(c, n_c, p))
    return F.when((p > 0) & (p < 1), ratio).otherwise(0.0)


def _terms(rows: DataFrame, n_t: int, n_c: int) -> dict[str, float]:
    """Every word that is much more frequent in toxic than in clean rows, with its strength."""
    clean = _counted(rows.where("toxic = 0"), lambda: lambda w: True).withColumnRenamed("n", "c")
    both = _toxic_words(rows).join(clean, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    odds = F.log((F.col("t") + 0.5) / (n_t + 1)) - F.log((F.col("c") + 0.5) / (n_c + 1))
    ratio = _likelihood_ratio(F.least("t", F.lit(n_t)), n_t, F.col("c"), n_c)
    strong = both.withColumn("odds", odds).where((F.col("odds") > math.log(5)) & (ratio >= MIN_RATIO))
    return {r["word"]: min(6.0, r["odds"]) for r in strong.select("word", "odds").orderBy("word").collect()}


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Lexicon, harmless look-alikes and weights from at most TRAINING_ROWS labelled rows."""
    spark = docs.sparkSession
    rows = _training(docs, labels)
    size = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_t, n_c = size.get(1, 0), size.get(0, 0)
    prior = math.log((n_t + 0.5) / (n_c + 9.5))
    if not n_t or not n_c:
        return Model({}, frozenset(), prior if n_t + n_c else -3.0, (0.0, 0.0, 0.0))
    terms = _terms(rows, n_t, n_c)
    if not terms:
        return Model({}, frozenset(), prior, (0.0, 0.0, 0.0))
    shared = share(spark, terms)

    def look_alike():
        matches = _Matches(FuzzyLexicon(shared()))
        return lambda w: (matches[w] or (0.0, 0, 0.0))[1] > 0

    # all harmless look-alikes of the bounded training rows; they come from other rows than the weights, so that the weights see unknown look-alikes as they occur
    own = {r["toxic"]: r["n"] for r in rows.where("fold = 0").groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    alike = [_counted(rows.where(f"toxic = {k} and fold = 0"), look_alike, _SPELLED).withColumnRenamed("n", f"n{k}") for k in (0, 1)]
    both = alike[0].join(alike[1], "word", "left").withColumn("n1", F.coalesce("n1", F.lit(0)))
    cleaner = (F.col("n1") == 0) | (F.col("n0") * own.get(1, 0) > F.col("n1") * own.get(0, 0))
    harmless = frozenset(r["word"] for r in both.where(cleaner).select("word").collect())
    model = Model(terms, harmless, prior, (0.0, 0.0, 0.0))
    held = share(spark, model)

    def run(batches):
        m = held()
        matches = _Matches(FuzzyLexicon(m.terms, m.harmless))
        for batch in batches:
            x = [features(t.as_py(), matches)[:3] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.float64()) for v in zip(*x, strict=True)]
                                             + [batch.column("toxic")], ["a", "d", "q", "toxic"])

    sample = (rows.where("fold != 0").select("text", "toxic").mapInArrow(tidy(run), "a double, d double, q double, toxic int")
              .limit(TRAINING_ROWS).toArrow())
    if sample.num_rows:
        model.bias, model.weights = _logistic(np.column_stack([sample.column(c).to_numpy() for c in "adq"]),
                                              sample.column("toxic").to_numpy())
    del sample
    hand_back()
    return model


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, tuple[float, float, float]]:
    """Ridge logistic weights by projected Newton steps: abuse never lowers a score, quotation never raises it."""
    z = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(4)
    w[0] = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    ridge = np.diag([1e-3, 0.2, 0.2, 0.2])

    def loss(v: np.ndarray) -> float:
        u = z @ v
        return float(np.sum(np.logaddexp(0, u) - y * u) + v @ ridge @ v / 2)

    at = loss(w)
    for _ in range(200):  # steps are halved until the loss falls, so the fit can't run away
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + ridge
        step, gain = np.linalg.solve(h, z.T @ (y - p) - ridge @ w), 1.0
        while gain > 1e-6:
            new = w + gain * step
            new[1:3], new[3] = np.maximum(new[1:3], 0), min(new[3], 0)
            if loss(new) < at - 1e-9:
                break
            gain /= 2
        else:
            break
        w, at = new, loss(new)
    return float(w[0]), (float(w[1]), float(w[2]), float(w[3]))


def _scorer(model):
    """Function from a text to (score, hits), built inside a task."""
    matches = _Matches(FuzzyLexicon(model.terms, model.harmless))

    def score(text: str | None) -> tuple[float, int]:
        a, d, q, hits = features(text or "", matches)
        z = model.bias + model.weights[0] * a + model.weights[1] * d + model.weights[2] * q
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), hits
    return score


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= THRESHOLD) and hits of every row's whole text.

    Null and empty texts have no hits and get the score of a text without hits; null and
    repeated doc_ids are scored row by row, a null doc_id is never held out.  Without
    usable labels every row gets the same score.
    """
    shared = share(docs.sparkSession, model)

    def run(batches):
        score = _scorer(shared())
        for batch in batches:
            out = [score(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([s for s, _ in out], pa.float64()),
                                              pa.array([h for _, h in out], pa.int64())], ["doc_id", "score", "hits"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(tidy(run), "doc_id long, score double, hits long")
    held: Column = F.coalesce(fold_of(F.col("doc_id")) == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "hits")


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    shared = share(docs.sparkSession, model)
    at = docs.columns.index("text")

    def run(batches):
        score = _scorer(shared())
        for batch in batches:
            keep = [score(t.as_py())[0] < THRESHOLD for t in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)
