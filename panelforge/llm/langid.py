"""Language identification by interpolated Kneser-Ney character models.

Counts of character n-grams are gathered over all training rows, one map-side combined
aggregate; lower orders are continuation counts derived from the distinct n-grams.  The
interpolated probabilities of every n-gram that occurs in any language are laid out in
sorted arrays of 64-bit n-gram hashes; scoring looks every n-gram of a text up by binary search
and falls back through the shorter arrays.  The language of the lowest cross-entropy per
character wins.

All n-grams of all languages are kept.  The model is cut into shards of a bounded size by language and by
the last but one character, which an n-gram shares with its context and with all shorter
n-grams and contexts that it falls back to; single characters are in every shard.  Shards are
made one after another and broadcast; a task holds one at a time and adds up their scores.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm.common import cut, fold_of, hand_back, mix64, tidy

ORDER = 4
DISCOUNT = 0.75
#: Languages of a shard, and its n-grams of all orders times its languages.  One character of one group of languages is
#: not divided further.
SHARD_LANGUAGES = 16
SHARD_CELLS = 1 << 22
CHUNK_CHARS = 1 << 18
#: Bins of the lead over the second language (nats per character, scaled by length) for the calibrated score.
BINS = 32
#: A prediction is marked as rejected when its cross-entropy exceeds this share of the training rows of its language.
REJECT_QUANTILE = 0.995

_LETTER = None


def _classes() -> np.ndarray:
    """For every code point its folded code point if it is a letter, else 0 (a separator)."""
    global _LETTER
    if _LETTER is None:
        table = np.zeros(0x110000, np.uint32)
        for c in range(len(table)):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _LETTER = table
    return _LETTER


def letters(text: str) -> np.ndarray:
    """Folded code points with every run of other characters as one separator 0, and one at both ends."""
    if not text:
        return np.zeros(0, np.uint32)
    x = _classes()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    x = np.concatenate([[np.uint32(0)], x, [np.uint32(0)]])
    keep = np.ones(len(x), bool)
    keep[1:] = (x[1:] != 0) | (x[:-1] != 0)
    x = x[keep]
    return x if len(x) > 1 else np.zeros(0, np.uint32)


_FACTORS = mix64(np.arange(1, 33, dtype=np.uint64)) | np.uint64(1)


def hash_rows(codes: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of code points; rows of different widths hash apart."""
    total = np.full(len(codes), codes.shape[1], np.uint64)
    for j in range(codes.shape[1]):
        total += (codes[:, j].astype(np.uint64) + np.uint64(1)) * _FACTORS[j]
    return mix64(total)


def _chunks(texts) -> list:
    """Runs of rows of about CHUNK_CHARS characters: (rows, letter arrays)."""
    rows, parts, size = [], [], 0
    for i, text in enumerate(texts):
        x = letters(text.as_py() or "")
        rows.append(i)
        parts.append(x)
        size += len(x)
        if size >= CHUNK_CHARS:
            yield rows, parts
            rows, parts, size = [], [], 0
    if rows:
        yield rows, parts


def _padded(parts: list[np.ndarray], order: int) -> np.ndarray:
    """One array of all texts, each led by order - 2 more separators, so that n-grams never mix two texts' letters."""
    pad = np.zeros(order - 2, np.uint32)
    return np.concatenate([y for x in parts for y in (pad, x)]) if parts else np.zeros(0, np.uint32)


def count_ngrams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n): counts of the ``order``-grams of all rows with a language, the highest order only."""
    def run(batches):
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            found: dict[tuple[str, str], int] = {}
            by_lang: dict[str, list] = {}
            texts = batch.column("text")
            for lang in dict.fromkeys(langs):
                rows = np.flatnonzero(langs == lang)
                for _, parts in _chunks(texts.take(pa.array(rows))):
                    x = _padded([p for p in parts if len(p)], order)
                    n = len(x) - order + 1
                    if n <= 0:
                        continue
                    window = np.lib.stride_tricks.sliding_window_view(x, order)
                    _, first, count = np.unique(hash_rows(window), return_index=True, return_counts=True)
                    keep = window[first, order - 1] != 0
                    keep |= window[first, order - 2] != 0  # padding alone is no event
                    by_lang.setdefault(lang, []).append((window[first[keep]], count[keep]))
            for lang, parts in by_lang.items():
                grams = np.concatenate([g for g, _ in parts])
                counts = np.concatenate([c for _, c in parts])
                names = np.ascontiguousarray(grams.astype("<u4")).tobytes().decode("utf-32-le", "surrogatepass")
                for i, c in enumerate(counts.tolist()):
                    key = lang, names[i * order: (i + 1) * order]
                    found[key] = found.get(key, 0) + c
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()),
                 pa.array(list(found.values()), pa.int64())], ["lang", "gram", "n"])

    rows = docs.where("lang is not null and text is not null").select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(tidy(run), "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    langs: list[str]
    order: int
    keys: list[np.ndarray]      # per order from 1: sorted hashes of n-grams
    logs: list[np.ndarray]      # per order: log probability per n-gram and language
    context: list[np.ndarray]   # per order from 1: sorted hashes of contexts of that length
    backoff: list[np.ndarray]   # per order: log weight of the next shorter order per context and language
    floor: np.ndarray           # log probability of a character never seen, per language
    chars: np.ndarray | None = None  # last but one characters of the n-grams it scores, None: all
    others: bool = False        # whether it scores all but these


def fit(docs: DataFrame, order: int = ORDER) -> Model:
    """Kneser-Ney models of all languages from (lang, text) rows in one piece, whatever its size."""
    langs, tables, seen = _tables(docs, order)
    return _shard(tables, langs, order, seen, None, False)


def _tables(docs: DataFrame, order: int) -> tuple[list[str], dict[int, DataFrame], int]:
    """All languages, per length all n-grams (lang, gram, n, total of the context, last but one character c), and the
    number of single characters seen in any language."""
    counts = cut(count_ngrams(docs, order))
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    tables = {}
    for length in range(order, 0, -1):
        ranked = counts.withColumn("context", F.expr(f"left(gram, {length - 1})") if length > 1 else F.lit(""))
        total = ranked.groupBy("lang", "context").agg(F.sum("n").alias("total"))
        before = F.expr(f"substring(gram, {length - 1}, 1)") if length > 1 else F.lit("")
        tables[length] = cut(ranked.join(total, ["lang", "context"]).select("lang", "gram", "n", "total", before.alias("c")))
        if length > 1:  # continuation counts: distinct left neighbours
            counts = cut(counts.groupBy("lang", F.expr(f"right(gram, {length - 1})").alias("gram"))
                         .agg(F.count(F.lit(1)).alias("n")))
    return langs, tables, tables[1].select("gram").distinct().count()


def _plan(tables: dict[int, DataFrame], langs: list[str]) -> list[tuple[list[str], list[str] | None, bool]]:
    """(languages, characters or None, whether all but these) of every shard."""
    sizes: dict[str, dict[str, int]] = {}
    for length, table in tables.items():
        if length > 1:
            for r in table.groupBy("lang", "c").agg(F.count(F.lit(1)).alias("k")).collect():
                own = sizes.setdefault(r["lang"], {})
                own[r["c"]] = own.get(r["c"], 0) + r["k"]
    out = []
    for at in range(0, len(langs), SHARD_LANGUAGES):
        group = langs[at: at + SHARD_LANGUAGES]
        total: dict[str, int] = {}
        for lang in group:
            for c, k in sizes.get(lang, {}).items():
                total[c] = total.get(c, 0) + k
        bins: list[list[str]] = []
        room = 0
        for c, k in sorted(total.items()):
            if not bins or k * len(group) > room:
                bins.append([])
                room = SHARD_CELLS
            bins[-1].append(c)
            room -= k * len(group)
        if len(bins) < 2:
            out.append((group, None, False))
        else:  # the first one also scores n-grams of characters that these languages don't have
            out.append((group, [c for b in bins[1:] for c in b], True))
            out += [(group, b, False) for b in bins[1:]]
    return out


def _shard(tables: dict[int, DataFrame], langs: list[str], order: int, seen: int,
           chars: list[str] | None, others: bool) -> Model:
    if not langs:
        return Model([], order, [], [], [], [], np.zeros(0))
    own = {}
    for length, table in tables.items():
        rows = table.where(F.col("lang").isin(langs))
        if length > 1 and chars is not None:
            rows = rows.where(~F.col("c").isin(chars) if others else F.col("c").isin(chars))
        own[length] = _codes(rows.select("lang", "gram", "n", "total").toArrow(), langs, length)
    model = _layout(own, langs, order, seen)
    if chars is not None:
        model.chars, model.others = np.unique(np.array([ord(c) for c in chars], np.uint32)), others
    return model


def _codes(rows: pa.Table, langs: list[str], length: int) -> list[tuple]:
    """Per language: n-grams as code points, counts and totals of their contexts."""
    codes = np.frombuffer("".join(rows.column("gram").to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = codes.reshape(rows.num_rows, length)
    place = {lang: k for k, lang in enumerate(langs)}
    who = np.array([place[x] for x in rows.column("lang").to_pylist()], np.int64)
    n, total = (rows.column(c).to_numpy().astype(float) for c in ("n", "total"))
    return [(codes[who == k], n[who == k], total[who == k]) for k in range(len(langs))]


def _layout(tables: dict, langs: list[str], order: int, seen: int) -> Model:
    n = len(langs)
    model = Model(langs, order, [], [], [], [], np.zeros(n))
    for length in range(1, order + 1):
        own = tables[length]
        keys = np.unique(np.concatenate([hash_rows(c) for c, _, _ in own])) if own else np.empty(0, np.uint64)
        heads = np.unique(np.concatenate([hash_rows(c[:, :-1]) for c, _, _ in own])) if own else keys
        weight = np.zeros((len(heads), n))  # 0: the context was never seen, all mass goes to the shorter order
        for k, (codes, count, total) in enumerate(own):
            share = np.maximum(count - DISCOUNT, 0) / total
            used = np.bincount(np.searchsorted(heads, hash_rows(codes[:, :-1])), share, len(heads))
            weight[:, k] = np.log(np.maximum(1 - used, 1e-9))
        if length == 1:
            spare = np.exp(weight[0]) if len(heads) else np.ones(n)
            model.floor = np.log(np.maximum(spare, 1e-6) / (max(1, seen) + 1))
            probs = np.tile(np.exp(model.floor), (len(keys), 1))
        else:  # interpolation: weight of the context times the shorter order
            all_codes = np.concatenate([c for c, _, _ in own])
            _, first = np.unique(hash_rows(all_codes), return_index=True)
            codes = all_codes[first]
            lower = _lookup(model, codes[:, 1:])
            probs = np.exp(lower + weight[np.searchsorted(heads, hash_rows(codes[:, :-1]))])
        for k, (codes, count, total) in enumerate(own):
            probs[np.searchsorted(keys, hash_rows(codes)), k] += np.maximum(count - DISCOUNT, 0) / total
        model.keys.append(keys)
        model.logs.append(np.log(np.maximum(probs, 1e-12)).astype(np.float32))
        model.context.append(heads)
        model.backoff.append(weight.astype(np.float32))
    return model


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Position of each wanted hash in the sorted array, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def _lookup(model: Model, codes: np.ndarray) -> np.ndarray:
    """Log probability of the last character of each row given the ones before, per language."""
    length = codes.shape[1]
    if length == 0:
        return np.tile(model.floor, (len(codes), 1))
    at = _find(model.keys[length - 1], hash_rows(codes))
    out = np.empty((len(codes), len(model.langs)), np.float32)
    hit = at >= 0
    out[hit] = model.logs[length - 1][at[hit]]
    if not hit.all():
        rest = codes[~hit]
        lower = _lookup(model, rest[:, 1:])
        head = _find(model.context[length - 1], hash_rows(rest[:, :-1]))
        known = head >= 0
        lower[known] += model.backoff[length - 1][head[known]]
        out[~hit] = lower
    return out


def score_batch(model: Model, texts) -> tuple[np.ndarray, np.ndarray]:
    """Cross-entropy (nats per character) of each text under every language, and the characters scored.

    A shard gives its share of the cross-entropy, that of the n-grams it holds.
    """
    size, order = len(texts), model.order
    entropy, count = np.zeros((size, len(model.langs))), np.zeros(size, np.int64)
    for rows, parts in _chunks(texts):
        who = np.repeat(np.arange(len(parts)), [len(p) and len(p) - 1 for p in parts])
        if not len(who):
            continue
        blocks = []
        for p in parts:
            if len(p):
                padded = np.concatenate([np.zeros(order - 2, np.uint32), p])
                blocks.append(np.lib.stride_tricks.sliding_window_view(padded, order))
        window = np.concatenate(blocks)
        n = np.bincount(who, minlength=len(parts))
        if model.chars is not None:
            mine = np.isin(window[:, -2], model.chars) != model.others
            window, who = window[mine], who[mine]
        key = hash_rows(window)
        distinct, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        logs = _lookup(model, window[first])[inverse]
        total = np.stack([np.bincount(who, logs[:, k], len(parts)) for k in range(len(model.langs))], axis=1)
        entropy[rows] = -total / np.maximum(n, 1)[:, None]
        count[rows] = n
    return entropy, count


def _sent(spark: SparkSession, model: Model):
    """Broadcast a shard; the function returned reads it inside a task and keeps nothing of it."""
    held = spark.sparkContext.broadcast(cloudpickle.dumps(model))

    def read() -> Model:
        out = pickle.loads(held.value)
        vars(held).pop("_value", None)  # it is read from its file again when it is needed again
        return out
    return read


def identify(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Language of every row's whole text: doc_id, held_out, lang_pred, score, cross_entropy, rejected.

    Rows whose crc32(doc_id as text) mod 4 is 2 are held out; the models and the calibration
    learn from the others with a non-null lang.  lang_pred is a learned language, or ``und``
    (score 0, rejected) if the text is null or has no letters, or nothing could be learned.  score is the
    share of training rows with a like lead over the second language that were predicted
    right; rejected marks cross-entropies beyond what the training rows of the predicted
    language show.  Ties go to the first language in alphabetical order.  Null or repeated doc_ids are
    scored row by row; a null doc_id is never held out.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    rows = rows.withColumn("held_out", F.coalesce(fold_of(F.col("doc_id")) == 2, F.lit(False)))
    langs, tables, seen = _tables(rows.where("not held_out"), order)
    shards = []
    for group, chars, others in _plan(tables, langs):
        model = _shard(tables, group, order, seen, chars, others)
        shards.append((langs.index(group[0]), len(group), _sent(docs.sparkSession, model)))
        del model
        hand_back()

    def run(batches):
        one = shards[0][2]() if len(shards) == 1 else None
        for batch in batches:
            n = batch.num_rows
            if langs:
                entropy = np.zeros((n, len(langs)))
                for at, width, read in shards:
                    part, count = score_batch(one or read(), batch.column("text"))
                    entropy[:, at: at + width] += part
                ranked = np.sort(entropy, axis=1)
                best = entropy.argmin(axis=1)
                lead = (ranked[:, 1] - ranked[:, 0]) * np.sqrt(count) if len(langs) > 1 else np.sqrt(count)
                names = [langs[k] if c else "und" for k, c in zip(best, count, strict=True)]
                low = ranked[:, 0]
            else:
                names, lead, low = ["und"] * n, np.zeros(n), np.zeros(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), batch.column("lang"), pa.array(names),
                 pa.array(low.astype(float)), pa.array(np.minimum(BINS - 1, lead * 4).astype(np.int32))],
                ["doc_id", "held_out", "lang", "lang_pred", "cross_entropy", "bin"])

    scored = cut(rows.select("doc_id", "held_out", "lang", "text").mapInArrow(
        tidy(run), "doc_id long, held_out boolean, lang string, lang_pred string, cross_entropy double, bin int"))
    learned = scored.where("not held_out and lang is not null and lang_pred != 'und'")
    bins = {r["bin"]: (r["n"], r["right"]) for r in learned.groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right")).collect()}
    reliability, best = [], 0.0
    for b in range(BINS):  # at most BINS rows; a larger lead never scores lower
        n, right = bins.get(b, (0, 0))
        best = max(best, (right + 1) / (n + 2)) if n else best
        reliability.append(best or 0.5)
    limits = cut(learned.where("lang = lang_pred").groupBy("lang_pred").agg(
        F.percentile_approx("cross_entropy", REJECT_QUANTILE, 1000).alias("_limit")))
    scored = scored.join(F.broadcast(limits), "lang_pred", "left")  # one row a language
    beyond = F.coalesce(F.col("cross_entropy") > F.col("_limit"), F.lit(False))
    und = F.col("lang_pred") == "und"
    return scored.select(
        "doc_id", "held_out", "lang_pred",
        F.when(und, 0.0).otherwise(F.get(F.array(*[F.lit(float(x)) for x in reliability]), F.col("bin"))).alias("score"),
        "cross_entropy", (und | beyond).alias("rejected"))
