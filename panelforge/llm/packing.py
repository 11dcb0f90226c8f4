"""Vector best-fit packing of token sequences.

An item asks for tokens, for one place among the documents of a sequence, and for attention
cost (its length squared); a sequence offers a capacity of each.  All three follow from an
item's length, so the packing is decided on counts by length: bins with the same contents
form one row of a plan with a multiplicity, and items go, longest first, into the bins
that score best among those where no capacity is exceeded, by the weighted dot product of item
and residual capacities or by the norm of what stays free.  The plan is bounded by the
number of lengths, whatever the number of documents.  Spark counts the lengths, numbers the
pieces of each length without gaps and joins the numbers with the plan's intervals.
"""

from __future__ import annotations

import base64
import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import read_back, scratch_table, tidy

END = 0
_BATCH_CHARS = 1 << 20


def byte_pair_file() -> str:
    """Path of the shipped byte-level vocabulary."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of a byte-level tokenizer file, by the compiled merger where it can take a text, else by the file's own library."""

    #: The split pattern of byte-level vocabularies that use the library's default (fixed value).
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.plain = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split, model = spec["pre_tokenizer"], spec["model"]
        default = (split["type"] == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]
                   and model["type"] == "BPE" and spec["normalizer"] is None and spec["post_processor"] is None
                   and not model["dropout"] and not model["ignore_merges"])
        special = {t["content"]: t["id"] for t in spec["added_tokens"]
                   if t["special"] and not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"])}
        self.quick = None
        if default and len(special) == len(spec["added_tokens"]):
            alphabet = _byte_letters()
            ranks = {bytes(alphabet[c] for c in word): i for word, i in model["vocab"].items() if word not in special}
            self.quick = tiktoken.Encoding("file", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        """Token ids of one text, without added special tokens."""
        if self.quick is not None:
            try:
                return np.asarray(self.quick.encode_to_numpy(text, allowed_special="all"), np.uint32)
            except BaseException as error:  # the merger gives up on some very long runs by a panic of its own kind
                if isinstance(error, (KeyboardInterrupt, SystemExit, GeneratorExit)):
                    raise
        return np.array(self.plain.encode(text, add_special_tokens=False).ids, np.uint32)


def _byte_letters() -> dict[str, int]:
    """Byte by letter of byte-level vocabularies: printable Latin-1 letters stand for themselves, the rest follow from 256 on."""
    own = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b != 0xAD]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


# ---------------------------------------------------------------- the plan

class Plan:
    """Bins by contents: a plan row has a multiplicity and, per length, how many items of it each bin holds.

    ``rule`` is "dot" (largest weighted dot product of item and residual) or "norm" (smallest
    weighted norm of what stays free).  Capacities: tokens, documents, attention cost.
    """

    def __init__(self, counts: dict[int, int], capacity: tuple[int, int, int], rule: str,
                 weights: tuple[float, float, float] = (1.0, 0.0, 0.0)):
        self.capacity = np.array(capacity, np.int64)
        self.rule, self.weights = rule, np.array(weights)
        for length in counts:
            if (self.capacity < (length, 1, length * length)).any():
                raise ValueError(f"an item of {length} tokens fits into no sequence")
        size = 64
        self.free = np.zeros((size, 3), np.int64)
        self.times = np.zeros(size, np.int64)
        self.contents: list[list[tuple[int, int]]] = []
        for length in sorted(counts, reverse=True):
            self._place(length, counts[length])

    @property
    def bins(self) -> int:
        return int(self.times[: len(self.contents)].sum())

    def _row(self, free: np.ndarray, times: int, contents: list[tuple[int, int]]) -> None:
        at = len(self.contents)
        if at == len(self.times):
            self.free = np.concatenate([self.free, np.zeros_like(self.free)])
            self.times = np.concatenate([self.times, np.zeros_like(self.times)])
        self.free[at], self.times[at] = free, times
        self.contents.append(contents)

    def _place(self, length: int, left: int) -> None:
        item = np.array([length, 1, length * length], np.int64)
        while left:
            n = len(self.contents)
            fits = np.flatnonzero((self.free[:n] >= item).all(axis=1) & (self.times[:n] > 0))
            if len(fits):
                share = self.free[fits] / self.capacity
                own = item / self.capacity
                if self.rule == "dot":
                    best = fits[int(np.argmax((share * own * self.weights).sum(axis=1)))]
                else:
                    best = fits[int(np.argmin(((share - own) ** 2 * self.weights).sum(axis=1)))]
                free, contents = self.free[best], self.contents[best]
            else:
                best, free, contents = None, self.capacity, []
            each = int((free // item).min())
            bins = left // each if best is None else min(int(self.times[best]), left // each)
            if bins:
                self._take(best, bins, free - each * item, [*contents, (length, each)])
                left -= bins * each
            elif left:  # the last bin takes what is left
                self._take(best, 1, free - left * item, [*contents, (length, left)])
                left = 0

    def _take(self, source: int | None, bins: int, free: np.ndarray, contents: list[tuple[int, int]]) -> None:
        if source is not None and self.times[source] == bins:
            self.free[source], self.contents[source] = free, contents
            return
        if source is not None:
            self.times[source] -= bins
        self._row(free, bins, contents)

    def intervals(self) -> list[tuple[int, int, int, int, int, int]]:
        """(length, first, last, sequence, each, offset): items first to last of a length fill ``each`` places a bin
        from ``offset`` on in consecutive bins from ``sequence`` on."""
        used: dict[int, int] = {}
        out, sequence = [], 0
        for times, contents in zip(self.times.tolist(), self.contents):
            offset = 0
            for length, each in contents:
                first = used.get(length, 0)
                used[length] = first + each * times
                out.append((length, first, used[length] - 1, sequence, each, offset))
                offset += length * each
            sequence += times
        return out


def best_plan(counts: dict[int, int], capacity: tuple[int, int, int],
              weights: tuple[float, float, float] = (1.0, 0.0, 0.0)) -> Plan:
    """The plan with fewest bins of both rules."""
    return min((Plan(counts, capacity, rule, weights) for rule in ("norm", "dot")), key=lambda p: p.bins)


# ---------------------------------------------------------------- Spark

def pieces(docs: DataFrame, path: str, tokens: int, columns: list[Column]) -> DataFrame:
    """Pieces (doc_id, piece, start, length, *columns, task, nth) of all documents, written to the shared folder.

    A document's ids end with one END.  Only documents of more than ``tokens`` ids are cut, into
    pieces of ``tokens``; the first may be shorter.  ``columns`` are expressions over ``ids``,
    the piece's ids as little-endian unsigned 32-bit integers.  (task, length, nth) number the
    pieces of a length within the task that made them.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids", pa.binary()), ("task", pa.int32()), ("nth", pa.int64())])

    def run(batches):
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()
        encoder = Encoder(path)
        seen: dict[int, int] = {}
        out: list[list] = [[] for _ in range(6)]
        held = 0

        def batch():
            n = len(out[0])
            made = pa.RecordBatch.from_arrays(
                [*[pa.array(c, f.type) for c, f in zip(out[:5], list(schema)[:5])], pa.array([task] * n, pa.int32()),
                 pa.array(out[5], pa.int64())], schema=schema)
            for c in out:
                c.clear()
            return made

        for rows in batches:
            for doc_id, text in zip(rows.column("doc_id"), rows.column("text")):
                text = text.as_py() or ""
                ids = np.append(encoder.ids(text), np.uint32(END)).astype("<u4")
                start = 0
                for k, end in enumerate(range(len(ids) % tokens or tokens, len(ids) + 1, tokens)):
                    length = end - start
                    seen[length] = seen.get(length, -1) + 1
                    for c, v in zip(out, (doc_id.as_py(), k, start, length, ids[start:end].tobytes(), seen[length])):
                        c.append(v)
                    start = end
                held += len(ids)
                if held > _BATCH_CHARS:
                    yield batch()
                    held = 0
        yield batch()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = rows.mapInArrow(tidy(run), "doc_id long, piece int, start long, length long, ids binary, task int, nth long")
    path_ = scratch_table(made.select("doc_id", "piece", "start", "length", *columns, "task", "nth"), "pieces")
    return read_back(docs.sparkSession, path_)


def pack(docs: DataFrame, path: str | None = None, tokens: int = 2048, documents: int | None = None,
         attention: int | None = None, weights: tuple[float, float, float] = (1.0, 0.0, 0.0),
         columns: list[Column] | None = None) -> DataFrame:
    """Sequences of at most ``tokens`` tokens over all documents, in as few sequences as best fit finds.

    Returns one row per piece: doc_id, piece (from 0), start (ids of the document before it),
    length, ``columns`` (default: ids), sequence_id and offset (place there, gapless from 0).  A
    sequence holds at most ``documents`` pieces and a sum of squared lengths of at most
    ``attention``; unset, both follow from ``tokens`` and never bind.  Null texts count as
    empty: one END token.  Rows with a null or repeated doc_id are documents of their own.
    No documents give no rows.  Pieces longer than any capacity raise an error.  Other columns
    are ignored.
    """
    spark = docs.sparkSession
    columns = [F.col("ids")] if columns is None else columns
    capacity = (tokens, documents or tokens, attention or tokens * tokens)
    cut = pieces(docs, path or byte_pair_file(), tokens, columns)
    by_task = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    # at most one row a length
    counts = {r.length: r.n for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = best_plan(counts, capacity, weights)
    # bounded by the number of lengths, not by the documents
    slots = spark.createDataFrame(plan.intervals(), "of long, first long, last long, sequence long, each long, place long")
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shifts = by_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    rank = F.col("nth") + F.col("shift") - F.col("first")
    shifts = (shifts.join(by_task, ["length", "task"])
              .join(F.broadcast(slots), (F.col("length") == F.col("of")) & (F.col("shift") <= F.col("last"))
                    & (F.col("shift") + F.col("n") > F.col("first")))
              .select("length", "task", "shift", "first", "last", "sequence", "each", "place"))
    placed = cut.join(shifts, ["length", "task"]).where(
        (F.col("nth") + F.col("shift")).between(F.col("first"), F.col("last")))
    kept = [c for c in cut.columns if c not in ("task", "nth")]
    return placed.select(*kept, (F.col("sequence") + F.floor(rank / F.col("each"))).cast("long").alias("sequence_id"),
                         (F.col("place") + rank % F.col("each") * F.col("length")).cast("long").alias("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids, parts): the ids of each sequence and the lengths of its parts in order; bounded by the capacity."""
    row = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    whole = packed.groupBy("sequence_id").agg(row.alias("rows"))
    joined = F.aggregate("rows", F.lit(b"").cast("binary"), lambda a, r: F.concat(a, r["ids"]))
    length = F.aggregate("rows", F.lit(0).cast("long"), lambda a, r: a + r["length"])
    return whole.select("sequence_id", length.alias("length"), joined.alias("ids"),
                        F.transform("rows", lambda r: r["length"]).alias("parts"))
