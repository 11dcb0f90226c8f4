"""SentencePiece encoding and decoding with a relational lattice.

A text is cut into units at spaces and line breaks; no piece crosses such a cut.  The substrings of
bounded length of a unit are equi-joined to the piece table, the matches are the edges of
the unit's lattice, and a fold over the edges (Spark's higher-order aggregate) keeps the
best path to every position.  The lattice runs once per distinct frequent unit, not per
occurrence; the resulting dictionary has a fixed bound and is broadcast.  Units beyond the
bound are encoded where they occur, by the same recurrence over the same pieces.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import cut, hand_back, list_array, share, tidy
from panelforge.llm.tokencount import VOCABULARY

SPACE = "▁"
#: Most units in the broadcast dictionary (about 200 bytes each), and the longest unit (characters) that the lattice takes.
DICTIONARY, LONGEST = 1 << 18, 32
#: Offset of Zipf's law for files whose scores are ranks.
ZIPF_OFFSET = 2.7
#: Score of a character without a piece below the worst piece, as the public library sets it.
UNKNOWN_MARGIN = 10.0
_UNITS = rf"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+"
_SLICE = 1 << 20
#: Paths of rarer units that a task remembers, about 300 bytes each.
_REMEMBERED = 1 << 16
#: Rows of a batch that are encoded or decoded at once.
_ROWS = 1024


@dataclass
class Pieces:
    """Pieces with ids and scores, the surface bytes of every id, and the id of byte 0."""
    table: dict[str, tuple[int, float]]
    surface: list[bytes]
    byte_base: int
    longest: int
    unknown: float

    @classmethod
    def load(cls, path: str = VOCABULARY) -> Pieces:
        """From a SentencePiece model file with byte fallback, identity normalisation and a dummy prefix.

        Viterbi paths need log probabilities.  The scores of a pair-merging file are negative ranks
        (whole numbers from 0 down); they become log probabilities by Zipf's law over the ranks, rounded so that sums are exact
        and ties are ties.
        """
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        table, surface, base = {}, [], -1
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                base = i if int(piece[3:5], 16) == 0 else base
                surface.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                surface.append(b"")
            else:
                table[piece] = i, float(model.get_score(i))
                surface.append(piece.replace(SPACE, " ").encode())
        if table and all(s <= 0 and s == int(s) for _, s in table.values()):
            rank = {p: min(-s, len(table)) + ZIPF_OFFSET for p, (_, s) in table.items()}
            total = math.log(sum(1 / r for r in rank.values()))
            table = {p: (i, round((-math.log(rank[p]) - total) * 65536) / 65536) for p, (i, _) in table.items()}
        return cls.of(table, surface, base)

    @classmethod
    def of(cls, table: dict[str, tuple[int, float]], surface: list[bytes], byte_base: int) -> Pieces:
        if any(SPACE in p.lstrip(SPACE) or "\n" in p and p != "\n" for p in table):
            raise ValueError("a piece crosses a word or line boundary")
        return cls(table, surface, byte_base, max(map(len, table), default=1),
                   min((s for _, s in table.values()), default=0.0) - UNKNOWN_MARGIN)


    @cached_property
    def trie(self) -> dict:
        """Pieces by character; the entry under the empty string holds (id, score)."""
        root: dict = {}
        for piece, own in self.table.items():
            node = root
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = own
        return root


def best_path(unit: str, pieces: Pieces) -> tuple[int, ...]:
    """Ids of the best-scoring segmentation; on equal scores the last piece is the longest possible."""
    n = len(unit)
    score, back = [0.0] + [-float("inf")] * n, [(0, -1)] * (n + 1)
    root, unknown = pieces.trie, pieces.unknown
    for start in range(n):
        base, node, end = score[start], root, start
        for c in unit[start: start + pieces.longest]:
            node = node.get(c)
            if node is None:
                break
            end += 1
            own = node.get("")
            if own is not None and base + own[1] > score[end]:
                score[end], back[end] = base + own[1], (start, own[0])
        if base + unknown > score[start + 1] and "" not in root.get(unit[start], ()):
            score[start + 1], back[start + 1] = base + unknown, (start, -1)
    out: list[int] = []
    while n:
        start, own = back[n]
        if own < 0:
            out.extend(pieces.byte_base + b for b in reversed(unit[start].encode()))
        else:
            out.append(own)
        n = start
    return tuple(reversed(out))


def frequent_units(docs: DataFrame, bound: int = DICTIONARY) -> DataFrame:
    """(unit): the most frequent words with a space mark before them, at most ``bound``, whole count classes at a time.

    Words that occur once or are longer than the lattice takes are left out.
    """
    text = F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit(" "))
    units = docs.where(F.col("text").isNotNull()).select(F.explode(F.split(text, " ")).alias("unit"))
    units = units.where((F.col("unit") != "") & ~F.contains("unit", F.lit(SPACE)))
    counts = (units.groupBy("unit").agg(F.count(F.lit(1)).alias("n"))
              .where((F.col("n") > 1) & (F.char_length("unit") < LONGEST)))
    counts = cut(counts.select(F.concat(F.lit(SPACE), "unit").alias("unit"), F.floor(F.log2("n") * 8).cast("int").alias("level")))
    room, least = bound, None
    for r in counts.groupBy("level").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("level")).collect():
        room -= r["n"]  # at most a few hundred levels
        if room < 0:
            break
        least = r["level"]
    return counts.where(F.col("level") >= least).select("unit") if least is not None else counts.limit(0).select("unit")


def lattice_paths(units: DataFrame, pieces: Pieces) -> DataFrame:
    """(unit, ids): best path of each distinct unit by substring join and fold."""
    spark = units.sparkSession
    table = spark.createDataFrame([(p, i, s) for p, (i, s) in pieces.table.items()], "piece string, id int, score double")
    spots = units.select("unit", F.char_length("unit").alias("n"))
    spots = spots.select("unit", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("start"))
    ends = F.sequence(F.col("start") + 1, F.least(F.col("n"), F.col("start") + pieces.longest))
    spans = (spots.select("unit", "n", "start", F.explode(ends).alias("end"))
             .withColumn("piece", F.expr("substring(unit, start + 1, end - start)")))
    joined = spans.join(F.broadcast(table), "piece", "left").where("id is not null or end = start + 1")
    raw = F.hex(F.encode("piece", "UTF-8"))
    spelled = F.transform(F.sequence(F.lit(0), (F.length(raw) / 2).cast("int") - 1),
                          lambda i: F.conv(F.substr(raw, i * 2 + 1, F.lit(2)), 16, 10).cast("int") + pieces.byte_base)
    edge = F.struct("end", "start", F.coalesce("score", F.lit(pieces.unknown)).alias("score"),
                    F.when(F.col("id").isNotNull(), F.array("id")).otherwise(spelled).alias("ids"))
    edges = joined.groupBy("unit", "n").agg(F.sort_array(F.collect_list(edge)).alias("edges"))
    none = F.array().cast("array<int>")

    def state(score: Column, ids: Column) -> Column:
        return F.struct(score.alias("score"), ids.alias("ids"))

    def reach(best: Column, end: Column) -> Column:
        def better(own: Column, x: Column) -> Column:
            total = F.get(best, x["start"])["score"] + x["score"]
            return F.when(total > own["score"], state(total, F.concat(F.get(best, x["start"])["ids"], x["ids"]))).otherwise(own)
        here = F.filter("edges", lambda x: x["end"] == end)
        return F.concat(best, F.array(F.aggregate(here, state(F.lit(-float("inf")), none), better)))

    path = F.aggregate(F.sequence(F.lit(1), F.col("n")), F.array(state(F.lit(0.0), none)), reach,
                       lambda best: F.element_at(best, -1)["ids"])
    return edges.select("unit", path.alias("ids"))


def build_dictionary(docs: DataFrame, pieces: Pieces, bound: int = DICTIONARY) -> dict[str, bytes]:
    """Words (without their space mark) with the packed ids of their paths, at most ``bound``."""
    rows = lattice_paths(frequent_units(docs, bound), pieces).toArrow()
    out = {}
    for chunk in rows.to_batches():
        out |= {u[1:]: _packed(ids) for u, ids in zip(chunk.column("unit").to_pylist(), chunk.column("ids").to_pylist(),
                                                      strict=True)}
    return out


def _packed(ids) -> bytes:
    return array("i", ids).tobytes()


class _Paths(dict):
    """Unit -> ids as bytes, found when missing and remembered up to a bound; ``lead`` is put before the unit."""

    def __init__(self, known: dict[str, bytes], lead: str, pieces: Pieces):
        super().__init__(known)
        self.lead, self.pieces, self.extra = lead, pieces, []

    def __missing__(self, unit: str) -> bytes:
        ids = _packed(best_path(self.lead + unit, self.pieces))
        if len(unit) <= 2 * LONGEST:
            if len(self.extra) >= _REMEMBERED:
                for old in self.extra:
                    del self[old]
                self.extra.clear()
            self.extra.append(unit)
            self[unit] = ids
        return ids


_FIND = re.compile(_UNITS)


class Encoder:
    """Ids of whole texts from a dictionary of unit paths (without their space mark), built inside a task."""

    def __init__(self, known: dict[str, bytes], pieces: Pieces):
        self.spaced, self.bare = _Paths(known, SPACE, pieces), _Paths({}, "", pieces)

    def ids(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        return np.frombuffer(b"".join(self._runs(text)), np.int32)

    def _runs(self, text: str) -> Iterator[bytes]:
        """Packed ids of the units in order, a line or a slice of a line at a time."""
        for k, line in enumerate(text.split("\n")):
            if k:
                yield self.bare["\n"]
            if line and len(line) <= _SLICE:
                words = line.split(" ")
                if "" not in words:  # single spaces only: every word but a later line's first has one space mark
                    yield self.bare[words[0]] if k else self.spaced[words[0]]
                    yield b"".join(map(self.spaced.__getitem__, words[1:]))
                    continue
            whole, at = ("" if k else SPACE) + line.replace(" ", SPACE), 0
            while at < len(whole):
                end = at + _SLICE
                while end < len(whole) and not (whole[end] == SPACE and whole[end - 1] != SPACE):
                    end += 1
                yield b"".join(map(self.bare.__getitem__, _FIND.findall(whole[at:end])))
                at = end


class Decoder:
    """Texts of id arrays, built inside a task."""

    def __init__(self, surface: list[bytes]):
        self.surface = pa.array(surface, pa.binary())

    def texts(self, parts: list[np.ndarray]) -> list[str]:
        """Surfaces joined, the leading space taken off; bytes that are no UTF-8 become replacement characters."""
        flat = np.concatenate(parts) if parts else np.empty(0, np.int32)
        joined = self.surface.take(pa.array(flat))
        ends = np.frombuffer(joined.buffers()[1], np.int32, len(joined) + 1)
        data = joined.buffers()[2].to_pybytes() if joined.buffers()[2] is not None else b""
        at, out = 0, []
        for part in parts:
            text = data[ends[at]: ends[at + len(part)]].decode("utf-8", "replace")
            out.append(text[1:] if text[:1] == " " else text)
            at += len(part)
        return out


def encode(docs: DataFrame, pieces: Pieces, keep: list[str], bound: int = DICTIONARY, check: bool = False) -> DataFrame:
    """The ``keep`` columns and piece_ids (array<int>) of every row; with ``check`` also exact (decoding gives the text back).

    Texts get a leading space mark and every space becomes one, as the public library does
    for this kind of model; characters without a piece are spelled in bytes.  A null text
    has null ids and a null exact, an empty one an empty array.  Null and repeated doc_ids make no difference.
    """
    shared = share(docs.sparkSession, (build_dictionary(docs, pieces, bound), pieces))
    hand_back()

    def run(batches):
        known, own = shared()
        encoder, decoder = Encoder(known, own), Decoder(own.surface)
        del known  # the encoder has its own copy
        for batch in _sliced(batches):
            texts = batch.column("text").to_pylist()
            parts = [encoder.ids(t or "") for t in texts]
            exact = [pa.array([None if t is None else t == u for t, u in zip(texts, decoder.texts(parts), strict=True)],
                              pa.bool_())] if check else []
            ids = list_array(parts, pa.int32())
            if None in texts:
                ids = pa.ListArray.from_arrays(ids.offsets, ids.values, mask=pa.array([t is None for t in texts]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), ids, *exact],
                                             [*keep, "piece_ids", *(["exact"] if check else [])])

    rows = docs.select(*keep, *([] if "text" in keep else ["text"]))
    return rows.mapInArrow(tidy(run), f"{_kinds(docs, keep)}, piece_ids array<int>" + (", exact boolean" if check else ""))


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def _kinds(rows: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)


def decode(rows: DataFrame, pieces: Pieces, keep: list[str]) -> DataFrame:
    """The ``keep`` columns and decoded (string) from piece_ids; null ids give a null text."""
    shared = share(rows.sparkSession, pieces.surface)

    def run(batches):
        decoder = Decoder(shared())
        for batch in _sliced(batches):
            ids = batch.column("piece_ids").to_pylist()
            texts = decoder.texts([np.array(x or (), np.int32) for x in ids])
            out = pa.array([None if x is None else t for x, t in zip(ids, texts, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), out], [*keep, "decoded"])

    return rows.select(*dict.fromkeys([*keep, "piece_ids"])).mapInArrow(tidy(run), f"{_kinds(rows, keep)}, decoded string")


def round_trip(docs: DataFrame, pieces: Pieces, bound: int = DICTIONARY) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 (of the ids as little-endian 32-bit integers) and exact (decoding gives the text back).

    Encodes and decodes in one pass.  exact is false for texts that hold the space mark
    itself; null texts have no pieces, a null ids_crc32 and a null exact.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = share(docs.sparkSession, (build_dictionary(rows, pieces, bound), pieces))
    hand_back()

    def run(batches):
        known, own = shared()
        encoder, decoder = Encoder(known, own), Decoder(own.surface)
        for batch in _sliced(batches):
            texts = batch.column("text").to_pylist()
            ids = [encoder.ids(t or "") for t in texts]
            back = decoder.texts(ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([None if t is None else zlib.crc32(x.astype("<i4").tobytes())
                           for t, x in zip(texts, ids, strict=True)], pa.int64()),
                 pa.array([None if t is None else t == u for t, u in zip(texts, back, strict=True)], pa.bool_())],
                ["doc_id", "n_pieces", "ids_crc32", "exact"])

    return rows.mapInArrow(tidy(run), "doc_id long, n_pieces long, ids_crc32 long, exact boolean")
