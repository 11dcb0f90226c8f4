"""Vector code compression: product codebooks refined under norm-of-sum bounds.

A bound is made once, when a part is scanned, and then only carries the number of that
round.  All codebooks of earlier rounds are kept, so a later round compares the entry of
the bound's round with today's: an entry that wandered there and back has moved by the norm
of the sum of its steps, not by the sum of their norms.  A part keeps its entry, unread, if
its upper bound plus its own entry's net displacement stays below the lower bound of every
group of entries less the largest net displacement in that group since the bound's round.
Of all others the groups that stay open are scanned exactly and stamped anew.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import Rounds
from panelforge.llm.lloyd import constants, finite, group_bounds, integer_vectors, lloyd, measured


class NetBounds:
    """Bounds stamped with their round, judged by the displacement between that round's codebooks and today's."""

    def __init__(self, groups: int) -> None:
        self.groups = groups
        self.history: list[np.ndarray] = []

    def start(self, books: np.ndarray) -> None:
        self.history = [books]

    def displacements(self) -> np.ndarray:
        """How far each entry has moved since a round, by (round, part, entry)."""
        return np.linalg.norm((self.history[-1][None] - np.array(self.history[:-1])).astype(float), axis=3)

    def moved(self, state: DataFrame, old: np.ndarray, new: np.ndarray) -> DataFrame:
        self.history.append(new)
        parts, entries = new.shape[:2]
        groups = min(self.groups, entries)
        net = self.displacements()
        worst = np.maximum.reduceat(net, group_bounds(entries, groups)[:-1], axis=2)
        own, others = constants(net), constants(worst)
        most = F.transform("code", lambda c, p: F.get("upper", p) + F.get(own, (F.get("made", p) * parts + p) * entries + c))
        least = F.transform("lower", lambda l, at: l.cast("double") - F.get(others, F.get("stamp", at) * (parts * groups) + at))
        return state.withColumn("most", most).withColumn("least", least)


def compress(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, groups: int = 16,
             scanned: list[tuple[int, int]] | None = None) -> DataFrame:
    """Codes of all vectors that are not null and hold no null or non-finite component; other rows are dropped.

    Returns vec_id, code (two lower-case hex digits an index, in part order), error (squared
    distances summed over the parts), label_error (error summed over rows with an equal label,
    nulls together) and codebooks_sha256 (of all final components, joined by commas).
    Components become floor(1024 * x); one of 2^16 or more raises an error.  All codebooks
    start as the parts of the rows with the smallest vec_ids (ties by components, null ids
    last); with fewer rows than entries they have fewer entries.  The length is that of the
    first of these rows whose length is a positive multiple of ``parts``; vectors of other
    lengths are dropped as well.  Repeated rows count as often as they occur; no vectors
    give no rows.  Other columns are ignored.  ``scanned`` receives (parts
    read, distances computed) of each assignment.
    """
    spark = vectors.sparkSession
    ok = finite() & (F.size("v") > 0) & (F.size("v") % parts == 0)
    order = [F.col("vec_id").asc_nulls_last(), F.col("x")]
    rows = integer_vectors(vectors, ok, ["label"])
    first = rows.orderBy(*order).limit(1).collect()
    if not first:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    size = len(first[0].x)
    rows = rows.where(F.size("x") == size)
    first = rows.orderBy(*order).limit(entries).select("x").collect()
    books = np.array([r.x for r in first], np.int64).reshape(len(first), parts, size // parts).transpose(1, 0, 2)
    tables = Rounds(spark, "codes")
    state, books, seen = lloyd(rows, books, rounds, groups, NetBounds(groups), tables)
    if scanned is not None:
        scanned += seen
    named = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    code = F.concat_ws("", F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))))
    out = measured(rows, state, books, ["label"]).select("vec_id", "label", code.alias("code"), F.col("distance").alias("error"))
    tables.clear()
    sums = out.groupBy(F.col("label").alias("of")).agg(
        F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    return (out.join(sums, F.col("label").eqNullSafe(F.col("of")))
            .select("vec_id", "code", "error", "label_error", F.lit(named).alias("codebooks_sha256")))
