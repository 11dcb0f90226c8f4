"""Exact Lloyd rounds over integer vectors, where bounds settle most distances without computing them.

A vector is cut into P equal parts, each with a codebook of K integer entries (plain
clustering is P = 1).  A round gives every part to the nearest entry of its codebook
(squared Euclidean distance, ties to the lower index) and then replaces every entry in use
by the floor of its parts' mean.  Entries are cut into G groups.  Beside the vectors, written
once and dealt by row number, a state row is kept per vector: its codes, an upper bound of
the distance to each own entry and, per part and group, a lower bound of the distance to
all other entries of the group, each with the round it was made in.  A round first judges
these bounds by what the entries have moved; only vectors with a group that the bounds leave
open are joined with their components.  There the own distance is computed first, then the
groups that stay open are scanned, and only parts that change their entry move sums.  All sums and
distances are exact integers.
"""

from __future__ import annotations

from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import Rounds, cut, list_array, partitions

#: Components of this size or more have squared distances beyond a long; they raise an error.
LARGEST = 1 << 16
SCALE = 1024
#: Rounding of bounds in double precision stays far below this distance.
SLACK = 1e-5
_FAR = 1e300
_CHUNK = 2048
_STATE = "row long, code array<int>, upper array<double>, made array<int>, lower array<float>, stamp array<int>"
_SUMS = "part int, entry int, delta array<long>"


def integer_vectors(vectors: DataFrame, usable: Column, keep: list[str]) -> DataFrame:
    """Written rows (row, vec_id, *keep, x): x holds floor(1024 * component); only where ``usable`` holds for the array v.

    ``row`` is a number of its own for every row, so repeated vec_ids are rows of their own.
    """
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), *keep,
                           F.col("embedding").cast("array<double>").alias("v"))
            .where(F.coalesce(usable, F.lit(False))))
    fits = F.forall("v", lambda a: F.abs(a) < LARGEST)
    x = F.when(fits, F.transform("v", lambda a: F.floor(a * SCALE).cast("int"))).otherwise(
        F.raise_error(F.lit(f"a component is {LARGEST} or more: its squared distances do not fit a long")))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", *keep, x.alias("x"))
    conf, key = vectors.sparkSession.conf, "spark.sql.adaptive.enabled"
    adaptive = conf.get(key)
    conf.set(key, "false")  # a plan fixed beforehand tells the rounds' joins how its rows are dealt and sorted
    try:
        return cut(rows.repartition(partitions(vectors.sparkSession), "row").sortWithinPartitions("row"))
    finally:
        conf.set(key, adaptive)


def finite(size: int | None = None) -> Column:
    """Whether the array v holds neither null nor non-finite components (and has ``size`` of them)."""
    ok = F.col("v").isNotNull() & F.forall("v", lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < float("inf")))
    return ok if size is None else ok & (F.size("v") == size)


def squared_distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows, as int64: products in doubles where all sums stay below 2^53."""
    reach = int(np.abs(x).max(initial=0)) + int(np.abs(entries).max(initial=0))
    if x.shape[1] * reach * reach < 1 << 53:
        a, b = x.astype(float), entries.astype(float)
        d = np.einsum("ij,ij->i", a, a)[:, None] - 2 * (a @ b.T) + np.einsum("ij,ij->i", b, b)[None, :]
        return d.astype(np.int64)
    return np.stack([((x - e) ** 2).sum(axis=1) for e in entries], axis=1)


class Bounds(Protocol):
    """How bounds survive a move of the entries."""

    def start(self, books: np.ndarray) -> None: ...

    def moved(self, state: DataFrame, old: np.ndarray, new: np.ndarray) -> DataFrame:
        """The state and, for the ``new`` books, arrays ``most`` (by part, an upper bound) and ``least`` (by part and group)."""


def constants(values: np.ndarray) -> Column:
    """A literal array of doubles."""
    return F.expr("array(" + ",".join(f"{min(float(v), _FAR)!r}D" for v in np.ravel(values)) + ")")


def group_bounds(entries: int, groups: int) -> list[int]:
    """First entry of each group, and the number of entries."""
    return [entries * g // groups for g in range(groups + 1)]


def lloyd(vectors: DataFrame, books: np.ndarray, rounds: int, groups: int, bounds: Bounds,
          tables: Rounds) -> tuple[DataFrame, np.ndarray, list[tuple[int, int]]]:
    """State rows after the last assignment, the final books and (parts read, distances computed) of each assignment.

    ``books`` has the shape (parts, entries, components of a part).  The driver holds the
    books and their sums only.  If no entry moves, the rounds left would change nothing.
    """
    parts, entries, _ = books.shape
    groups = min(groups, entries)
    bounds.start(books)
    state, work = None, []
    counts = np.zeros(books.shape[:2], np.int64)
    totals = np.zeros(books.shape, np.int64)
    for turn in range(rounds + 1):
        if state is None:
            table = _scan(_unknown(vectors, parts, groups), books, groups, turn)
        else:
            judged = F.exists(F.transform("least", lambda l, at: ~(F.get("most", (at / groups).cast("int")) + SLACK < l)),
                              lambda o: o)
            state = state.withColumn("open", judged)
            read = vectors.select("row", "x").join(state.where("open").drop("open"), "row")
            kept = state.where("not open").drop("open", "most", "least")
            table = kept.unionByName(_scan(read, books, groups, turn), allowMissingColumns=True)
        table = tables.write(table)
        state = table.where("row is not null").select("row", "code", "upper", "made", "lower", "stamp")
        moved = (table.where("row is null").groupBy("part", "entry")
                 .agg(*[F.sum(F.get("delta", F.lit(d))).alias(f"d{d}") for d in range(books.shape[2] + 1)]).collect())
        work.append((0, 0))
        for part, entry, *delta in moved:
            if entry < 0:
                work[-1] = tuple(delta[:2])
            else:
                counts[part, entry] += delta[0]
                totals[part, entry] += np.array(delta[1:], np.int64)
        if turn == rounds:
            break
        new = np.where(counts[:, :, None] > 0, totals // np.maximum(counts, 1)[:, :, None], books)
        if (new == books).all():
            break
        state = bounds.moved(state, books, new)
        books = new
    return state, books, work


def _unknown(vectors: DataFrame, parts: int, groups: int) -> DataFrame:
    """All vectors as if of entry 0, with bounds that settle nothing."""
    def filled(value, kind: str, n: int) -> Column:
        return F.array_repeat(F.lit(value).cast(kind), n)
    return vectors.select("row", "x", filled(-1, "int", parts).alias("code"), filled(0, "double", parts).alias("upper"),
                          filled(0, "int", parts).alias("made"), filled(0, "float", parts * groups).alias("lower"),
                          filled(0, "int", parts * groups).alias("stamp"), filled(0, "double", parts).alias("most"),
                          filled(-1, "double", parts * groups).alias("least"))


def _below(x: np.ndarray) -> np.ndarray:
    """The same bounds in single precision, never rounded up."""
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def _scan(work: DataFrame, books: np.ndarray, groups: int, turn: int) -> DataFrame:
    """New state rows of (row, x, code, ..., least), then a task's changes by part and entry: count and sums.

    The row of entry -1 holds the number of parts read and of distances computed.
    """
    parts, entries, size = books.shape
    starts = group_bounds(entries, groups)
    group_of = np.repeat(np.arange(groups), np.diff(starts))
    schema = pa.schema([("row", pa.int64()), ("code", pa.list_(pa.int32())), ("upper", pa.list_(pa.float64())),
                        ("made", pa.list_(pa.int32())), ("lower", pa.list_(pa.float32())), ("stamp", pa.list_(pa.int32())),
                        ("part", pa.int32()), ("entry", pa.int32()), ("delta", pa.list_(pa.int64()))])

    def matrix(column: pa.Array, n: int) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1).copy()

    def part_scan(x, book, code, lower, stamp, least):
        """(code, exact distance, lower, stamp, distances computed) of one part of some rows."""
        n, rows = len(x), np.arange(len(x))
        known = code >= 0
        best = np.where(known, code, 0)
        own = ((x - book[best]) ** 2).sum(axis=1)
        need = ~(np.sqrt(own)[:, None] + SLACK < least)
        computed = n
        near, found = own.copy(), best.copy()
        first, second = {}, {}
        for g in range(groups):
            pick = np.flatnonzero(need[:, g])
            if not len(pick):
                continue
            d = squared_distances(x[pick], book[starts[g]: starts[g + 1]])
            computed += d.size
            at = d.argmin(axis=1)
            low = d[np.arange(len(pick)), at]
            d[np.arange(len(pick)), at] = np.iinfo(np.int64).max
            first[g], second[g] = (pick, at + starts[g], low), d.min(axis=1) if d.shape[1] > 1 else None
            better = (low < near[pick]) | ((low == near[pick]) & (at + starts[g] < found[pick]))
            near[pick[better]], found[pick[better]] = low[better], at[better] + starts[g]
        # a group that was not scanned gets back the entry that its rows have left
        left = np.flatnonzero((found != best) & ~need[rows, group_of[best]])
        g = group_of[best[left]]
        lower[left, g] = _below(np.minimum(least[left, g], np.sqrt(own[left])))
        stamp[left, g] = turn
        for g, (pick, entry, low) in first.items():
            other = np.sqrt(second[g]) if second[g] is not None else np.full(len(pick), _FAR)
            lower[pick, g] = _below(np.minimum(np.where(entry == found[pick], other, np.sqrt(low)), 3e38))
            stamp[pick, g] = turn
        return found, near, computed

    def scan(batches):
        sums = np.zeros((parts, entries, size + 1), np.int64)
        seen = np.zeros(2, np.int64)
        for whole in batches:
            for start in range(0, whole.num_rows, _CHUNK):
                batch = whole.slice(start, _CHUNK)
                n = batch.num_rows
                x = matrix(batch.column("x"), n).astype(np.int64)
                code, upper, made, lower, stamp, least = (
                    matrix(batch.column(c), n) for c in ("code", "upper", "made", "lower", "stamp", "least"))
                most = matrix(batch.column("most"), n)
                for p in range(parts):
                    mine = slice(p * groups, (p + 1) * groups)
                    pick = np.flatnonzero((~(most[:, p: p + 1] + SLACK < least[:, mine])).any(axis=1))
                    if not len(pick):
                        continue
                    own, before = x[pick, p * size: (p + 1) * size], code[pick, p]
                    low, mark = lower[pick, mine], stamp[pick, mine]
                    best, near, computed = part_scan(own, books[p], before, low, mark, least[pick, mine])
                    lower[pick, mine], stamp[pick, mine] = low, mark
                    code[pick, p], upper[pick, p], made[pick, p] = best, np.sqrt(near), turn
                    seen += (len(pick), computed)
                    changed = best != before
                    _add(sums[p], best[changed], own[changed], 1)
                    gone = changed & (before >= 0)
                    _add(sums[p], before[gone], own[gone], -1)
                none = pa.nulls(n, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), list_array(list(code), pa.int32()), list_array(list(upper), pa.float64()),
                     list_array(list(made), pa.int32()), list_array(list(lower), pa.float32()),
                     list_array(list(stamp), pa.int32()), none, none, pa.nulls(n, schema.field(8).type)], schema=schema)
        p, e = np.nonzero(sums.any(axis=2))
        delta = [*sums[p, e], np.append(seen, np.zeros(size - 1, np.int64))]
        n = len(delta)
        yield pa.RecordBatch.from_arrays(
            [*[pa.nulls(n, schema.field(k).type) for k in range(6)], pa.array(np.append(p, 0), pa.int32()),
             pa.array(np.append(e, -1), pa.int32()), list_array(delta, pa.int64())], schema=schema)

    return work.mapInArrow(scan, f"{_STATE}, {_SUMS}")


def _add(sums: np.ndarray, entry: np.ndarray, x: np.ndarray, sign: int) -> None:
    """Add count and components of the rows of x to the sums of their entries."""
    if not len(entry):
        return
    order = np.argsort(entry, kind="stable")
    entry = entry[order]
    starts = np.flatnonzero(np.concatenate([[True], entry[1:] != entry[:-1]]))
    sums[entry[starts], 1:] += sign * np.add.reduceat(x[order], starts, axis=0)
    sums[entry[starts], 0] += sign * np.diff(np.concatenate([starts, [len(entry)]]))


def measured(vectors: DataFrame, state: DataFrame, books: np.ndarray, keep: list[str]) -> DataFrame:
    """(vec_id, *keep, code, distance): the codes and the exact squared distance summed over the parts."""
    parts, _, size = books.shape
    rows = vectors.select("row", "vec_id", *keep, "x").join(state.select("row", "code"), "row")
    kinds = dict(rows.dtypes)

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(np.int64)
            code = batch.column("code").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            total = np.zeros(n, np.int64)
            for p in range(parts):
                total += ((x[:, p * size: (p + 1) * size] - books[p][code[:, p]]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("vec_id", *keep, "code")], pa.array(total, pa.int64())],
                ["vec_id", *keep, "code", "distance"])

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in ("vec_id", *keep, "code"))
    return cut(rows.mapInArrow(run, f"{schema}, distance long"))
