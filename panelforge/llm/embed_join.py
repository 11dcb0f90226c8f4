"""Similar vectors by an epsilon grid order join.

Unit vectors whose cosine reaches the threshold lie within epsilon = sqrt(2 - 2 * threshold).
The leading principal coordinates of the vectors, on axes of their own label, are cut into
cells of side epsilon and all vectors are sorted by cell; the sorted sequence is cut into
blocks.  Pairs of sequence intervals are refined recursively, from whole labels down to
blocks, and a pair whose bounding boxes lie further apart than epsilon is skipped with all it
contains; the boxes hold the norm of the remaining coordinates as one more dimension.  The
block pairs that remain are compared as matrices inside tasks, where one task takes all pairs
between two intervals of blocks, so a vector is sent once to each interval it may link with.

Equal vectors form one class with a multiplicity; a block pair hands out, per class, a
count of partners, and as few links as connect what it found, never all pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import cut, list_array, partitions
from panelforge.llm.graph import components

BLOCK = 512
#: Vectors (about) that the axes of one label are fitted on; axes steer what is skipped, never what is found.
AXES_SAMPLE = 2048
#: The largest labels with axes of their own; vectors of the others use the axes of all vectors.
AXES_LABELS = 256
#: Sequence intervals are refined by this power of two at a time; the last step's intervals are what a task compares.
FAN_BITS = 4
_SEQ_BITS = 24


def principal_axes(classes: DataFrame, leading: int) -> dict[tuple[str | None, int], np.ndarray]:
    """Leading principal axes (rows) of unit vectors by (label, length), and by (None, length) of all labels together.

    Fitted in tasks on bounded samples by hash; at most ``AXES_LABELS`` small matrices a kind reach the driver.
    """
    def fit(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        x = np.array([np.asarray(v.values.to_numpy(), float) for v in table.column("v")])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        _, vectors = np.linalg.eigh(np.cov(x.T, bias=True).reshape(x.shape[1], x.shape[1]))
        axes = np.ascontiguousarray(vectors[:, ::-1][:, :leading].T).ravel()
        return pa.table({"label": pa.array([key[0].as_py()], pa.string()), "width": pa.array([x.shape[1]], pa.int32()),
                         "axes": list_array([axes], pa.float64())})

    out = {}
    for label in (F.col("label"), F.lit(None).cast("string")):
        rows = classes.select(label.alias("label"), F.size("v").alias("width"), "sig", "v")
        largest = (rows.groupBy(F.col("label").alias("_label"), F.col("width").alias("_width")).agg(F.count(F.lit(1)).alias("_n"))
                   .orderBy(F.desc("_n"), "_label", "_width").limit(AXES_LABELS))
        drawn = F.pmod(F.xxhash64(F.lit(11), "sig"), F.lit(1 << 20)) * F.col("_n") < (AXES_SAMPLE << 20)
        sample = rows.join(F.broadcast(largest), F.col("label").eqNullSafe(F.col("_label")) & (F.col("width") == F.col("_width")))
        found = (sample.where(drawn).select("label", "width", "v").groupBy("label", "width")
                 .applyInArrow(fit, "label string, width int, axes array<double>"))
        out |= {(r.label, r.width): np.array(r.axes).reshape(-1, r.width) for r in found.collect()}
    return out


def _scaled(v: Column) -> Column:
    """The vector times the power of two that brings its largest component near 1: exact, and no norm over- or underflows."""
    largest = F.array_max(F.transform(v, lambda x: F.abs(x)))
    up = -F.floor(F.log2(largest))
    half = F.floor(up / 2)
    one, two = F.pow(F.lit(2.0), half), F.pow(F.lit(2.0), up - half)
    return F.transform(v, lambda x: x * one * two)


def similar_vectors(vectors: DataFrame, threshold: float = 0.93, leading: int = 8) -> DataFrame:
    """Links of all vectors with equal labels and a cosine of at least ``threshold``, one row per input row.

    Returns vec_id, n_links (other rows linked directly), component_id (smallest vec_id
    reachable, itself included) and kept (vec_id = component_id).  Vectors that are null,
    empty, zero, or hold a null or non-finite component, and vectors with a null label or
    vec_id, link with nothing; vectors of different lengths are never linked.  Equal rows
    are linked with each other.  Other columns are ignored.
    """
    v = F.col("embedding").cast("array<double>")
    usable = (F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.col("v").isNotNull()
              & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
              & F.exists("v", lambda x: x != 0))
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                           v.alias("v")).withColumn("ok", F.coalesce(usable, F.lit(False))))
    rows = rows.withColumn("v", F.when(F.col("ok"), _scaled(F.col("v"))))
    rows = rows.withColumn("sig", F.xxhash64("label", F.size("v"), "v"))
    rows = cut(rows)
    classes = cut(rows.where("ok").groupBy("sig").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("mult"), F.first("label").alias("label"),
        F.first("v").alias("v")))
    epsilon = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9
    sequence = _grid_order(classes, principal_axes(classes, leading), leading, epsilon)
    pairs = _block_pairs(sequence, epsilon)
    found = cut(_compared(sequence, pairs, threshold))
    partners = found.where("b is null").groupBy(F.col("a").alias("sig")).agg(F.sum("n").alias("partners"))
    group = components(found.where("b is not null").select("a", "b"))
    named = classes.select("sig", "rep").join(group.withColumnRenamed("node", "sig"), "sig")
    least = cut(named.groupBy("component").agg(F.min("rep").alias("least")))
    least = named.join(least, "component").select("sig", "least")
    info = cut(classes.select("sig", "rep", "mult").join(partners, "sig", "left").join(least, "sig", "left")
               .select("sig", (F.col("mult") - 1 + F.coalesce("partners", F.lit(0))).alias("n_links"),
                       F.coalesce("least", "rep").alias("component_id")))
    placed = rows.where("ok").select("vec_id", "sig").join(info, "sig").select("vec_id", "n_links", "component_id")
    alone = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                        F.col("vec_id").alias("component_id"))
    return placed.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _grid_order(classes: DataFrame, axes: dict[tuple[str | None, int], np.ndarray], leading: int, epsilon: float) -> DataFrame:
    """Classes with leading coordinates and residual norm p, and the block of the grid order they fall into, from 0 without gaps."""
    none = np.zeros((0, 0))

    def project(batches):
        for batch in batches:
            coordinates, cells = [], []
            for label, own in zip(batch.column("label").to_pylist(), batch.column("v"), strict=True):
                x = np.asarray(own.values.to_numpy(), float)
                x = x / np.linalg.norm(x)
                p = np.zeros(leading + 1)
                lead = axes.get((label, len(x)), axes.get((None, len(x)), none))
                if len(lead):
                    p[: len(lead)] = lead @ x
                    x = x - p[: len(lead)] @ lead
                p[leading] = np.linalg.norm(x)
                coordinates.append(p)
                cells.append(np.floor(p[:leading] / epsilon))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, list_array(coordinates, pa.float64()),
                 list_array([c.astype(np.int32) for c in cells], pa.int32())], [*batch.schema.names, "p", "cell"])

    kinds = "sig long, rep long, mult long, label string, v array<double>"
    placed = classes.select("sig", "rep", "mult", "label", "v").mapInArrow(
        project, f"{kinds}, p array<double>, cell array<int>")
    order = ["label", "width", "cell", "sig"]
    placed = placed.withColumn("width", F.size("v"))
    n = partitions(classes.sparkSession)
    placed = placed.repartitionByRange(n, *order).sortWithinPartitions(*order)

    def block(batches):
        from pyspark import TaskContext
        base = TaskContext.get().partitionId() << _SEQ_BITS
        number, filled, last = -1, 0, None
        for batch in batches:
            out = []
            for own in zip(batch.column("label").to_pylist(), batch.column("width").to_pylist(), strict=True):
                if own != last or filled == BLOCK:
                    number, filled, last = number + 1, 0, own
                filled += 1
                out.append(base + number)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())],
                                             [*batch.schema.names, "block"])

    placed = cut(placed.mapInArrow(block, f"{kinds}, p array<double>, cell array<int>, width int, block long").drop("cell"))
    # one row a range, so at most the number of partitions
    ranges = placed.groupBy(F.shiftright("block", _SEQ_BITS).alias("_range")).agg(
        ((F.max("block") % (1 << _SEQ_BITS)) + 1).alias("_blocks"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = cut(ranges.select("_range", F.coalesce(F.sum("_blocks").over(before), F.lit(0)).alias("_before")))
    return (placed.join(F.broadcast(ranges), F.shiftright("block", _SEQ_BITS) == F.col("_range"))
            .withColumn("block", F.col("_before") + F.col("block") % (1 << _SEQ_BITS)).drop("_range", "_before"))


def _block_pairs(sequence: DataFrame, epsilon: float) -> DataFrame:
    """Pairs of blocks (i <= j) that may hold vectors within epsilon, by recursive refinement of intervals."""
    some = sequence.select("p").first()
    leading = len(some[0]) if some else 1
    box = [F.min(F.get("p", F.lit(d))).alias(f"lo{d}") for d in range(leading)]
    box += [F.max(F.get("p", F.lit(d))).alias(f"hi{d}") for d in range(leading)]
    blocks = cut(sequence.groupBy("label", "width", "block").agg(*box))
    widen = [F.min(f"lo{d}").alias(f"lo{d}") for d in range(leading)]
    widen += [F.max(f"hi{d}").alias(f"hi{d}") for d in range(leading)]
    top = blocks.agg(F.max("block")).first()[0] or 0
    bits = FAN_BITS * math.ceil(max(1, int(top).bit_length()) / FAN_BITS)
    pairs = None
    for shift in range(bits, -1, -FAN_BITS):
        level = (blocks.groupBy("label", "width", F.shiftright("block", shift).alias("i")).agg(*widen)
                 .withColumn("up", F.shiftright("i", FAN_BITS)))
        other = level.select("label", "width", *[F.col(c).alias(c + "_") for c in level.columns[2:]])
        if pairs is None:
            both = level.join(other, ["label", "width"])
        else:
            above = pairs.select("label", "width", F.col("i").alias("up"), F.col("j").alias("up_"))
            both = above.join(level, ["label", "width", "up"]).join(other, ["label", "width", "up_"])
        gap = F.lit(0.0)
        for d in range(leading):
            apart = F.greatest(F.lit(0.0), F.col(f"lo{d}") - F.col(f"hi{d}_"), F.col(f"lo{d}_") - F.col(f"hi{d}"))
            gap = gap + apart * apart
        pairs = cut(both.where((F.col("i") <= F.col("i_")) & (gap <= epsilon * epsilon + 1e-9))
                    .select("label", "width", "i", F.col("i_").alias("j")))
    return pairs.select("i", "j")


def _compared(sequence: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """(a, b, n): with b null, a has n partner rows in two intervals of blocks; else a link that connects what was found."""
    fan = 1 << FAN_BITS
    tile = [F.shiftright("i", FAN_BITS).alias("ti"), F.shiftright("j", FAN_BITS).alias("tj")]
    partner = F.lit(2).cast("double") ** (F.col("j") % fan)
    needed = (pairs.select(*tile, F.col("i").alias("block"), partner.cast("int").alias("m"))
              .union(pairs.select(*tile, F.col("j").alias("block"), F.lit(0).alias("m")))
              .groupBy("ti", "tj", "block").agg(F.bit_or("m").alias("partners")))
    rows = sequence.select("block", "sig", "mult", "v").join(needed, "block")

    def compare(table: pa.Table) -> pa.Table:
        table = table.take(pa.array(np.argsort(table.column("block").to_numpy(), kind="stable"))).combine_chunks()
        block, sig, mult, partners = (table.column(c).to_numpy() for c in ("block", "sig", "mult", "partners"))
        vectors = table.column("v").combine_chunks()
        offsets, flat = vectors.offsets.to_numpy(), vectors.values.to_numpy()
        names, starts = np.unique(block, return_index=True)
        ends = dict(zip(names.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(block)], strict=True), strict=True))
        base = int(table.column("tj")[0].as_py()) * fan
        counts, one, two = np.zeros(len(block), np.int64), [], []

        def with_norms(at: int, to: int) -> tuple[np.ndarray, np.ndarray]:
            x = flat[offsets[at]: offsets[to]].reshape(to - at, -1)
            return x, np.sqrt(np.einsum("ij,ij->i", x, x))

        for i in names.tolist():
            at, to = ends[i]
            x, nx = with_norms(at, to)
            for j in (base + k for k in range(fan) if int(partners[at]) >> k & 1):
                first, last = ends[j]
                y, ny = with_norms(first, last)
                linked = (x @ y.T) / np.outer(nx, ny) >= threshold
                if i == j:
                    np.fill_diagonal(linked, False)
                else:
                    counts[first:last] += linked.T @ mult[at:to]
                counts[at:to] += linked @ mult[first:last]
                rows, cols = spanning(linked)
                one.append(sig[at + rows])
                two.append(sig[first + cols])
        some = counts > 0
        one, two = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (one, two))
        return pa.table({"a": pa.array(np.concatenate([sig[some], one]), pa.int64()),
                         "b": pa.array([None] * int(some.sum()) + two.tolist(), pa.int64()),
                         "n": pa.array(np.concatenate([counts[some], np.zeros(len(one), np.int64)]), pa.int64())})

    return rows.groupBy("ti", "tj").applyInArrow(compare, "a long, b long, n long")


def spanning(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (rows, columns) that connect whatever the link matrix connects: a forest grown from the smallest row."""
    one, two = [], []
    row_open, col_open = linked.any(axis=1), linked.any(axis=0)
    while row_open.any():
        new_rows = np.array([int(np.flatnonzero(row_open)[0])])
        row_open[new_rows] = False
        while len(new_rows):
            reach = linked[new_rows] & col_open
            new_cols = np.flatnonzero(reach.any(axis=0))
            one += new_rows[reach[:, new_cols].argmax(axis=0)].tolist()
            two += new_cols.tolist()
            col_open[new_cols] = False
            reach = linked[:, new_cols] & row_open[:, None]
            new_rows = np.flatnonzero(reach.any(axis=1))
            one += new_rows.tolist()
            two += new_cols[reach[new_rows].argmax(axis=1)].tolist() if len(new_rows) else []
            row_open[new_rows] = False
    return np.array(one, np.int64), np.array(two, np.int64)
