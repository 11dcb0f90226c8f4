"""Shared helpers of the corpus operators: reading, lineage cuts, word hashing and distributed numbering.

The hashing helpers work on Arrow string buffers inside tasks, in segments of a
bounded number of bytes, so a task's memory does not follow the length of a text.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelforge.session import checkpoint_dir, scratch_path

SEGMENT_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the input folder, through Spark's reader only."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the folder the cluster names; it survives executor loss."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_table(df: DataFrame, name: str) -> str:
    """Write rows under a fresh name to the shared folder; their path."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return path


def read_back(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


class Rounds:
    """Tables of an iterative job in the shared folder; a table is deleted by name when the next but one is written.

    A written table carries no plan, so plans do not grow with the rounds, and columns that
    a later step does not read stay on disk.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.paths = spark, scratch_path(spark, f"{name}-{uuid.uuid4().hex}"), []

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{len(self.paths)}"
        df.write.parquet(path)
        self.paths.append(path)
        if len(self.paths) > 2:
            self._delete(self.paths[-3])
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Delete all tables."""
        self._delete(self.folder)

    def _delete(self, path: str) -> None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; remainder 2 is held out of all learning."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def share(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast a value of bounded size, classes by value; the function returned reads it inside a task."""
    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(held.value)


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files and checkpoints that nothing refers to any more.

    Its cleaner learns of them by the driver's garbage collection, which a driver with little
    work of its own may not do for the whole run while the executors' disks fill up.
    """
    import gc
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def hand_back() -> None:
    """Give memory that the driver's Python has freed back to the system; fitted models are small, what made them is not."""
    import ctypes
    import gc
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable) -> Callable:
    """A task function for mapInArrow whose worker hands its memory back when the task ends; workers stay for later stages."""
    def own(batches):
        try:
            yield from run(batches)
        finally:
            hand_back()
    return own


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def gapless(df: DataFrame, group: list[str], order: list[str], out: str, buckets: int = 64) -> DataFrame:
    """Number the rows of each group from 0 without gaps, whatever the group's size.

    Rows are dealt to ``buckets`` by a hash of the ordering columns, numbered inside
    (group, bucket) and shifted by the counts of the buckets before; no task sees a
    whole group.  Ties of the ordering columns get arbitrary but distinct numbers.
    """
    df = df.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    keys = [*group, "_b"]
    before = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    shift = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
             .select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift")))
    own = df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
    return (own.join(shift, keys).withColumn(out, (F.col("_r") + F.col("_shift")).cast("long"))
            .drop("_b", "_r", "_shift"))


# ---------------------------------------------------------------- hashing inside tasks

def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """64-bit hashes of the whitespace-separated words of UTF-8 texts.

    A word's hash is a polynomial over its bytes, read off prefix sums (exact modulo
    2^64) and then mixed.  A-Z are lower-cased; separators are space and 0x09-0x0D.
    """

    def __init__(self, segment_bytes: int = SEGMENT_BYTES):
        self.size = segment_bytes
        n = segment_bytes + 1
        self.pow = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(_BASE))]), dtype=np.uint64)
        inverse = np.uint64(pow(_BASE, -1, 1 << 64))
        self.inv = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, inverse)]), dtype=np.uint64)
        table = np.arange(1, 257, dtype=np.uint64)
        table[65:91] = table[97:123]
        self.value = table
        space = np.zeros(256, bool)
        space[[32, 9, 10, 11, 12, 13]] = True
        self.space = space

    def segment(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and start offsets of the words of ``data``; no word runs across an offset in ``cuts``."""
        if not len(data):
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        if len(data) >= len(self.pow):
            grown = WordHasher(len(data))
            self.pow, self.inv = grown.pow, grown.inv
        text = ~self.space[data]
        begin = text.copy()
        begin[1:] &= ~text[:-1]
        inner = cuts[(cuts > 0) & (cuts < len(data))]
        begin[inner] = text[inner]
        starts = np.flatnonzero(begin)
        stop = text.copy()
        stop[:-1] &= ~text[1:]
        stop[inner - 1] = text[inner - 1]
        ends = np.flatnonzero(stop) + 1
        sums = np.empty(len(data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(self.value[data] * self.pow[: len(data)], out=sums[1:])
        return mix64((sums[ends] - sums[starts]) * self.inv[starts] + np.uint64(0x632BE59BD9B4E019)), starts

    def rows(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """(row, word hashes) of every row; null and blank texts give an empty array."""
        for first, offsets, data in segments(column, self.size):
            n = len(offsets) - 1
            if n == 1 and len(data) > self.size:
                yield first, self._long(data)
                continue
            hashes, starts = self.segment(data, offsets)
            bounds = np.searchsorted(starts, offsets)
            for i in range(n):
                yield first + i, hashes[bounds[i]: bounds[i + 1]]

    def _long(self, data: np.ndarray) -> np.ndarray:
        parts, at, none = [], 0, np.empty(0, np.int64)
        while at < len(data):
            end = min(len(data), at + self.size)
            if end < len(data):
                gaps = np.flatnonzero(self.space[data[at:end]])
                if len(gaps):
                    end = at + int(gaps[-1]) + 1
                else:  # one word longer than a segment: up to its end
                    gaps = np.flatnonzero(self.space[data[end:]])
                    end = end + int(gaps[0]) + 1 if len(gaps) else len(data)
            parts.append(self.segment(data[at:end], none)[0])
            at = end
        return np.concatenate(parts)


def segments(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, row offsets from 0, bytes) over runs of whole rows of about ``size`` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    n = len(column)
    if not n:
        return
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int32, n + 1, column.offset * 4).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    row = 0
    while row < n:
        last = max(row + 1, int(np.searchsorted(offs, offs[row] + size, "right")) - 1)
        last = min(last, n)
        yield row, offs[row: last + 1] - offs[row], data[offs[row]: offs[last]]
        row = last


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct 63-bit hashes of the ``width``-word shingles; fewer words count as one whole sequence."""
    n = len(words)
    if not n:
        return np.empty(0, np.int64)
    take = min(width, n)
    total = np.zeros(n - take + 1, np.uint64)
    for j in range(take):
        factor = np.uint64((_BASE * (2 * j + 3)) & _MASK | 1)
        total += mix64(words[j: n - take + 1 + j] * factor + np.uint64(j + 1))
    if take < width:
        total += np.uint64(take)
    return np.unique((mix64(total) >> np.uint64(1)).astype(np.int64))


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """Arrow list column from numpy arrays."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch of a partition."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)
    return df.mapInArrow(run, schema)


# ---------------------------------------------------------------- semi-join reduction

BITMAP_BITS = 1 << 24
_BUCKET_BITS = 1 << 15


def id_bitmap(ids: DataFrame, column: str) -> DataFrame:
    """Bitmap of fixed size (BITMAP_BITS / 8 bytes) over the hashes of an id column, as rows (_bucket, _bits)."""
    at = F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(BITMAP_BITS))
    return (ids.where(F.col(column).isNotNull())
            .select(F.floor(at / _BUCKET_BITS).cast("int").alias("_bucket"), (at % _BUCKET_BITS).alias("_at"))
            .groupBy("_bucket").agg(F.bitmap_construct_agg("_at").alias("_bits")))


def possible(rows: DataFrame, column: str, bitmap: DataFrame, out: str = "_possible") -> DataFrame:
    """Add a boolean that is true for every row whose id is in the bitmap and false for most others; null ids: false.

    The bitmap is broadcast; its size is fixed, so texts of rows without a partner need no shuffle.
    """
    at = F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(BITMAP_BITS))
    bit = at % _BUCKET_BITS
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_byte as int), 1)")), 16, 10).cast("int")
    marked = (rows.withColumn("_bucket", F.floor(at / _BUCKET_BITS).cast("int"))
              .withColumn("_byte", F.floor(bit / 8) + 1).withColumn("_bit", (bit % 8).cast("int"))
              .join(F.broadcast(bitmap), "_bucket", "left"))
    hit = F.col(column).isNotNull() & F.col("_bits").isNotNull() & (F.getbit(byte, F.col("_bit")) == 1)
    return marked.withColumn(out, F.coalesce(hit, F.lit(False))).drop("_bucket", "_byte", "_bit", "_bits")


def drop_ids(docs: DataFrame, gone: DataFrame, doubled: DataFrame | None = None) -> DataFrame:
    """Rows of ``docs`` whose doc_id is not in gone(doc_id), with all their columns.

    Rows with an id in doubled(doc_id) that agree in doc_id and text are kept once.  Only
    rows that the bitmap of these ids lets through are shuffled.
    """
    gone = gone.select(F.col("doc_id").cast("long").alias("_gone")).distinct()
    wanted = gone if doubled is None else gone.union(doubled.select(F.col("doc_id").cast("long")))
    marked = possible(docs, "doc_id", cut(id_bitmap(wanted, "_gone")))
    sure = marked.where("not _possible").drop("_possible")
    rest = marked.where("_possible").drop("_possible")
    rest = rest.join(gone, F.col("doc_id").cast("long") == F.col("_gone"), "left_anti")
    if doubled is not None:
        rest = rest.dropDuplicates(["doc_id", "text"])
    return sure.unionByName(rest)
