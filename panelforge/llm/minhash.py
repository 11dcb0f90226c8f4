"""Near-duplicate texts by bottom-k sketches of word shingles.

One hash function orders all shingles; a text's sketch is its k smallest shingle
hashes.  Inverted lists of the retained values generate overlaps, the sketch of the
union estimates the resemblance and filters, and whole shingle sets verify.

Large groups are never expanded into all pairs:

* texts with equal shingle sets form one class, and only classes are compared;
* a text enters only the lists of its rarest retained values: two sketches of s
  values that must share c of them share one of the s - c + 1 rarest, so passages that
  many documents hold are not looked at unless most of a sketch consists of them;
* every list is first compared with one leader; classes that verified links have
  joined are then compared no further, and only lists that still hold several
  components are compared across components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from panelforge.llm.common import WordHasher, cut, drop_ids, id_bitmap, list_array, possible, release, shingle_hashes, tidy
from panelforge.llm.graph import components

SKETCH = 96
#: Standard deviations that an overlap may lie below its mean before a pair is given up; the overlap of two sketches
#: is hypergeometric, so a pair at the threshold is given up with a probability of about 1e-6.
MARGIN = 5.0
#: Classes per block when members of one list are compared across components.
BLOCK = 256


def sketches(docs: DataFrame, width: int, k: int = SKETCH) -> DataFrame:
    """(doc_id, n_shingles, sig, sketch): sig is a 63-bit signature of the whole set, sketch its k smallest hashes."""
    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            count, sig, low = [], [], []
            for _, words in hasher.rows(batch.column("text")):
                own = shingle_hashes(words, width)
                count.append(len(own))
                sig.append(_signature(own))
                low.append(own[:k])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(count, pa.int64()), pa.array(sig, pa.int64()),
                 list_array(low, pa.int64())], ["doc_id", "n_shingles", "sig", "sketch"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(tidy(run), "doc_id long, n_shingles long, sig long, sketch array<long>")


def _signature(own: np.ndarray) -> int:
    x = own.view(np.uint64)
    with np.errstate(over="ignore"):
        y = x * np.uint64(0xD6E8FEB86659FD93)
        y = (y ^ (y >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)
        total = int(np.sum(y ^ (y >> np.uint64(29)), dtype=np.uint64))
    return (total ^ (len(own) * 0x9E3779B97F4A7C15)) & 0x7FFFFFFFFFFFFFFF


def near_duplicates(docs: DataFrame, width: int = 5, threshold: float = 0.8, k: int = SKETCH) -> DataFrame:
    """Components of texts whose shingle sets resemble each other: one row per input row.

    Returns doc_id, n_shingles (size of the set of distinct ``width``-word shingles;
    texts with fewer words count as one shingle), component_id (smallest doc_id
    reachable over links of Jaccard resemblance >= ``threshold``) and kept
    (doc_id = component_id).  Null, empty and blank texts have no shingles and stand
    alone.  Rows with a null doc_id stand alone with a null component.  Repeated
    doc_ids are independent rows.  Other columns are ignored.
    """
    return _placed(docs, width, threshold, k).drop("sig")


def _placed(docs: DataFrame, width: int, threshold: float, k: int = SKETCH) -> DataFrame:
    """The rows of ``near_duplicates`` with the signature of their class."""
    percent = round(threshold * 100)
    some = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    # sketches are written once a class; the rows of all documents are made without them
    classes = cut(sketches(docs, width, k).where(some).groupBy("sig").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")))
    base = cut(sketches(docs, width, 0).drop("sketch"))
    full = base.where(some)
    lists = cut(_lists(classes, percent, k))
    release(docs.sparkSession)
    sets = cut(_whole_sets(lists, docs, width))
    leaders = cut(lists.groupBy("v", "band").agg(F.min(F.struct("rep", "sig", "n")).alias("m"),
                                                 F.count(F.lit(1)).alias("size")).where("size > 1")
                  .select("v", "band", F.col("m.sig").alias("leader"), F.col("m.n").alias("leader_n")))
    grouped = cut(lists.join(leaders, ["v", "band"]).select("leader", "leader_n", "sig", "n").distinct())
    low = possible(classes.select("sig", "sketch"), "sig", cut(id_bitmap(grouped, "sig"))).where("_possible")
    first = cut(components(_star_links(grouped, low.drop("_possible"), sets, percent, k)))
    release(docs.sparkSession)
    across = _across(grouped, first, sets, percent)
    group = components(across.union(first.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    named = classes.select("sig", "rep").join(group.withColumnRenamed("node", "sig"), "sig")
    least = cut(named.groupBy("component").agg(F.min("rep").alias("least")))
    heads = named.select("sig", "component").join(least, "component").select("sig", "least")
    heads = cut(classes.select("sig", "rep").join(heads, "sig", "left")
                .select("sig", F.coalesce("least", "rep").alias("component_id")))
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    placed = (full.select("doc_id", "n_shingles", "sig").join(heads, "sig")
              .select("doc_id", "n_shingles", "component_id", "sig"))
    out = placed.union(base.where(alone).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "sig"))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"), "sig")


def _needed(n: Column, percent: int, k: int) -> Column:
    """Retained values that a linked text's sketch has in common at least."""
    drawn = F.ceil(_least_overlap(n * 100 / percent, percent, k))
    return F.greatest(F.lit(1), F.when(n * 100 <= k * percent, F.ceil(n * percent / 100))
                      .otherwise(F.least(F.ceil(n * percent / 100), drawn)))


def _least_overlap(union: Column, percent: int, k: int) -> Column:
    """Members of both texts among the k smallest of a union of that size, at the threshold, less the margin."""
    p = percent / 100
    left = F.greatest(F.lit(0.0), (union - k) / F.greatest(union - 1, F.lit(1.0)))
    return F.lit(p * k) - MARGIN * F.sqrt(k * p * (1 - p) * left) - 1e-6


def _lists(classes: DataFrame, percent: int, k: int) -> DataFrame:
    """Inverted lists (v, band, sig, n, rep) of each class's rarest shared values, split by size bands.

    Sizes of linked texts differ by a factor of percent/100 at most, so they lie in one
    band or in neighbouring ones; a class enters its own band and the next.
    """
    values = classes.select("sig", F.explode("sketch").alias("v"))
    shared = values.groupBy("v").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    own = (values.join(shared, "v").groupBy("sig")
           .agg(F.sort_array(F.collect_list(F.struct("f", "v"))).alias("own")))
    unique = F.col("held") - F.size("own")
    rare = F.col("held") - _needed(F.col("n"), percent, k) + 1 - unique
    step = F.floor(F.log(F.col("n").cast("double")) / F.lit(-np.log(percent / 100)) + 1e-9)
    sizes = classes.select("sig", "rep", "n", F.size("sketch").alias("held"))
    rows = own.join(sizes, "sig").withColumn("rare", rare.cast("int")).where("rare > 0")
    return (rows.select("sig", "rep", "n", F.explode(F.array(step, step + 1)).alias("band"),
                        F.slice("own.v", F.lit(1), F.greatest("rare", F.lit(0))).alias("own"))
            .select("sig", "rep", "n", "band", F.explode("own").alias("v")))


def _whole_sets(lists: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(sig, own): whole sorted shingle sets of the classes that stand in a list."""
    wanted = lists.select("sig", "rep").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string").alias("text"))
    texts = possible(texts, "rep", cut(id_bitmap(wanted, "rep"))).where("_possible")

    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            sig = batch.column("sig").to_pylist()
            own = [shingle_hashes(words, width) for _, words in hasher.rows(batch.column("text"))]
            keep = [i for i, x in enumerate(own) if _signature(x) == sig[i]]  # an id may repeat with another text
            yield pa.RecordBatch.from_arrays([pa.array([sig[i] for i in keep], pa.int64()),
                                              list_array([own[i] for i in keep], pa.int64())], ["sig", "own"])

    found = texts.join(wanted, "rep").select("sig", "text").mapInArrow(tidy(run), "sig long, own array<long>")
    return found.dropDuplicates(["sig"])


def _star_links(grouped: DataFrame, low: DataFrame, sets: DataFrame, percent: int, k: int) -> DataFrame:
    """Verified links (a, b) of list members with the leaders of their lists; low(sig, sketch) has the members' sketches."""
    near = grouped.where((F.col("sig") != F.col("leader"))
                         & (F.least("n", "leader_n") * 100 >= F.greatest("n", "leader_n") * percent))
    both = (near.join(low.withColumnRenamed("sketch", "sb"), "sig")
            .join(low.select(F.col("sig").alias("leader"), F.col("sketch").alias("sa")), "leader"))
    common = F.size(F.array_intersect("sa", "sb"))
    drawn = F.size(F.array_intersect(F.array_intersect("sa", "sb"),
                                     F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)))
    total = F.col("n") + F.col("leader_n")
    passing = cut(both.where(F.when(F.greatest("n", "leader_n") <= k, common * (100 + percent) >= total * percent)
                             .otherwise(drawn >= _least_overlap(total * 100 / (100 + percent), percent, k)))
                  .select("leader", "sig"))
    pairs = (passing.join(sets.withColumnRenamed("own", "y"), "sig")
             .join(sets.select(F.col("sig").alias("leader"), F.col("own").alias("x")), "leader"))
    shared = F.size(F.array_intersect("x", "y"))
    return (pairs.where(shared * (100 + percent) >= (F.size("x") + F.size("y")) * percent)
            .select(F.col("leader").alias("a"), F.col("sig").alias("b")))


def _across(grouped: DataFrame, first: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between classes that share a list but not yet a component.

    The lists of one leader are taken together and dealt to blocks of about ``BLOCK``
    classes; a component larger than a block has blocks of its own, which are not
    compared among each other.  Pairs of blocks are compared as matrices inside tasks,
    and only links that join components come out.
    """
    placed = cut(grouped.select("leader", "sig").join(first.withColumnRenamed("node", "sig"), "sig", "left")
                 .withColumn("component", F.coalesce("component", "sig")))
    parts = placed.groupBy("leader", "component").agg(F.count(F.lit(1)).alias("size"))
    parts = cut(parts.withColumn("part", F.when(F.col("size") > BLOCK, F.col("component")).otherwise(F.lit(-1))))
    mixed = parts.groupBy("leader").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("leader")
    parts = cut(parts.join(mixed, "leader"))
    wide = cut(parts.groupBy("leader", "part").agg(F.ceil(F.sum("size") / BLOCK).cast("int").alias("blocks")))
    member = (placed.join(parts.select("leader", "component", "part"), ["leader", "component"])
              .join(wide, ["leader", "part"])
              .withColumn("block", F.pmod(F.xxhash64("sig"), F.col("blocks")).cast("int")))
    member = cut(member.select("leader", "part", "block", "sig", "component"))
    block = wide.select("leader", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    other = block.select("leader", F.col("part").alias("part2"), F.col("block").alias("block2"))
    order = F.struct("part", "block") <= F.struct(F.col("part2").alias("part"), F.col("block2").alias("block"))
    inside = (F.col("part") == F.col("part2")) & (F.col("part") != -1)
    pair = cut(block.join(other, "leader").where(order & ~inside))
    keys = ["leader", "part", "block", "part2", "block2"]
    left = member.join(pair, ["leader", "part", "block"]).select(*keys, F.lit(0).alias("side"), "sig", "component")
    right = (member.withColumnsRenamed({"part": "part2", "block": "block2"})
             .join(pair.where((F.col("part") != F.col("part2")) | (F.col("block") != F.col("block2"))),
                   ["leader", "part2", "block2"]).select(*keys, F.lit(1).alias("side"), "sig", "component"))
    rows = cut(left.union(right)).join(sets, "sig").select(*keys, "side", "sig", "component", "own")

    def compare(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        at = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        at = at if len(at[1]) else (at[0], at[0])
        sig, comp = table.column("sig").to_numpy(), table.column("component").to_numpy()
        found = block_links(_lists_of(table.column("own")), at[0], at[1], comp, percent)
        return pa.table({"a": pa.array([int(sig[i]) for i, _ in found], pa.int64()),
                         "b": pa.array([int(sig[j]) for _, j in found], pa.int64())})

    return rows.groupBy(*keys).applyInArrow(compare, "a long, b long")


def _lists_of(column: pa.ChunkedArray) -> list[np.ndarray]:
    out = []
    for chunk in column.chunks:
        offsets, flat = chunk.offsets.to_numpy(), chunk.values.to_numpy()
        out += [flat[offsets[i]: offsets[i + 1]] for i in range(len(chunk))]
    return out


def block_links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, comp: np.ndarray,
                percent: int) -> list[tuple[int, int]]:
    """Links (i, j) of rows of two blocks that join different components, as few as join them."""
    def flat(rows):
        who = np.repeat(np.arange(len(rows)), [len(sets[i]) for i in rows])
        return np.concatenate([sets[i] for i in rows]) if len(rows) else np.empty(0, np.int64), who
    xs, xr = flat(left)
    ys, yr = flat(right)
    vocabulary = np.intersect1d(xs, ys)
    inter = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(vocabulary), 4096):
        part = vocabulary[at: at + 4096]
        sides = []
        for values, rows, n in ((xs, xr, len(left)), (ys, yr, len(right))):
            pos = np.minimum(np.searchsorted(part, values), len(part) - 1)
            hit = part[pos] == values
            one = np.zeros((n, len(part)), np.float32)
            one[rows[hit], pos[hit]] = 1
            sides.append(one)
        inter += sides[0] @ sides[1].T
    inter = np.rint(inter).astype(np.int64)
    size = np.array([len(x) for x in sets], np.int64)
    total = size[left][:, None] + size[right][None, :]
    linked = (inter * (100 + percent) >= total * percent) & (comp[left][:, None] != comp[right][None, :])
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(linked), strict=True):
        i, j = int(left[i]), int(right[j])
        u, v = find(int(comp[i])), find(int(comp[j]))
        if u != v:
            root[max(u, v)] = min(u, v)
            out.append((i, j))
    return out


def drop_near_duplicates(docs: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """One document of each component, with all its columns; rows that repeat doc_id and text are kept once.

    An id may stand for several texts: of these the rows go that are not kept themselves.
    """
    found = cut(_placed(docs, width, threshold))
    known = found.where("doc_id is not null")
    # ids that repeat and that a kept row has: their rows are told apart by the signature of the text
    mixed = cut(known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("some"))
                .where("n > 1 and some").select("doc_id"))
    gone = known.where("not kept").select("doc_id")
    if mixed.isEmpty():
        return drop_ids(docs, gone)
    stay = (known.where("kept").join(mixed, "doc_id", "left_semi").groupBy("doc_id", F.expr("n_shingles = 0").alias("_blank"))
            .agg(F.min("sig").alias("_sig")).withColumnRenamed("doc_id", "_id"))
    rows = possible(docs, "doc_id", cut(id_bitmap(mixed, "doc_id"))).where("_possible").drop("_possible")
    rows = _signed(rows.withColumn("_id", F.col("doc_id").cast("long")), width).join(stay, ["_id", "_blank", "_sig"], "left_semi")
    rows = rows.withColumn("_text", F.when(F.col("_blank"), F.col("text"))).dropDuplicates(["_id", "_blank", "_text"])
    return drop_ids(docs, gone.union(mixed)).unionByName(rows.select(*docs.columns))


def _signed(rows: DataFrame, width: int) -> DataFrame:
    """The rows with _sig, the signature of the text's shingles, and _blank, whether it has none."""
    at = rows.columns.index("text")

    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            own = [shingle_hashes(words, width) for _, words in hasher.rows(batch.column(at))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([_signature(x) for x in own], pa.int64()), pa.array([not len(x) for x in own], pa.bool_())],
                [*batch.schema.names, "_sig", "_blank"])

    return rows.mapInArrow(tidy(run), StructType([*rows.schema.fields, StructField("_sig", LongType()),
                                                  StructField("_blank", BooleanType())]))
