"""Shards of equal row counts that keep linked documents together, by balanced label propagation.

Documents that share a group key (here: equal texts) are linked with each other.  The
links are never listed: a group's vote is its number of members in every shard, so the
state of the propagation is (key, shard, n), at most one row per group and shard however
many documents a group has.  Rounds go on until no row moves or two of them in turn cut no link
less than the best before; that best is taken.  In each round portions of a group move to the shards that
hold most of it, as far as the target's free capacity (quota) allows; documents without
links fill what is left, which makes the row counts exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import cut, gapless, partitions

#: Parts that a group is dealt to by the hash of doc_id before it is numbered.
SUBGROUPS = 512
#: Parts of a target shard's quota; each is handed out on its own.
QUOTA_PARTS = 64


def shard_rows(rows: DataFrame, shards: int) -> DataFrame:
    """Add shard (int) and slot (long, gapless from 0 in each shard) to rows(doc_id, key, ...).

    Row counts of shards differ by one at most.  Rows with equal non-null keys are linked;
    a group larger than a shard is spread over as few shards as propagation finds.  Null
    keys and null or repeated doc_ids are allowed; an empty table gives no rows.
    """
    n_buckets = max(64, 4 * partitions(rows.sparkSession))
    rows = cut(rows.withColumn("_sub", F.pmod(F.xxhash64("doc_id"), F.lit(SUBGROUPS)).cast("int")))
    total = rows.count()
    capacity = [total // shards + (s < total % shards) for s in range(shards)]
    sub = cut(rows.where("key is not null").groupBy("key", "_sub").agg(F.count(F.lit(1)).alias("n")))
    sizes = sub.groupBy("key").agg(F.sum("n").alias("size")).where("size > 1")
    sub = cut(sub.join(sizes, "key"))
    state = cut(sub.withColumn("shard", F.pmod(F.xxhash64("key", "_sub"), F.lit(shards)).cast("int"))
                .groupBy("key", "shard").agg(F.sum("n").alias("n")))
    state = _propagated(state, capacity)
    linked = _placed(rows, sub, state)
    load = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}  # one row a shard
    kept = [min(load.get(s, 0), capacity[s]) for s in range(shards)]
    own = gapless(cut(linked.where("shard is not null")), ["shard"], ["doc_id", "key"], "slot", n_buckets)
    own = cut(own.withColumn("_fits", F.col("slot") < _by_shard(F.col("shard"), kept)))
    pool = linked.where("shard is null").unionByName(own.where("not _fits").drop("_fits", "slot"))
    pool = gapless(cut(pool), [], ["doc_id", "key"], "_at", n_buckets)
    ends, starts = [], []
    for s in range(shards):
        starts.append(ends[-1] if ends else 0)
        ends.append(starts[-1] + capacity[s] - kept[s])
    shard = F.size(F.filter(_longs(ends), lambda e: e <= F.col("_at"))).cast("int")
    pool = pool.withColumn("shard", shard).withColumn(
        "slot", F.col("_at") - _by_shard(F.col("shard"), starts) + _by_shard(F.col("shard"), kept))
    return own.where("_fits").drop("_fits").unionByName(pool.drop("_at")).drop("_sub")


def cut_links(sharded: DataFrame) -> DataFrame:
    """One row: links (pairs with equal keys) and how many of them lie across shards, from counts alone."""
    by = sharded.where("key is not null").groupBy("key", "shard").agg(F.count(F.lit(1)).cast("double").alias("n"))
    by = by.groupBy("key").agg(F.sum("n").alias("t"), F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("inside"))
    return by.agg(F.sum(F.col("t") * (F.col("t") - 1) / 2).alias("links"),
                  F.sum(F.col("t") * (F.col("t") - 1) / 2 - F.col("inside")).alias("across"))


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _by_shard(shard: Column, values: list[int]) -> Column:
    return F.get(_longs(values), shard)


def _propagated(state: DataFrame, capacity: list[int]) -> DataFrame:
    """The state with the fewest cut links that rounds of moves reach."""
    best, kept, idle = state, _inside(state), 0
    while idle < 2:
        state, moved = _round(state, capacity)
        if not moved:
            break
        now = _inside(state)
        idle = 0 if now > kept else idle + 1
        if now > kept:
            best, kept = state, now
    return best


def _inside(state: DataFrame) -> float:
    """Links inside shards, but for a constant: the sum of the squared portions."""
    return state.agg(F.sum(F.col("n").cast("double") * F.col("n"))).first()[0] or 0.0


def _round(state: DataFrame, capacity: list[int]) -> tuple[DataFrame, int]:
    """One round of moves under quotas; (new state, rows moved)."""
    shards = len(capacity)
    load = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    free = [max(0, capacity[s] - load.get(s, 0)) for s in range(shards)]
    room = F.greatest(F.lit(1), F.lit(max(capacity) if capacity else 1))
    key = Window.partitionBy("key")
    open_to = _by_shard(F.col("shard"), free) > 0
    liked = key.orderBy(F.col("open").desc(), F.col("n").desc(), F.xxhash64("key", "shard"))
    ranked = (state.withColumn("open", open_to).withColumn("size", F.sum("n").over(key))
              .withColumn("rank", F.row_number().over(liked))
              .withColumn("wanted", F.ceil(F.col("size") / room))
              .withColumn("opens", F.sum(F.col("open").cast("int")).over(key)))
    ranked = ranked.withColumn("wanted", F.least("wanted", "opens").cast("int"))
    targets = F.collect_list(F.when(F.col("rank") <= F.col("wanted"), F.struct("rank", "shard", "n"))).over(key)
    moves = (ranked.withColumn("targets", F.sort_array(targets))
             .where((F.col("rank") > F.col("wanted")) & (F.col("wanted") > 0))
             .withColumn("to", F.get("targets", F.pmod(F.col("rank"), F.col("wanted"))))
             .select("key", "shard", "n", F.col("to.shard").alias("target"), F.col("to.n").alias("gain"),
                     F.pmod(F.xxhash64("key", "shard"), F.lit(QUOTA_PARTS)).cast("int").alias("part")))
    moves = cut(moves)
    asked = moves.groupBy("target", "part").agg(F.sum("n").alias("asked"))
    # shares of the free capacity, rounded so that they add up to it
    target = Window.partitionBy("target")
    asked = (asked.withColumn("all", F.sum("asked").over(target))
             .withColumn("upto", F.sum("asked").over(target.orderBy("part"))))
    free_rows = _by_shard(F.col("target"), free).cast("double")
    share = [F.floor(F.least(free_rows, F.col("all")) * F.col(c) / F.col("all")) for c in ("upto", "before")]
    asked = asked.withColumn("before", F.col("upto") - F.col("asked"))
    quota = share[0] - share[1]
    before = (Window.partitionBy("target", "part").orderBy(F.col("gain").desc(), "key", "shard")
              .rowsBetween(Window.unboundedPreceding, -1))
    taken = (moves.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
             .join(F.broadcast(asked.select("target", "part", quota.alias("quota"))), ["target", "part"])
             .withColumn("take", F.greatest(F.lit(0), F.least(F.col("n"), F.col("quota") - F.col("before"))))
             .where("take > 0"))
    taken = cut(taken.select("key", "shard", "target", F.col("take").cast("long").alias("take")))
    moved = taken.agg(F.sum("take")).first()[0] or 0
    if not moved:
        return state, 0
    change = state.unionByName(taken.select("key", "shard", (-F.col("take")).alias("n"))).unionByName(
        taken.select("key", F.col("target").alias("shard"), F.col("take").alias("n")))
    return cut(change.groupBy("key", "shard").agg(F.sum("n").alias("n")).where("n > 0")), moved


def _placed(rows: DataFrame, sub: DataFrame, state: DataFrame) -> DataFrame:
    """Give every linked row a shard so that each group has its portions; rows without links get null."""
    ahead = Window.partitionBy("key").orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("key").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    ranges = (state.withColumn("end", F.sum("n").over(upto)).groupBy("key")
              .agg(F.sort_array(F.collect_list(F.struct("end", "shard"))).alias("ranges")))
    start = sub.select("key", "_sub", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start")).join(ranges, "key")
    number = F.row_number().over(Window.partitionBy("key", "_sub").orderBy("doc_id")) - 1
    own = rows.where("key is not null").withColumn("_r", number).join(start, ["key", "_sub"], "left")
    at = F.col("start") + F.col("_r")
    shard = F.get(F.filter("ranges", lambda r: at < r["end"]), F.lit(0))["shard"]
    own = own.withColumn("shard", shard.cast("int")).drop("_r", "start", "ranges")
    return cut(own.unionByName(rows.where("key is null").withColumn("shard", F.lit(None).cast("int"))))


def document_shards(docs: DataFrame, shards: int = 40) -> DataFrame:
    """All documents in shards 0 to ``shards`` - 1 under the law ``rows``; documents with equal texts are linked.

    Returns doc_id, size (UTF-8 bytes of the text plus 16; a null text has none), text_crc32
    (unsigned, of the UTF-8 bytes; null for a null text), law, shard, slot (gapless from 0 in
    each shard) and grown_shard (null under this law).  Null texts are linked with nothing;
    empty texts equal each other.  Repeated rows are placed one by one.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
                       F.md5(text.cast("binary")).alias("key"))
    out = shard_rows(rows, shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
