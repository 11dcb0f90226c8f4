"""Preference data from pairs of conversations: shared prompt once, two completions, loss masks.

Turns are compared as rows: the turns of a side are numbered in their order, a place of a pair is
marked by the sides that hold its turn, the first place where they differ ends the longest common
prefix, and everything before is the prompt.  No conversation is collected or numbered in one
task; only parts of a bounded number of turns become strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import cut
from panelforge.operators.ordered import positions

#: Turns per part; a longer conversation continues in further rows.
PART_TURNS = 64
HEAD, TAIL = "<|im_start|>", "<|im_end|>\n"


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) without nulls: a missing turn is -1, a missing role or text is empty.

    Rows without a conv_id belong to no conversation; rows repeated exactly count once;
    different rows of one turn stay, in the order of role and text.
    """
    return (conversations.where("conv_id is not null")
            .select(F.col("conv_id").cast("long").alias("conv_id"), F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
                    F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct())


def with_weaker_reply(turns: DataFrame) -> DataFrame:
    """Pairs (pair_id, side, turn, role, text): each conversation up to its last reply against the same one with a
    weaker last reply: the conversation's first reply again or, if it has one reply only, half of it.

    Conversations without a reply by the assistant stand on both sides unchanged.
    """
    reply = F.col("role") == "assistant"
    info = cut(turns.groupBy("conv_id").agg(F.max(F.when(reply, F.col("turn"))).alias("last"),
                                            F.min(F.when(reply, F.struct("turn", "text"))).alias("first")))
    rows = turns.join(info, "conv_id").where(F.col("last").isNull() | (F.col("turn") <= F.col("last")))
    words = F.split("text", " ")
    half = F.array_join(F.slice(words, F.lit(1), F.floor(F.size(words) / 2).cast("int")), " ")
    weaker = F.when(F.col("first.turn") < F.col("last"), F.col("first.text")).otherwise(half)
    swapped = F.when(reply & (F.col("turn") == F.col("last")), weaker).otherwise(F.col("text"))
    sides = F.array(F.struct(F.lit("chosen").alias("side"), F.col("text").alias("text")),
                    F.struct(F.lit("rejected").alias("side"), swapped.alias("text")))
    return (rows.select(F.col("conv_id").alias("pair_id"), "turn", "role", F.explode(sides).alias("s"))
            .select("pair_id", "s.side", "turn", "role", "s.text"))


def preference_rows(pairs: DataFrame) -> DataFrame:
    """One row per pair and part: prompt, chosen and rejected text, and the spans that bear loss.

    ``pairs`` holds (pair_id, side 'chosen' or 'rejected', turn, role, text).  Turn numbers order the
    turns of a side and mean nothing else: gaps, other first numbers and shifts between the sides
    make no difference; turns of one number stand in the order of role and text, rows repeated exactly
    count once, a missing turn number comes first and a missing role or text is empty.  The prompt is
    the longest common prefix of turns, rendered once; chosen and rejected are what follows
    on either side.  Spans are [start, end) in characters of the part's completion and cover
    the assistant's texts with their end marks; everything else is masked.  ``preference`` is false
    for pairs of equal conversations, which have a prompt only.  Rows with a null pair_id or side are
    ignored, as are other columns.
    """
    rows = (pairs.where("pair_id is not null and side in ('chosen', 'rejected')")
            .select("pair_id", "side", F.struct(F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
                                                F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("at")).distinct())
    placed = positions(rows, ["pair_id", "side"], "at", "place")
    both = placed.groupBy("pair_id", F.col("place") - 1, "at.role", "at.text").agg(
        F.max((F.col("side") == "chosen").cast("int")).alias("c"), F.max((F.col("side") == "rejected").cast("int")).alias("r"))
    both = cut(both.toDF("pair_id", "place", "role", "text", "c", "r"))
    ends = cut(both.groupBy("pair_id").agg(F.min(F.when(F.col("c") != F.col("r"), F.col("place"))).alias("split")))
    part = F.floor(F.col("place") / PART_TURNS).cast("long").alias("part")
    rendered = F.concat(F.lit(HEAD), "role", F.lit("\n"), "text", F.lit(TAIL))
    head = F.length(F.concat(F.lit(HEAD), "role", F.lit("\n")))
    shared = F.col("split").isNull() | (F.col("place") < F.col("split"))
    cell = F.struct("place", "role", "text", rendered.alias("rendered"), head.alias("head"))

    def gathered(own: Column, name: str) -> Column:
        return F.sort_array(F.collect_list(F.when(own, cell))).alias(name)

    parts = (both.join(ends, "pair_id").withColumn("_shared", shared)
             .groupBy("pair_id", part).agg(gathered(F.col("_shared"), "_p"),
                                           gathered(~F.col("_shared") & (F.col("c") == 1), "_c"),
                                           gathered(~F.col("_shared") & (F.col("r") == 1), "_r"),
                                           F.max(F.col("split").isNotNull()).alias("preference")))
    return parts.select("pair_id", "part", "preference", F.size("_p").alias("prompt_turns"), _joined("_p").alias("prompt"),
                        _joined("_c").alias("chosen"), _spans("_c").alias("chosen_spans"),
                        _joined("_r").alias("rejected"), _spans("_r").alias("rejected_spans"))


def _joined(cells: str) -> Column:
    return F.array_join(F.col(f"{cells}.rendered"), "")


def _spans(cells: str) -> Column:
    """Spans of the assistant's texts and end marks, by a fold with a running offset."""
    tail = len(TAIL) - 1  # the line break after the end mark bears no loss
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(acc: Column, x: Column) -> Column:
        begin = (acc["at"] + x["head"]).cast("int")
        own = F.array(F.struct(begin.alias("start"), (begin + F.length(x["text"]) + tail).cast("int").alias("end")))
        return F.struct((acc["at"] + F.length(x["rendered"])).cast("int").alias("at"),
                        F.when(x["role"] == "assistant", F.concat(acc["spans"], own)).otherwise(acc["spans"]).alias("spans"))
    return F.aggregate(F.col(cells), start, add, lambda acc: acc["spans"])
