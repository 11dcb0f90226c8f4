"""Benchmark items in documents, also with other numbers, names and units.

Words are canonicalised to templates: numbers, units and names become typed placeholders,
everything else its lower-case letters.  Items that differ in values only form one class.  Windows
of the templates are hash-joined with the classes', counted by region of the document; where a matched window holds other values than
the item, these are checked: around a region, one value of the item must stand for one value
of the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import cut, drop_ids

WIDTH = 5
#: An item is found when so many of its windows match, or this share of them if it has fewer.
ENOUGH_WINDOWS, ENOUGH_SHARE = 9, 0.8
#: Share of an item's slot occurrences that must follow one assignment of values.
CONSISTENT_SHARE = 0.8
#: Item lengths to each side of a region in which other values of its slots count against it.
NEAR = 2
#: Benchmark windows up to this number are broadcast (about 100 bytes each), beyond it they are shuffled.
BROADCAST_WINDOWS = 200_000

# Units of measure and money, and words for numbers, as they are written after a number or alone.
UNITS = ("mm cm m km mg g kg t ml l s h min ms kb mb gb tb hz khz mhz ghz w kw v a c f k mph kph "
         "inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres "
         "gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres gallon gallons "
         "second seconds minute minutes hour hours day days week weeks month months year years "
         "dollar dollars cent cents euro euros percent degree degrees").split()
NUMBER_WORDS = ("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
                "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand "
                "million billion").split()
_LETTERS = r"[\p{L}\p{N}]"
#: A capitalised word that does not begin a sentence.
_NAME = r"\p{Lu}(?<=[^\s.!?:]\s{1,3}\p{Lu})\p{Ll}+(?!" + _LETTERS + ")"
_NUMBER = r"[$€£¥]?\d+(?:[.,:/]\d+)*(?:%|(?:st|nd|rd|th)(?!" + _LETTERS + "))?"
_UNIT = r"(<num=[^>]*>\s{0,3})(" + "|".join(UNITS) + ")(?!" + _LETTERS + ")"


def _marked(text: Column) -> Column:
    """Lower-case text with placeholders that still hold their values: <num=..>, <unit=..>, <name=..>."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    t = F.when(F.contains(t, F.lit("<")) | F.contains(t, F.lit(">")), F.regexp_replace(t, "[<>]", " ")).otherwise(t)
    return F.lower(F.regexp_replace(F.regexp_replace(t, _NUMBER, "<num=$0>"), _NAME, "<name=$0>"))


def template_windows(rows: DataFrame, key: str, width: int = WIDTH, shorter: tuple[int, ...] = ()) -> DataFrame:
    """(key, pos, h, slots, n, bare, inner): every window of the row's template; slots are their values or null.

    Rows with fewer words than ``width`` have one window of their ``n`` words, rows without words none.
    Windows of the lengths in ``shorter`` that are a part of the row only are ``inner``.  The hash of
    a window made of placeholders only (``bare``) is that of its values, as its template says nothing.
    """
    words = rows.select(key, _marked(F.col("text")).alias("_m"))
    words = words.select(key, F.when(F.contains("_m", F.lit("<num=")), F.regexp_replace("_m", _UNIT, "$1<unit=$2>"))
                         .otherwise(F.col("_m")).alias("_m"))
    filled = F.contains("_m", F.lit("<"))
    plain = F.when(filled, F.regexp_replace("_m", "=[^>]*>", ">")).otherwise(F.col("_m"))
    token = F.lit(r"<[a-z]+>|[\p{L}\p{N}]+")
    valued = F.regexp_extract_all("_m", F.lit(r"<[a-z]+=[^>]*>|[\p{L}\p{N}]+"), F.lit(0))
    words = words.select(key, "_m", F.regexp_extract_all(plain, token, F.lit(0)).alias("_c"))
    hashed = F.transform("_c", lambda w: F.xxhash64(w))  # number words are placeholders too
    number = F.xxhash64(F.lit("<num>"))
    spelled = [F.xxhash64(F.lit(w)) for w in NUMBER_WORDS]
    hashed = F.transform(hashed, lambda h: F.when(h.isin(*spelled), number).otherwise(h))
    words = words.select(key, "_m", hashed.alias("_c"))
    slot = F.transform(valued, lambda t: F.when(F.startswith(t, F.lit("<")) | t.isin(*NUMBER_WORDS), t))
    words = words.select(key, "_c", F.when(F.contains("_m", F.lit("<")) | F.array_contains("_c", number), slot).alias("_v"))
    # shifted slices side by side: windows are then rows of plain columns, hashed in generated code
    size = F.size("_c")
    count = F.greatest(size if shorter else size - width + 1, F.lit(1))
    shifted = [F.slice("_c", k + 1, count).alias(f"c{k}") for k in range(width)]
    values = F.coalesce("_v", F.array().cast("array<string>"))
    shifted += [F.slice(values, k + 1, count).alias(f"v{k}") for k in range(width)]
    out = words.select(key, size.alias("_size"), F.posexplode(F.arrays_zip(*shifted)).alias("pos", "_x"))
    out = out.select(key, "_size", "pos", *[F.col(f"_x.{c}{k}").alias(f"{c}{k}") for c in "cv" for k in range(width)])

    def window(n: int, inner: bool) -> list[Column]:
        codes, own = [F.col(f"c{k}") for k in range(n)], [F.col(f"v{k}") for k in range(n)]
        some = F.coalesce(*own).isNotNull()
        # a place is bare if it has a value or lies behind the last word
        bare = some
        for c, v in zip(codes, own, strict=True):
            bare = bare & (v.isNotNull() | c.isNull())
        h = F.when(bare, F.xxhash64(F.lit("bare"), *own)).otherwise(F.xxhash64(*codes))
        slots = F.array(*own, *[F.lit(None).cast("string")] * (width - n))
        length = F.lit(n) if inner else F.least("_size", F.lit(n))
        return [h.alias("h"), F.when(some, slots).alias("slots"), length.alias("n"), bare.alias("bare"), F.lit(inner).alias("inner")]

    whole = out.where(F.col("pos") <= F.greatest(F.col("_size") - width, F.lit(0))) if shorter else out
    found = whole.select(key, "pos", *window(width, False))
    for n in shorter:
        found = found.union(out.where((F.col("pos") + n <= F.col("_size")) & (F.col("_size") > n)).select(key, "pos", *window(n, True)))
    return found


def _classes(items: DataFrame, width: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Items by class: (item_id, class, members), the classes' windows and the valued windows of every item.

    A class holds items of the same windows whose slots repeat in the same pattern: other values of the
    same question.  ``pattern`` lists a window's slots k with the place where their value first
    stands in the item.  Items shorter than ``width`` must agree in their values too.
    """
    windows = cut(template_windows(items, "item_id", width).select("item_id", "pos", "h", "slots", "n", "bare").distinct())
    valued = windows.where("slots is not null").select("item_id", "pos", "h", "slots", F.posexplode("slots").alias("k", "v")).where("v is not null")
    first = valued.groupBy("item_id", "v").agg(F.min(F.col("pos") + F.col("k")).alias("first"))
    pattern = (valued.join(first, ["item_id", "v"]).groupBy("item_id", "pos", "h", "slots")
               .agg(F.sort_array(F.collect_list(F.struct("k", "first"))).alias("pattern")))  # at most ``width`` entries
    windows = (windows.join(pattern, ["item_id", "pos", "h", "slots"], "left")
               .withColumn("own", F.when(F.col("n") < width, F.col("slots"))))
    windows = cut(windows)
    sign = [F.bit_xor(F.xxhash64(F.lit(k), "pos", "h", "pattern", "own")).alias(f"x{k}") for k in (1, 2)]
    items = windows.groupBy("item_id").agg(*sign, F.count(F.lit(1)).alias("c"))
    named = items.groupBy("x1", "x2", "c").agg(F.min("item_id").alias("class"), F.count(F.lit(1)).alias("members"))
    named = cut(items.join(named, ["x1", "x2", "c"]).select("item_id", "class", "members"))
    of_class = windows.join(named.where("item_id = class").select("item_id", "class"), "item_id").drop("item_id", "slots")
    of_item = windows.where("slots is not null").join(named, "item_id").select("class", "item_id", "h", "slots").distinct()
    return named, of_class, of_item


def _found(docs: DataFrame, benchmark: DataFrame, width: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classes by item, (doc_id, class, windows, total, consistency) of classes found whole, and the same with
    item_id of single items found by their own values."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null")
    named, bench, valued = _classes(items, width)
    bench = cut(bench)
    shorter = tuple(r["n"] for r in bench.where(F.col("n") < width).select("n").distinct().orderBy("n").collect())
    need = cut(bench.groupBy("class").agg(F.countDistinct("h").alias("total"), (F.max("pos") + 1).alias("length"),
                                          F.countDistinct(F.when(~F.col("bare"), F.col("h"))).alias("worded")))
    bench = cut(bench.select("class", "h", "pattern", "own").distinct().join(need.select("class", "length"), "class"))
    side = F.broadcast(bench) if bench.count() <= BROADCAST_WINDOWS else bench
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    hits = cut(template_windows(texts, "doc_id", width, shorter).join(side, "h")
               .where(~F.col("inner") | F.col("slots").eqNullSafe(F.col("own")))
               .select("doc_id", "class", "h", F.floor(F.col("pos") / F.col("length")).alias("place"), "slots", "pattern").distinct())
    region = ["doc_id", "class", "region"]
    around = hits.withColumn("region", F.explode(F.array(F.col("place") - 1, F.col("place"))))
    found = around.groupBy(*region).agg(F.countDistinct("h").alias("windows")).join(need, "class")
    verbatim, enough = (F.least(F.lit(ENOUGH_WINDOWS), F.ceil(n * ENOUGH_SHARE))
                        for n in (F.col("total"), F.greatest(F.col("worded"), F.col("total") / 2)))
    found = cut(found.where(F.col("windows") >= enough).withColumn("verbatim", verbatim))
    filled = hits.where("slots is not null and pattern is not null").withColumn(
        "region", F.explode(F.sequence(F.col("place") - 1 - NEAR, F.col("place") + NEAR)))
    filled = filled.join(found.select(*region), region, "left_semi")
    pairs = (filled.select(*region, "h", "slots", "pattern").distinct().select(*region, "slots", F.explode("pattern").alias("p"))
             .select(*region, F.col("p.first").alias("theirs"), F.get("slots", F.col("p.k")).alias("ours")).where("ours is not null"))
    each = pairs.groupBy(*region, "theirs", "ours").agg(F.count(F.lit(1)).alias("n"))
    each = each.groupBy(*region, "theirs").agg(F.max("n").alias("top"), F.sum("n").alias("n"))
    each = each.groupBy(*region).agg((F.sum("top") / F.sum("n")).alias("consistency"))
    judged = cut(found.join(each, region, "left").withColumn("consistency", F.coalesce("consistency", F.lit(1.0)))
                 .select(*region, "windows", "total", "verbatim", "consistency"))
    # where values differ, windows without values count for all items of the class and others for the items that hold them
    mixed = judged.where("consistency < 1")
    inside = around.join(mixed.select(*region), region, "left_semi").select(*region, "h", "slots").distinct()
    plain = inside.where("slots is null").groupBy(*region).agg(F.countDistinct("h").alias("plain"))
    judged = judged.join(plain, region, "left").withColumn("plain", F.coalesce("plain", F.lit(0)))
    judged = cut(judged.withColumn("consistency", F.when(F.col("plain") >= F.col("verbatim"), 1.0).otherwise(F.col("consistency"))))
    whole = (judged.where(F.col("consistency") >= CONSISTENT_SHARE).groupBy("doc_id", "class")
             .agg(F.max("windows").alias("windows"), F.max("total").alias("total"), F.max("consistency").alias("consistency")))
    equal = inside.join(valued, ["class", "h", "slots"]).groupBy(*region, "item_id").agg(F.countDistinct("h").alias("equal"))
    single = (equal.join(judged.where("consistency < 1"), region).where(F.col("plain") + F.col("equal") >= F.col("verbatim"))
              .groupBy("doc_id", "class", "item_id").agg(F.max("windows").alias("windows"), F.max("total").alias("total"))
              .withColumn("consistency", F.lit(1.0)))
    return named, cut(whole), cut(single)


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, item_id, windows, share, consistency): the items found in documents.

    Documents are judged by regions of two item lengths that overlap by one, so windows scattered
    over a long text are no copy.  ``windows`` is the number of distinct windows of the item
    that the best region holds, ``share`` their share of the item's windows.  Windows with the item's
    own values, or without any, are verbatim: a region with enough of them is found whatever
    else the text holds (consistency 1).  Otherwise ``consistency`` is the share of slot occurrences
    within the region and NEAR item lengths around it that follow one assignment (1 without
    placeholders).  Rows with the same doc_id are judged together, each from its first word.  Null
    doc_ids and item_ids, null, empty and blank texts match nothing.

    All windows of an item count, but those made of placeholders only match their own values, and a
    region with other values needs enough of the rest, as if that were half of the item's
    windows at least.  An item shorter than ``width`` is found inside longer texts with its own values.

    Items that differ in values only are one class until the end, so work follows the classes a
    document meets; this list has a row for each of their items, ``document_report`` counts them by class.
    """
    named, whole, single = _found(docs, benchmark, width)
    cells = ["doc_id", "item_id", "windows", "total", "consistency"]
    out = whole.join(named, "class").select(*cells).union(single.select(*cells))
    return (out.groupBy("doc_id", "item_id").agg(F.max("windows").alias("windows"), F.max("total").alias("total"),
                                                 F.max("consistency").alias("consistency"))
            .select("doc_id", "item_id", "windows", (F.col("windows") / F.col("total")).alias("share"), "consistency"))


def document_report(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, contaminated and n_items of every row of ``docs``; rows with a null doc_id are not contaminated."""
    named, whole, single = _found(docs, benchmark, width)
    sizes = named.where("item_id = class").select("class", "members")
    alone = single.join(whole, ["doc_id", "class"], "left_anti").select("doc_id", F.lit(1).cast("long").alias("members"))
    found = cut(whole.join(sizes, "class").select("doc_id", "members").union(alone)
                .groupBy("doc_id").agg(F.sum("members").alias("n_items")))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(found, "doc_id", "left")
            .select("doc_id", F.col("n_items").isNotNull().alias("contaminated"),
                    F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item was found, with all their columns."""
    _, whole, single = _found(docs, benchmark, width)
    return drop_ids(docs, cut(whole.select("doc_id").union(single.select("doc_id")).distinct()))
