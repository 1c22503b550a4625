"""Benchmark items in documents, also with other numbers, names and units.

Texts become templates: numbers, names (capitalised words inside a sentence) and units after numbers give way to typed
placeholders. A second template keeps names as words, so that other capitals or line ends do no harm. Windows of five template
words of the items are joined by hash with those of the documents. A document that holds four fifths of the windows of an
item, in either template, is a candidate; its slot values are then compared: along the best alignment,
a value of the item must always stand for the same value in the document. So exact copies and re-parameterised questions
are both found, while texts that agree only in placeholders are not.

Only DataFrame functions are used. The windows of the items are broadcast only if they are counted to be few; otherwise
both sides are shuffled.

Windows with fewer than three plain words are not evidence. Items without evidence, such as those under five words, are looked
for as they are: all their lower-cased words in a row, values not replaced.

A character of a script without blanks between words is a word of its own.

Defined results: null and empty texts, and items without any word, are never found. Texts are looked at whole, whatever their
length. Of the alignments of an item that with most slots counts, then the most consistent, then the least shifted. An item of a single word is found only in
documents of that single word. Items found as they are have one window, no slots and consistency 1. An item that is repeated under one id counts once;
under several ids it is found for each. Repeated documents are found alike. Other columns stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, query, ready, table
from tidemark.session import cut_lineage

WORDS, SIMILARITY, CONSISTENT = 5, 0.8, 0.8
PLAIN_WORDS = 3
#: Windows of all items that may be broadcast.
BROADCAST_WINDOWS = 200_000

# Units of measure.
UNITS = (
    "percent|kilometers?|kilometres?|meters?|metres?|centimeters?|centimetres?|millimeters?|miles?|feet|foot|inch(?:es)?|"
    "yards?|kilograms?|grams?|pounds?|ounces?|tons?|liters?|litres?|gallons?|seconds?|minutes?|hours?|days?|weeks?|months?|"
    "years?|dollars?|cents?|euros?|degrees?|km|cm|mm|kg|mg|lbs?|oz|mph|kmh|ml|hz|khz|mhz|ghz|kb|mb|gb|tb"
)
# Scripts written without blanks (Thai and Lao, Burmese, Khmer, radicals, kana, Han), each character of which is a
# word; and the two ranges around them, which most texts have nothing of and which are quicker to look for.
UNSPACED = (
    r"[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u2E80-\u2FDF\u3005-\u3007\u3040-\u30FF\u31F0-\u31FF"
    r"\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}]"
)
AROUND = r"[\u0E00-\u1FFF\u2E80-\x{3FFFF}]"
LONGEST = 2**31 - 1
NAME, NUMBER, UNIT = "\u0001", "\u0002", "\u0003"


def spread(text: Column) -> Column:
    """A text with blanks around characters of scripts that have none between words."""
    return F.when(F.rlike(text, F.lit(AROUND)), F.regexp_replace(text, UNSPACED, " $0 ")).otherwise(text)


def template_words(text: Column) -> Column:
    """Lower-cased words; those that are names or units start with a mark, numbers with a digit."""
    marked = F.regexp_replace(spread(text), r"[\s\p{Z}]+", " ")
    marked = F.regexp_replace(marked, rf"(?<=[0-9]) ?(?=(?i:{UNITS})(?![\p{{L}}\p{{N}}]))", f" {UNIT}")
    marked = F.regexp_replace(marked, r"(?<=[\p{L}\p{N},;] )\p{Lu}(?=\p{L})", NAME + "$0")
    marked = F.regexp_replace(F.lower(marked), r"(?<=[0-9])[.,:](?=[0-9])", "")
    return F.array_remove(F.split(marked, r"[^\p{L}\p{N}\x01-\x03]+"), "")


def without_names(words: Column) -> Column:
    """The second template: names are plain words."""
    return F.transform(words, lambda word: F.when(_first(word) == NAME, F.substring(word, 2, LONGEST)).otherwise(word))


def _first(word: Column) -> Column:
    return F.substring(word, 1, 1)


def has_names(words: Column) -> Column:
    return F.exists(words, lambda word: _first(word) == NAME)


def is_slot(word: Column) -> Column:
    return (_first(word) <= "9") & (_first(word) != "")


def placeholder(word: Column) -> Column:
    """The word, or the mark of its kind."""
    first = _first(word)
    return F.when(first > "9", word).when(first >= "0", F.lit(NUMBER)).otherwise(first)


def bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, even where ``body`` uses it in a loop."""
    return F.element_at(F.transform(F.array(value), body), 1)


def window_hashes(words: Column, size: int = WORDS) -> Column:
    """A hash for each run of ``size`` template words, in order."""

    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hashes) - (size - 1))
        runs = F.transform(starts, lambda start: F.xxhash64(F.slice(hashes, start, size)))
        return F.when(F.size(hashes) >= size, runs).otherwise(F.array().cast("array<bigint>"))

    return bound(F.transform(words, lambda word: F.xxhash64(placeholder(word))), windows)


def both_templates(words: Column, size: int = WORDS) -> Column:
    """The different windows of both templates. Those without names are the same in both."""

    def windows(words: Column) -> Column:
        plain = F.when(has_names(words), window_hashes(without_names(words), size)).otherwise(F.array().cast("array<bigint>"))
        return F.array_union(window_hashes(words, size), plain)

    return bound(words, windows)


def item_windows(items: DataFrame, size: int = WORDS) -> DataFrame:
    """(item_id, item, template, position, window, slots): the windows of each item that are evidence, with their slot values.

    Template 0 has marks for names, template 1 has names as words; items without names have no template 1.
    """
    words = items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    words = words.select("item_id", F.xxhash64("item_id", "text").alias("item"), template_words(F.col("text")).alias("words"))
    marked, plain = words.withColumn("template", F.lit(0)), words.where(has_names(F.col("words"))).withColumn("template", F.lit(1))
    words = marked.union(plain.withColumn("words", without_names(F.col("words"))))
    placed = words.select(
        "item_id", "item", "template", "words", F.posexplode(window_hashes(F.col("words"), size)).alias("position", "window")
    )
    run = F.slice("words", F.col("position") + 1, size)
    slots = F.filter(run, is_slot)
    placed = placed.select("item_id", "item", "template", "position", "window", slots.alias("slots"))
    return placed.where(F.size("slots") <= size - PLAIN_WORDS)


def word_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(F.lower(spread(text)), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda word: F.xxhash64(word))


def bare_leaks(docs: DataFrame, items: DataFrame, evidence: DataFrame) -> DataFrame | None:
    """(doc_id, text_key, item_id, item) of the items without evidence whose words stand in a row in a document of
    (doc_id, text_key, text); None if there are no such items."""
    bare = items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    bare = bare.select("item_id", F.xxhash64("item_id", "text").alias("item"), word_hashes(F.col("text")).alias("words"))
    bare = bare.join(evidence.select("item").distinct(), "item", "left_anti").where(F.size("words") > 0)
    bare = cut_lineage(bare.select("item_id", "item", F.size("words").alias("n"), F.xxhash64("words").alias("run")))
    # One number for each length that occurs.
    lengths = sorted(row["n"] for row in bare.select("n").distinct().collect())
    if not lengths:
        return None
    none = F.array().cast("array<bigint>")

    def runs(hashes: Column) -> Column:
        def of(n: int) -> Column:
            starts = F.sequence(F.lit(1), F.size(hashes) - (n - 1))
            own = F.transform(starts, lambda start: F.xxhash64(F.slice(hashes, start, n)))
            return F.when(F.size(hashes) == 1 if n == 1 else F.size(hashes) >= n, own).otherwise(none)

        return F.array_distinct(F.concat(*map(of, lengths)))

    held = docs.select("doc_id", "text_key", F.explode(bound(word_hashes(F.col("text")), runs)).alias("run"))
    lookup = bare.select("item_id", "item", "run")
    if bare.count() <= BROADCAST_WINDOWS:
        lookup = F.broadcast(lookup)
    return held.join(lookup, "run").select("doc_id", "text_key", "item_id", "item").distinct()


def leaks(documents: DataFrame, items: DataFrame, size: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, text_key, item_id, item, n_windows, n_found, n_slots, consistency, changed): every item found in a document.

    ``text_key`` is the hash of the text; ``changed`` tells whether slot values differ from those of the item.
    """
    evidence = cut_lineage(item_windows(items, size))
    lookup = evidence.select("item_id", "item", "template", "window").distinct()
    totals = lookup.groupBy("item", "template").agg(F.count("*").alias("n_windows"))
    if evidence.count() <= BROADCAST_WINDOWS:
        lookup = F.broadcast(lookup)
    docs = documents.select("doc_id", F.xxhash64("text").alias("text_key"), F.col("text").alias("text"))
    held = docs.select("doc_id", "text_key", F.explode(both_templates(template_words(F.col("text")), size)).alias("window"))
    found = held.join(lookup, "window").groupBy("doc_id", "text_key", "item_id", "item", "template")
    found = found.agg(F.countDistinct("window").alias("n_found")).join(totals, ["item", "template"])
    found = cut_lineage(found.where(F.col("n_found") >= F.col("n_windows") * similarity))

    # Slot values of the candidates only.
    wanted = found.select(F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key"), "item", "template")
    chosen = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_key") == F.col("c_key")))
    chosen = chosen.select("c_id", "c_key", "item", "template", template_words(F.col("text")).alias("words"))
    chosen = chosen.withColumn("words", F.when(F.col("template") == 0, F.col("words")).otherwise(without_names(F.col("words"))))
    placed = chosen.select("c_id", "c_key", "item", "template", "words", F.posexplode(window_hashes(F.col("words"), size)).alias("at", "window"))
    slots = F.filter(F.slice("words", F.col("at") + 1, size), is_slot)
    placed = placed.select("c_id", "c_key", "item", "template", "at", "window", slots.alias("own")).where(F.size("own") > 0)
    aligned = placed.join(evidence.select("item", "template", "window", "position", "slots"), ["item", "template", "window"])
    pairs = aligned.select(
        "c_id", "c_key", "item", "template", (F.col("at") - F.col("position")).alias("shift"), F.explode(F.arrays_zip("slots", "own")).alias("pair")
    )
    keys = ["c_id", "c_key", "item", "template"]
    values = pairs.groupBy(*keys, "shift", F.col("pair.slots").alias("value")).agg(
        F.min("pair.own").alias("low"), F.max("pair.own").alias("high")
    )
    shifts = values.groupBy(*keys, "shift").agg(
        F.count("*").alias("n_slots"),
        F.avg((F.col("low") == F.col("high")).cast("double")).alias("consistency"),
        F.max((F.col("low") != F.col("value")) | (F.col("high") != F.col("value"))).alias("changed"),
    )
    best = F.max_by(F.struct("n_slots", "consistency", "changed"), F.struct("n_slots", "consistency", -F.abs("shift"), "shift"))
    best = shifts.groupBy(*keys).agg(best.alias("best")).select(*keys, "best.*").withColumnsRenamed({"item": "c_item", "template": "c_template"})
    same = F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_key") == F.col("c_key")) & (F.col("item") == F.col("c_item"))
    same = same & (F.col("template") == F.col("c_template"))
    judged = found.join(best, same, "left").select(
        "doc_id", "text_key", "item_id", "item", "template", "n_windows", "n_found",
        F.coalesce("n_slots", F.lit(0)).alias("n_slots"),
        F.coalesce("consistency", F.lit(1.0)).alias("consistency"),
        F.coalesce("changed", F.lit(False)).alias("changed"),
    )
    judged = judged.where(F.col("consistency") >= CONSISTENT)
    # Of the templates, the one that holds more; of equals the first.
    values = F.struct("n_windows", "n_found", "n_slots", "consistency", "changed")
    judged = judged.groupBy("doc_id", "text_key", "item_id", "item").agg(
        F.max_by(values, F.struct(F.col("n_found") / F.col("n_windows"), -F.col("template"))).alias("v")
    )
    judged = judged.select("doc_id", "text_key", "item_id", "item", "v.*")
    bare = bare_leaks(docs, items, evidence)
    if bare is None:
        return judged
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    return judged.unionByName(
        bare.select(
            "*", one.alias("n_windows"), one.alias("n_found"), zero.alias("n_slots"),
            F.lit(1.0).alias("consistency"), F.lit(False).alias("changed"),
        )
    )


def remove_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents in which no benchmark item is found."""
    ready(spark)
    found = leaks(docs, table(spark, folder, "benchmark"))
    gone_id, gone_key = fresh(docs, "gone_id", "gone_key")
    found = cut_lineage(found.select(F.col("doc_id").alias(gone_id), F.col("text_key").alias(gone_key)).distinct())
    same = F.col("doc_id").eqNullSafe(F.col(gone_id)) & (F.xxhash64("text") == F.col(gone_key))
    return docs.join(found, same, "left_anti")


@query("op3_decontaminate")
def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark item found in a document, with the share of its windows and how its slot values agree."""
    found = leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    share = F.col("n_found") / F.col("n_windows")
    return found.select("doc_id", "item_id", "n_windows", "n_found", share.alias("containment"), "n_slots", "consistency", "changed")
