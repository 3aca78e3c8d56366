"""Benchmark decontamination by template canonicalisation, in DataFrame operations only.

A text's numbers, units and names are replaced by typed placeholders; what is left, lower-
cased and without punctuation, is its template. Template windows of documents are hash-
joined with those of the benchmark, all of them; a window with few words that are no
placeholder is looked for by its literal words. Where they meet, the slots are compared: a
window with the benchmark's own values, or without slots, always counts. Windows with other
values count if each benchmark value stands for one document value in all of them in an
alignment, so a question whose numbers or names were changed is caught, and chance matches
of bare frames are not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.skew import join_small

from .common import materialize

WINDOW = 8
#: Words of a window that must be no placeholder; one with fewer is met by its literal words only.
FIXED_WORDS = 4
#: Up to so many benchmark windows (24 bytes each) are broadcast; beyond, both sides are shuffled.
BROADCAST_WINDOWS = 1_000_000
#: Marks before a slot's value; alone, the placeholder of its type.
NUMBER, NAME, UNIT = "\u0001", "\u0002", "\u0003"
#: Words that are units when they follow a number.
UNITS = (
    "mm cm m km in ft yd mi miles mile metres meters metre meter kilometres kilometers inches feet "
    "mg g kg t tons tonnes lb lbs oz pounds grams kilograms ml l litres liters gallons "
    "s sec seconds second min minutes minute h hours hour days day weeks week months month years year "
    "mph kph kmh percent dollars dollar euros euro cents cent usd eur degrees"
)


def marked_words(text: Column) -> Column:
    """The text's words, punctuation removed, slots' values after their mark."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), "[\u0001-\u0003]", " ")
    t = F.regexp_replace(t, r"(?<=[\p{L}\p{N},;] )(?=\p{Lu}\p{Ll})", NAME)
    t = F.regexp_replace(t, r"(?<![\p{L}\p{N}])(?=[0-9])", NUMBER)
    t = F.regexp_replace(t, "(\u0001[^\\s]+\\s+)(?=(?i:" + "|".join(UNITS.split()) + r")(?![\p{L}\p{N}]))", "$1" + UNIT)
    t = F.regexp_replace(t, "(?<![0-9])[^\\p{L}\\p{N}\u0001-\u0003\\s]+|[^\\p{L}\\p{N}\u0001-\u0003\\s]+(?![0-9])", "")
    return F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def word_codes(words: Column) -> Column:
    """Per marked word, the hash of its lower-cased literal with its mark (0: none) in the last two bits."""

    def code(w: Column) -> Column:
        literal = F.lower(F.when(w < "\u0004", F.substring(w, 2, 1 << 30)).otherwise(w))
        mark = F.when(w < "\u0004", F.ascii(w)).otherwise(F.lit(0))
        return F.shiftleft(F.xxhash64(literal), 2).bitwiseOR(mark.cast("long"))

    return F.transform(words, code)


def _windows(rows: DataFrame, key: str, words: Column) -> DataFrame:
    """(key, at, _hash): the windows of marked words, from 1; a shorter text is one window.

    A word is hashed once, and a window from its words' codes after the rows are exploded:
    there Spark compiles the expressions, which it does not do inside a lambda."""
    coded = rows.select(key, word_codes(words).alias("_codes"))
    n = F.size("_codes")
    # No sequence, hence no row, for a text without words.
    starts = F.when(n > 0, F.sequence(F.lit(1), F.greatest(F.lit(1), n - (WINDOW - 1))))
    found = coded.select(key, "_codes", F.explode(starts).alias("at"))
    codes = [F.get("_codes", F.col("at") + (i - 1)) for i in range(WINDOW)]  # null behind a short text
    marks = [c.bitwiseAND(F.lit(3).cast("long")) for c in codes]
    template = F.xxhash64(*[F.when(m == 0, c).otherwise(m) for c, m in zip(codes, marks)])
    literal = F.xxhash64(F.lit("literal"), *[c.bitwiseAND(F.lit(-4).cast("long")) for c in codes])
    fixed = sum((F.when(m == 0, 1).otherwise(0) for m in marks), F.lit(0))
    whole = fixed >= F.least(F.lit(FIXED_WORDS), n)
    return found.select(key, "at", F.when(whole, template).otherwise(literal).alias("_hash"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(doc_id, item_id, n_windows, kind): the documents that hold a passage of an item,
    with the benchmark windows found, and whether verbatim or reparameterised (other
    values in its slots).

    Any passage of WINDOW template words is found, if FIXED_WORDS of them are no placeholder
    or it is verbatim. A text with fewer words than
    a window is one window, met only by an equal template. Null and empty texts, and rows
    without id, hold nothing. Repeated rows count once. Ids pass through as they are.
    """
    items = benchmark.select(F.col(item_id).alias("_item"), F.col(item_text).alias("_text")).filter("_item IS NOT NULL")
    item_words = items.select("_item", marked_words(F.col("_text")).alias("_words"))
    # A capital after a word makes a name: within a document, an item's first word may be one.
    named = item_words.filter(F.get("_words", F.lit(0)).rlike(r"^\p{Lu}\p{Ll}"))
    named = named.select("_item", F.transform("_words", lambda w, i: F.when(i == 0, F.concat(F.lit(NAME), w)).otherwise(w)).alias("_words"))
    probes = _windows(item_words.unionByName(named), "_item", F.col("_words")).select("_item", F.col("at").alias("_item_at"), "_hash")
    probes = materialize(probes.distinct(), "benchmark-windows")
    if probes.count() <= BROADCAST_WINDOWS:
        probes = F.broadcast(probes)
    own = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text")).filter("_doc IS NOT NULL")
    windows = _windows(own, "_doc", marked_words(F.col("_text"))).withColumnRenamed("at", "_at")
    met = windows.join(probes, "_hash").select("_doc", "_item", "_at", "_item_at")
    met = materialize(met.distinct(), "met-windows")

    # The slots of the windows that met, from the few texts that hold them.
    held = materialize(met.select("_doc").distinct(), "held")
    doc_words = join_small(own, held, "_doc").select("_doc", marked_words(F.col("_text")).alias("_words")).distinct()
    both = met.join(doc_words, "_doc").join(item_words.withColumnRenamed("_words", "_item_words").distinct(), "_item")
    slot = F.arrays_zip(
        F.slice("_item_words", F.col("_item_at"), WINDOW).alias("a"), F.slice("_words", F.col("_at"), WINDOW).alias("b")
    )

    def bare(w: Column) -> Column:
        return F.lower(F.when(w < "\u0004", F.substring(w, 2, 1 << 30)).otherwise(w))

    # Hash collisions and rows with one id but other texts end here: slots of one type or equal words.
    same = F.forall(slot, lambda p: ((p["a"] < "\u0004") & (F.substring(p["a"], 1, 1) == F.substring(p["b"], 1, 1))) | (bare(p["a"]) == bare(p["b"])))
    values = F.filter(slot, lambda p: p["a"] < "\u0004")
    both = both.select("_doc", "_item", "_at", "_item_at", same.alias("_same"), values.alias("_values")).filter(F.coalesce("_same", F.lit(False)))
    aligned = both.withColumn("_shift", F.col("_at") - F.col("_item_at"))
    aligned = aligned.withColumn("_equal", F.forall("_values", lambda v: F.lower(v["a"]) == F.lower(v["b"])))
    shifts = aligned.groupBy("_doc", "_item", "_shift").agg(
        F.countDistinct("_item_at").alias("n"),
        F.countDistinct(F.when(F.col("_equal"), F.col("_item_at"))).alias("_n_equal"),
        F.max(~F.col("_equal")).alias("_other"),
    )
    slots = aligned.filter("NOT _equal").select("_doc", "_item", "_shift", F.explode("_values").alias("v")).distinct()
    slots = slots.groupBy("_doc", "_item", "_shift", "v.a").agg(F.count("*").alias("_n"))
    slots = slots.groupBy("_doc", "_item", "_shift").agg(F.max("_n").alias("_most"))
    found = shifts.join(slots, ["_doc", "_item", "_shift"], "left")
    found = found.withColumn("n", F.when(F.coalesce("_most", F.lit(1)) == 1, F.col("n")).otherwise(F.col("_n_equal"))).filter("n > 0")
    kind = F.when(F.min("_other"), "reparameterised").otherwise("verbatim")
    return found.groupBy(F.col("_doc").alias(doc_id), F.col("_item").alias(item_id)).agg(F.sum("n").alias("n_windows"), kind.alias("kind"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **columns: str) -> DataFrame:
    """``docs`` without the documents that ``contamination`` names; rows without id stay."""
    doc_id = columns.get("doc_id", "doc_id")
    found = contamination(docs, benchmark, **columns).select(doc_id).distinct()
    return join_small(docs, found, doc_id, "left_anti")
