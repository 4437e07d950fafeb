"""Quality rules over lines: lines that fail are removed, and documents that lose too much text or
fail a whole-text rule are rejected. Column expressions only."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from .text import let, spare, words

#: Fixed values of the rules.
SYMBOLS = r"[#*$%&|<>]"
WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 8, 20, 30
#: A document is rejected when more than this percentage of its characters is in removed lines.
MAX_LOST_PERCENT = 50
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy",
    "uses cookies", "enable javascript", "click here", "read more", "sign up", "log in",
    "subscribe to", "lorem ipsum",
)
_PHRASE = rf"(?<![\p{{L}}\p{{M}}\p{{N}}])(?:{'|'.join(BOILERPLATE)})(?![\p{{L}}\p{{M}}\p{{N}}])"
#: Marks of any script: ASCII ones, and all other punctuation but bullets, daggers and section signs.
SENTENCE_MARKS = r"[.,;:!?]|[\p{Po}&&[^\x00-\x7F•·§¶†‡‰‱※]]"


def repeated_words(found: Column, window: int = WINDOW) -> Column:
    """How many of the words are covered by a ``window``-word sequence (2, 4, 8, ...) found twice or
    more.

    Windows are compared by 64-bit hashes. Where none repeats, nothing is sorted. Otherwise equal
    windows meet by sorting, and the covered words are counted along the sorted places, so the work
    is that of a sort however often a text repeats itself.
    """
    def covered(starts: Column) -> Column:
        step = F.zip_with(starts, F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))),
                          lambda here, after: F.least(F.lit(window),
                                                      F.coalesce(after - here, F.lit(window))))
        return F.aggregate(step, F.lit(0), lambda total, x: total + x)

    def by_place(ordered: Column) -> Column:
        same = lambda x, k: F.get(ordered, k)["h"] == x["h"]
        twice = F.filter(ordered, lambda x, k: F.coalesce(same(x, k - 1), F.lit(False))
                         | F.coalesce(same(x, k + 1), F.lit(False)))
        return let(F.array_sort(F.transform(twice, lambda x: x["i"])), covered)

    def by_hash(hashes: Column) -> Column:
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            let(F.sort_array(placed), by_place))

    def joined(step: int):
        # hashes of sequences twice as long, from those that start here and ``step`` words later
        return lambda hashes: F.zip_with(
            F.slice(hashes, 1, F.size(hashes) - step),
            F.slice(hashes, 1 + step, F.size(hashes) - step), lambda a, b: F.xxhash64(a, b))

    hashes = F.transform(found, lambda word: F.xxhash64(word))
    step = 1
    while step < window:
        hashes = let(hashes, joined(step))
        step *= 2
    return F.when(F.size(found) <= window, F.lit(0)).otherwise(let(hashes, by_hash)).cast("bigint")


def line_fails(line: Column) -> Column:
    """Whether a line is no running text. A blank line passes."""
    size = F.length(line)
    many = lambda chars, n: line.rlike(f"(?:{chars}[^{chars[1:]}*+){{{n}}}")
    # punctuation: no letter in lower case among many, marks after almost every word, or a long
    # line without any mark
    shouts = ~line.rlike(r"\p{Ll}") & line.rlike(r"(?:\p{Lu}\P{Lu}*+){10}")
    exclaims = many("[!?]", 3) & (F.regexp_count(line, F.lit("[!?]")) * 15 > size)
    symbols = many(SYMBOLS, 3) & (F.regexp_count(line, F.lit(SYMBOLS)) * 15 > size)
    unmarked = (size > 200) & ~line.rlike(SENTENCE_MARKS)
    # navigation: short entries between bars, arrows or bullets
    bar = "[|»›•·]"
    menu = many(bar, 3) & (F.regexp_count(line, F.lit(bar)) * 40 > size)
    # boilerplate: known phrases, as whole words, that make over an eighth of the line, and words
    # said twice in a row
    said = lambda low: F.length(low) - F.length(F.regexp_replace(low, _PHRASE, ""))
    known = let(F.lower(line), lambda low: reduce(
        or_, [F.contains(low, F.lit(phrase)) for phrase in BOILERPLATE]) & (said(low) * 8 > size))
    doubled = r" ([^ ]++) \1(?![^ ])"
    pairs = F.regexp_count(line, F.lit(doubled))
    stutters = (pairs >= 2) & (pairs * 30 > size)
    return shouts | exclaims | symbols | unmarked | menu | known | stutters


def quality(docs: DataFrame, name: str = "__quality") -> DataFrame:
    """All columns of ``docs``, then a struct ``name`` with the counts and the verdict.

    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lost_chars, base_failed, kept``;
    ``cleaned`` is the text without the lines that fail. A null or empty text has no words and
    fails. Every row is judged on its own, so ties, repeated rows and null ids change nothing.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    own = [F.col(f"`{c}`").alias(f"__doc_{i}") for i, c in enumerate(docs.columns)]
    counted = docs.select(
        *own, text.alias("text"), words(text).alias("words"), F.split(text, "\n").alias("lines"))
    kept = [f"__doc_{i}" for i in range(len(own))]
    measured = counted.select(
        *kept, F.length("text").alias("n_chars"),
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        let(F.filter("lines", lambda x: x.rlike(r"[^ \t-\r]")),
            lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.array_join(F.filter("lines", lambda x: ~line_fails(x)), "\n").alias("cleaned"))
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    lost = F.col("n_chars") - F.length("cleaned")
    judged = measured.withColumn("base_failed", base_failed).withColumn("lost_chars", lost)
    return judged.select(*(F.col(k).alias(c) for k, c in zip(kept, docs.columns)), F.struct(
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_chars",
        "base_failed",
        (~F.col("base_failed")
         & (100 * F.col("lost_chars") <= MAX_LOST_PERCENT * F.col("n_chars"))).alias("kept"),
        "cleaned").alias(name))


def op4_quality(spark, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return quality(docs).select("doc_id", *(f"__quality.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept")))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that pass, with ``text`` without the lines that fail."""
    name = spare(docs.columns, "judged")
    judged = quality(docs, name).filter(F.col(f"{name}.kept"))
    return judged.withColumn("text", F.col(f"{name}.cleaned")).drop(name)
