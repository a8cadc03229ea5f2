"""Operator 8, quality rules: line-first cleaning, in DataFrame functions only.

Every line is judged by itself on punctuation, navigation and boilerplate; failing lines go, and a document that
loses too much of its text goes as a whole. All of it is per-row expressions: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm.common import WORD, table

SYMBOLS = "#*$%&|<>"
#: Phrases of navigation and of boilerplate, matched in lower case anywhere in a short line.
NAVIGATION = ["home", "menu", "next page", "previous page", "back to top", "read more", "click here", "sign in", "log in", "skip to content"]
BOILERPLATE = ["all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "accept cookies", "javascript is disabled", "lorem ipsum"]
SHORT_LINE = 12
MOST_LOST = 0.5
MOST_SYMBOLS_PER_WORD = 0.2
MOST_BANGS_PER_WORD = 0.3
#: Repeated hashes of a text that are looked up one by one.
FEW = 64


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def line_fails(line: Column) -> Column:
    """Whether a line with a word goes: symbols or exclamation marks through most words, separators of navigation, or a short line of boilerplate."""
    n = F.regexp_count(line, F.lit(WORD))
    symbols = F.regexp_count(line, F.lit(r"[#*$%&|<>]"))
    bangs = F.regexp_count(line, F.lit(r"[!?]{2,}"))
    phrase = F.lower(line).rlike(r"(?U)\b(" + "|".join(NAVIGATION + BOILERPLATE) + r")\b")
    return (symbols > n * MOST_SYMBOLS_PER_WORD) | (bangs > n * MOST_BANGS_PER_WORD) | ((n <= SHORT_LINE) & phrase)


def clean_lines(text: Column) -> Column:
    """Struct kept (array of the lines that pass) and the words of all and of passing lines."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    return F.filter(lines, lambda x: ~(x.rlike(WORD) & line_fails(x)))


def judge(docs: DataFrame, text: str = "text", most_lost: float = MOST_LOST) -> DataFrame:
    """``docs`` with the columns n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lost_words, base_failed, kept, clean_text.

    Columns of ``docs`` with one of these names are replaced. Null and empty texts have no words: 0 in every count,
    base_failed true, kept false, clean_text "". Each row is judged by itself, so repeated rows get equal results.
    A repeated window of three words counts all words that any of its copies covers.
    """
    ours = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_words", "base_failed", "kept", "clean_text"]
    rest = [c for c in docs.columns if c not in ours]
    t = F.coalesce(F.col(text), F.lit(""))
    # an expression that a lambda reads is a column of its own, read twice or more, so that it is computed once a row
    a = docs.select(*rest, words(t).alias("__w"), F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD)).alias("__lines"))
    n = F.size("__w")
    w = F.col("__w")
    a = a.select(
        *rest,
        F.col("__lines"),
        n.cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        w,
    )
    h, d, i = F.col("__h"), F.col("__d"), F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0)))
    a = a.withColumn("__h", F.when(n >= 3, F.zip_with(F.zip_with(F.slice(w, 1, n - 2), F.slice(w, 2, n - 2), lambda x, y: F.xxhash64(x, y)), F.slice(w, 3, n - 2), lambda x, y: F.xxhash64(x, y))).otherwise(F.array().cast("array<bigint>")))
    a = a.withColumn("__d", F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(h)))
    twice = F.zip_with(F.slice(d, 1, F.size(d) - 1), F.slice(d, 2, F.size(d) - 1), lambda x, y: F.when(x == y, x))
    a = a.withColumn("__d", F.when(F.size(d) > 0, F.array_distinct(F.array_compact(twice))))
    # only windows whose hash repeats are compared as words; all of them where that is cheaper than to look each up
    a = a.withColumn("__i", F.when(F.size(d) <= FEW, F.filter(i, lambda x: F.array_contains(d, F.get(h, x)))).when(d.isNotNull(), i))
    a = a.withColumn("__s", F.sort_array(F.transform("__i", lambda x: F.struct(F.get(w, x).alias("a"), F.get(w, x + 1).alias("b"), F.get(w, x + 2).alias("c"), x.alias("p")))))
    s = F.col("__s")
    after = F.slice(s, 2, F.greatest(F.size(s) - 1, F.lit(0)))
    a = a.withColumn("__pairs", F.filter(F.arrays_zip(s.alias("x"), after.alias("y")), lambda z: (z["x"]["a"] == z["y"]["a"]) & (z["x"]["b"] == z["y"]["b"]) & (z["x"]["c"] == z["y"]["c"])))
    a = a.withColumn("__p", F.sort_array(F.array_distinct(F.concat(F.transform("__pairs", lambda z: z["x"]["p"]), F.transform("__pairs", lambda z: z["y"]["p"])))))
    p = F.col("__p")
    gaps = F.zip_with(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0))), lambda x, y: F.least(x - y, F.lit(3)))
    repeat = F.when(F.size(p) > 0, F.aggregate(gaps, F.lit(3), lambda acc, x: acc + x)).otherwise(0).cast("long")
    a = a.withColumn("n_repeat_words", F.coalesce(repeat, F.lit(0).cast("long")))
    a = a.withColumn("__bad", F.filter("__lines", line_fails))
    a = a.withColumn("lost_words", F.regexp_count(F.array_join("__bad", "\n"), F.lit(WORD)).cast("long"))
    a = a.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    a = a.withColumn("kept", ~F.col("base_failed") & (F.col("lost_words") <= F.col("n_words") * most_lost))
    return a.withColumn("clean_text", F.when(F.size("__bad") > 0, F.array_join(clean_lines(F.col(text)), "\n")).otherwise(t)).drop("__lines", "__w", "__h", "__d", "__i", "__s", "__pairs", "__p", "__bad")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_words")
