"""Sentence statistics with a rule-based splitter.

The reference parses sentences with a statistical model that is not available here; these
rules are an approximation and their figures are no parity figures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stenoloom.functions.nsw import SENTENCE_PATTERNS
from stenoloom.functions.regex import tokens

#: Words before a period that do not end a sentence.
GUARD = "mr mrs ms dr prof hon smt vs v no nos art sec cl sch pt vol p pp para rs ltd govt cf st".split()
#: Forms of auxiliaries and frequent verbs; a sentence without any, or without a word in -ed, -es, -ing, counts as partial.
VERBS = ("is are was were be been am has have had do does did will would shall should can could may might must says say said put take come turn see read "
         "let rest rely told finish").split()


def sentences(texts: DataFrame, text: str) -> DataFrame:
    """(sentence, words): split after final marks before white space, of at least two words."""
    guard = "|".join(GUARD)
    # a period that belongs to an abbreviation or an initial is set aside while splitting
    kept = F.regexp_replace(text, rf"(?i)(?<![A-Za-z])({guard}|[A-Z]|[a-z]\.[a-z])\.(?=\s)", "$1\u0001")
    pieces = F.split(kept, r"(?<=[.?!])[\"'”’)]?\s+|\n\s*\n")
    out = texts.select(F.explode(pieces).alias("s")).select(F.trim(F.replace(F.col("s"), F.lit("\u0001"), F.lit("."))).alias("sentence"))
    words = F.size(F.filter(tokens(F.col("sentence")), lambda w: w.rlike(r"[\p{L}\p{N}]")))
    return out.withColumn("words", words).where("words >= 2")


def sentence_stats(found: DataFrame) -> DataFrame:
    """One row: complete and partial sentences, their shares, average and largest lengths."""
    verb = F.col("sentence").rlike(r"(?i)\b(?:" + "|".join(VERBS) + r"|\w+(?:ed|es|ing|ises))\b")
    rows = found.withColumn("partial", F.col("sentence").rlike(r"\.\.\.\s*$") | ~verb)
    def of(cond, kind):
        n = F.sum(F.when(cond, 1).otherwise(0))
        w = F.when(cond, F.col("words"))
        return [n.cast("bigint").alias(kind), F.coalesce(F.round(100.0 * n / F.count("*"), 1), F.lit(0.0)).alias(f"{kind}_percent"),
                F.coalesce(F.round(F.avg(w), 1), F.lit(0.0)).alias(f"{kind}_average"), F.coalesce(F.max(w), F.lit(0)).cast("bigint").alias(f"{kind}_longest")]
    return rows.agg(F.count("*").alias("total"), *of(~F.col("partial"), "complete"), *of(F.col("partial"), "partial"))


def sentence_categories(found: DataFrame) -> DataFrame:
    """(category, sentences, percent): sentences that hold a numeral, date, time, year or measure."""
    one = found.agg(F.count("*").alias("total"), *[
        F.coalesce(F.sum(F.col("sentence").rlike(p).cast("bigint")), F.lit(0)).alias(k) for k, p in SENTENCE_PATTERNS.items()])
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("category"), F.col(k).alias("sentences")) for k in SENTENCE_PATTERNS])).alias("x")
    return one.select("total", rows).select("x.category", "x.sentences", F.round(F.when(F.col("total") > 0, 100.0 * F.col("x.sentences") / F.col("total")).otherwise(0.0), 1).alias("percent"))


def dotted_abbreviations(texts: DataFrame, text: str) -> DataFrame:
    """(token, frequency) of words that keep a period inside a sentence, but capitals with dots only."""
    words = texts.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(r"(?<![\w.])([A-Za-z][A-Za-z'.]*\.)(?=\s+[a-z0-9(]|,)"), F.lit(1))).alias("token"))
    return words.where((F.length("token") > 2) & ~F.col("token").rlike(r"^[A-Z.]+$|\.\.")).groupBy("token").agg(F.count("*").alias("frequency"))
