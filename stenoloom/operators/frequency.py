"""Frequencies of words, characters and non-standard words, and their ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stenoloom.functions.nsw import CATEGORIES, scan
from stenoloom.functions.regex import tokens
from stenoloom.operators.order import with_rank

# Fixed value: what is stripped from the ends of a word.
STRIP = r"^[^a-zA-Z'’]+|[^a-zA-Z'’]+$"


def counted(values: DataFrame, column: str, percent_digits: int | None = None, ranked: bool = True) -> DataFrame:
    """(rank, ``column``, frequency[, percent]), the most frequent first, of equals the smaller value."""
    n = values.groupBy(column).agg(F.count("*").alias("frequency"))
    if percent_digits is not None:
        total = n.agg(F.sum("frequency").alias("_t"))
        n = n.crossJoin(F.broadcast(total)).withColumn("percent", F.round(100.0 * F.col("frequency") / F.col("_t"), percent_digits)).drop("_t")
    return with_rank(n, F.desc("frequency"), F.asc(column)) if ranked else n


def token_words(texts: DataFrame, text: str) -> DataFrame:
    """Pieces between white space in lower case, punctuation included."""
    return texts.select(F.explode(tokens(F.lower(text))).alias("word"))


def stripped_words(texts: DataFrame, text: str) -> DataFrame:
    """Words in lower case without other characters than letters and apostrophes at their ends."""
    return texts.select(F.explode(tokens(F.lower(text))).alias("w")).select(F.regexp_replace("w", STRIP, "").alias("word")).where("word <> ''")


def characters(texts: DataFrame, text: str) -> DataFrame:
    """Every character but line ends."""
    return texts.select(F.explode(F.split(text, "")).alias("ch")).where(~F.col("ch").isin("", "\n", "\r"))


def nsw_tokens(texts: DataFrame, text: str) -> DataFrame:
    """(category, token) of every non-standard word."""
    return scan(texts, text)


def nsw_frequency(texts: DataFrame, text: str) -> DataFrame:
    """(category, token, frequency), case preserved."""
    return nsw_tokens(texts, text).groupBy("category", "token").agg(F.count("*").alias("frequency"))


def category_counts(found: DataFrame, categories: tuple[str, ...] = CATEGORIES) -> DataFrame:
    """(category, occurrences, distinct_tokens) of every category, those with none too."""
    spark = found.sparkSession
    dim = spark.createDataFrame([(c,) for c in categories], "category string")
    n = found.groupBy("category").agg(F.sum("frequency").alias("occurrences"), F.count("*").alias("distinct_tokens"))
    return F.broadcast(dim).join(n, "category", "left").fillna(0, ["occurrences", "distinct_tokens"])


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.round(F.when(whole > 0, 100.0 * part / whole).otherwise(0.0), digits)
