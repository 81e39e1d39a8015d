"""Frequency of every distinct term, by compressed record bitmaps in vertical layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def clean_term(category, token):
    """The form under which a token is compared (see :func:`term_statistics`)."""
    word = F.regexp_replace(F.lower(token), r"^[^\p{L}']+|[^\p{L}']+$", "")
    other = F.regexp_replace(token, r"(?U)^\s+|\s+$", "")
    return F.when(category == "Word", word).otherwise(other)


def term_bitmaps(freq: DataFrame) -> DataFrame:
    """(category, token, block, bits, total): the vertical layout of the collection.

    One row for each term and each block of 64 file numbers in which it occurs: ``bits`` is
    the bitmap of those files, ``total`` the occurrences beside it.  Blocks without a file take
    no room, which is the compression; two layouts merge by ``bit_or`` of ``bits`` and ``sum``
    of ``total`` over (category, token, block).  A term in every file is spread over as many
    rows as there are blocks, so no task ever holds one term's whole file list.
    """
    rows = freq.select("file_idx", "category", "token", "frequency", "loaded_at").where(
        "file_idx is not null and token is not null")
    latest = (
        rows.groupBy("file_idx", "category", "token")
        .agg(F.max(F.struct("loaded_at", "frequency")).alias("last"))
        .where("last.frequency >= 1")
        .select("file_idx", "category", clean_term(F.col("category"), F.col("token")).alias("token"), F.col("last.frequency").alias("n"))
        .where("token <> ''")
    )
    return latest.groupBy("category", "token", F.expr("shiftright(file_idx, 6)").alias("block")).agg(
        F.bit_or(F.expr("shiftleft(1L, file_idx & 63)")).alias("bits"), F.sum("n").alias("total"))


def term_statistics(freq: DataFrame, rare_total: int = 3, common_share: float = 0.5) -> DataFrame:
    """(category, token, total, files, mark) of every distinct term of the collection.

    ``freq`` has file_idx, category, token, frequency, loaded_at; other columns are not read.
    Of each (file_idx, category, token) the row with the latest loaded_at counts (null is the
    oldest; of rows of one time the higher frequency); rows without token or file, or whose
    counting row has no frequency of at least 1, are dropped.  Tokens of category ``Word`` are
    compared in lower case, without anything but letters and ``'`` at their ends, others
    without surrounding white space; what is then empty is dropped.  ``mark`` is ``common``
    above ``common_share`` of all files of ``freq``, else ``rare`` below a total of
    ``rare_total`` or in one file only, else null.  A null category is a category of its own.
    An empty table gives no rows.
    """
    bitmaps = term_bitmaps(freq)
    n_files = freq.agg(F.count_distinct("file_idx").alias("n_files"))
    terms = bitmaps.groupBy("category", "token").agg(
        F.sum("total").alias("total"), F.sum(F.bit_count("bits")).cast("bigint").alias("files"))
    return terms.crossJoin(F.broadcast(n_files)).select(
        "category", "token", "total", "files",
        F.when(F.col("files") > common_share * F.col("n_files"), "common")
        .when((F.col("total") < rare_total) | (F.col("files") == 1), "rare").alias("mark"))
