"""Alignment of written and spoken tokens, classified and shown in context."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stenoloom.functions.nsw import CATEGORIES, classify
from stenoloom.functions.regex import tokens
from stenoloom.sources.lexicon import abbreviation_set

#: Longest written span that counts as a change, tokens of context on either side.
LONGEST, CONTEXT = 12, 5


def unequal(left: list[str], right: list[str]) -> list[tuple[int, int, int, int]]:
    """(a, z, j1, j2): what lies between the stretches that two lists of tokens have in common."""
    common = SequenceMatcher(None, left, right, autojunk=False).get_matching_blocks()
    ends = [(0, 0), *((m.a + m.size, m.b + m.size) for m in common)]
    return [(a, m.a, b, m.b) for (a, b), m in zip(ends, common) if a < m.a or b < m.b]


def parted(written: Column) -> Column:
    """Array of (piece, at) of written tokens: in lower case, final ? and ! apart from the word
    before them as in the spoken form, each with the place of its token."""
    def pieces(token: Column, at: Column) -> Column:
        low = F.lower(token)
        marks = F.regexp_extract(low, r"(?s)^.+?([?!]+)$", 1)
        word = F.substring(low, F.lit(1), F.length(low) - F.length(marks))
        return F.transform(F.filter(F.array(word, marks), lambda x: x != ""), lambda x: F.struct(x.alias("piece"), at.alias("at")))

    return F.flatten(F.transform(written, pieces))


def diffs(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, i1, i2, j1, j2, w, s): the differing stretches of each row of ``pairs`` (keys,
    written, spoken) between its written tokens w and spoken tokens s.

    The comparison is an Arrow pass that hands the tokens on; longer written stretches than
    LONGEST are left out, as they are no changes but lost alignments.
    """
    toks = pairs.select(*keys, tokens(F.col("written")).alias("w"), tokens(F.col("spoken")).alias("s")).withColumn("p", parted(F.col("w")))
    rows = toks.select(*keys, "w", "s", F.col("p.piece").alias("_piece"), F.col("p.at").alias("_at"))
    n = len(rows.columns)
    kind = pa.list_(pa.struct([(c, pa.int32()) for c in ("a", "z", "j1", "j2")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[dict(zip(("a", "z", "j1", "j2"), d)) for d in unequal(p or [], s or [])] for p, s in zip(b.column(n - 2).to_pylist(), b.column(n - 3).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, kind)], [*b.schema.names, "_d"])

    schema = T.StructType([*rows.schema.fields, T.StructField("_d", T.ArrayType(T.StructType([T.StructField(c, T.IntegerType()) for c in ("a", "z", "j1", "j2")])))])
    d, at = F.col("_d"), F.col("_at")
    first = F.coalesce(F.get(at, d["a"]), F.size("w"))  # past the last piece: past the last token
    after = F.when(d["z"] > d["a"], F.get(at, d["z"] - 1) + 1).otherwise(first)
    return rows.mapInArrow(run, schema).withColumn("_d", F.explode("_d")).select(
        *keys, first.cast("int").alias("i1"), after.cast("int").alias("i2"), d["j1"].alias("j1"), d["j2"].alias("j2"), "w", "s").where(F.col("i2") - F.col("i1") <= LONGEST)


def review_rows(pairs: DataFrame, keys: list[str], abbreviations: frozenset[str] | None = None) -> DataFrame:
    """(keys, at, category, span, spoken_span, before, after, spoken_before, spoken_after): every change with its class."""
    def cut_out(c: str, a, z):
        return F.array_join(F.slice(F.col(c), F.greatest(a, F.lit(0)) + 1, F.greatest(z - F.greatest(a, F.lit(0)), F.lit(0))), " ")

    i1, i2, j1, j2 = (F.col(c) for c in ("i1", "i2", "j1", "j2"))
    span = cut_out("w", i1, i2)
    held = abbreviation_set() if abbreviations is None else abbreviations
    return diffs(pairs, keys).select(
        *keys, i1.alias("at"), F.when(span == "", "Other").otherwise(classify(span, held)).alias("category"), span.alias("span"), cut_out("s", j1, j2).alias("spoken_span"),
        cut_out("w", i1 - CONTEXT, i1).alias("before"), cut_out("w", i2, i2 + CONTEXT).alias("after"),
        cut_out("s", j1 - CONTEXT, j1).alias("spoken_before"), cut_out("s", j2, j2 + CONTEXT).alias("spoken_after"))


def paired_turns(written: DataFrame, spoken: DataFrame) -> DataFrame:
    """(file_idx, turn_idx, raw_name, written, spoken) by place, of files with as many turns on either side."""
    n = lambda df, c: df.groupBy("file_idx").agg(F.count("*").alias(c))
    same = n(written, "a").join(n(spoken, "b"), "file_idx").where("a = b").select("file_idx")
    right = spoken.select("file_idx", "turn_idx", F.col("body").alias("spoken"))
    return written.join(same, "file_idx", "left_semi").join(right, ["file_idx", "turn_idx"]).select(
        "file_idx", "turn_idx", "raw_name", F.col("body").alias("written"), "spoken")


def review_sheet(rows: DataFrame, category: str, speaker: str = "raw_name") -> DataFrame:
    """The changes of one category as a sheet shows them: an absent side reads (empty), a turn is
    labelled with its speaker and number."""
    shown = lambda c: F.when(F.col(c) == "", "(empty)").otherwise(F.col(c))
    line = lambda b, m, a: F.trim(F.concat_ws(" ", *[F.nullif(F.col(c), F.lit("")) for c in (b, m, a)]))
    return rows.where(F.col("category") == category).select(
        "file_idx", "turn_idx", "at", shown("span").alias("written"), shown("spoken_span").alias("spoken"), line("before", "span", "after").alias("written_context"),
        line("spoken_before", "spoken_span", "spoken_after").alias("spoken_context"), F.concat(F.col(speaker), F.lit(" T"), F.col("turn_idx").cast("string")).alias("turn"))


def review_summary(rows: DataFrame) -> DataFrame:
    """(category, changes): every category, Other and TOTAL."""
    n = rows.groupBy("category").agg(F.count("*").alias("changes"))
    dim = rows.sparkSession.createDataFrame([(c,) for c in (*CATEGORIES, "Other")], "category string")
    full = F.broadcast(dim).join(n, "category", "left").fillna(0, ["changes"])
    return full.unionByName(full.agg(F.lit("TOTAL").alias("category"), F.sum("changes").alias("changes")))
