"""The modes of work, each a plan from page lines or turns to named tables.

Every mode returns its tables lazily; :func:`save` writes them as Parquet under their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stenoloom.functions.clean import COMMON_ABBREVIATIONS, cleaned, for_review, pre_clean
from stenoloom.functions.nsw import CATEGORIES
from stenoloom.functions.spoken import spoken_form
from stenoloom.operators import frequency as fq
from stenoloom.operators import review as rv
from stenoloom.operators import sentences as st
from stenoloom.operators import speakers as sp
from stenoloom.operators import turns as tn
from stenoloom.plans.durable import cut
from stenoloom.sources.lexicon import abbreviation_set


def summary(lines: DataFrame) -> dict[str, DataFrame]:
    """Structure of the files: overview per file and in total, noise by kind."""
    files = cut(tn.file_overview(lines))
    noise = tn.noise_counts(lines)
    return {"files": files, "overview": tn.overview_totals(files), "raw_speakers": tn.raw_speakers(tn.turns(lines, boilerplate=False)), "noise": noise, "noise_totals": noise.groupBy("kind").agg(F.sum("n").alias("n"))}


def extract(lines: DataFrame) -> dict[str, DataFrame]:
    """Raw turns with pre-cleaned bodies; empty turns are left out."""
    return {"turns": sp.with_alias(tn.turns(lines), "raw_name").withColumn("body", pre_clean(F.col("body"))).where("body <> ''")}


def dedup_names(turn_rows: DataFrame) -> dict[str, DataFrame]:
    """Speaker identities: mapping, statistics, matrix and review of the groups."""
    grouped = cut(sp.clusters(sp.names_of(turn_rows)))
    ids = cut(sp.speaker_ids(grouped))
    return {"mapping": ids.select("name", "spk_id"), "speakers": sp.speaker_sheet(turn_rows, ids),
            "matrix": sp.file_speaker_words(turn_rows, ids), "dedup_review": sp.dedup_review(grouped, ids)}


def corpus_totals(turn_rows: DataFrame, name: str = "raw_name") -> DataFrame:
    """One row: files, distinct raw speakers (before aliases), turns, words and characters of turns with a body."""
    said = turn_rows.where("body <> ''")
    return said.agg(F.count_distinct("file_idx").alias("files"), F.count_distinct(name).alias("speakers"), F.count("*").alias("turns"),
                    F.coalesce(F.sum(tn.words_of(F.col("body"))), F.lit(0)).alias("words"),
                    F.coalesce(F.sum(F.length(F.regexp_replace("body", r"[\n\r]", "")).cast("bigint")), F.lit(0)).alias("characters"))


def content_stats(turn_rows: DataFrame) -> dict[str, DataFrame]:
    """Characters, words, non-standard words and sentences of the bodies."""
    found = st.sentences(turn_rows, "body")
    nsw = cut(fq.nsw_frequency(turn_rows, "body").unionByName(
        st.dotted_abbreviations(turn_rows, "body").select(F.lit("Abbreviation").alias("category"), "token", "frequency")))
    return {"totals": corpus_totals(turn_rows), "overview": st.sentence_stats(found), "category_counts": st.sentence_categories(found),
            "character_frequency": fq.counted(fq.characters(turn_rows, "body"), "ch", 3), "word_frequency": fq.counted(fq.stripped_words(turn_rows, "body"), "word", 4),
            "nsw_frequency": nsw, "nsw_categories": fq.category_counts(nsw)}


def normalise(turn_rows: DataFrame, mapping: DataFrame) -> dict[str, DataFrame]:
    """The cleaned (V1) and the spoken (V3) turns under speaker ids, and the spoken word frequency.

    V1 is written before V3 is made from it, because both are results.
    """
    v1 = cut(sp.resolve(turn_rows, "raw_name", mapping).select("file_idx", "turn_idx", "spk_id", "mapped", cleaned(F.col("body")).alias("body")))
    v3 = cut(v1.withColumn("body", spoken_form(F.col("body"))))
    return {"v1": v1, "v3": v3, "word_frequency": fq.counted(fq.token_words(v3, "body"), "word")}


def align(written: DataFrame, spoken: DataFrame, prepared: bool = True) -> dict[str, DataFrame]:
    """Review of written against spoken turns; with ``prepared`` the written side is first brought
    near the spoken punctuation (raw turns), otherwise taken as it is (V1 turns)."""
    if prepared:
        written = written.withColumn("body", for_review(F.col("body"), abbreviation_set() | COMMON_ABBREVIATIONS))
    rows = cut(rv.review_rows(rv.paired_turns(written, spoken), ["file_idx", "turn_idx", "raw_name"]))
    return {"changes": rows, "summary": rv.review_summary(rows), **{f"sheet_{c}": rv.review_sheet(rows, c) for c in (*CATEGORIES, "Other")}}


def save(tables: dict[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
