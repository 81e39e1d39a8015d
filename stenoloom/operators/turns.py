"""Page lines into speaker turns, noise and segment statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stenoloom.functions.regex import tokens
from stenoloom.operators.order import running_total

# Kinds of layout lines in the order in which they are tried, and the label of a page line.
NOISE = {
    "watermark": r"^\s*Transcribed by TERES\s*$",
    "line_number": r"^\s*\d+\s*$",
    "timestamp": r"^\s*\d{1,2}:\d{2}\s*[AP]M\s*IST\s*$",
    "email": r"^\s*\S+@\S+\.\S+\s*$",
}
BOILERPLATE = r"(?i)END\s+OF\s+DAY'?S?\s+PROCEEDINGS"
PAGE_LABEL = r"^([A-Z][A-Z0-9 .\-']+?):\s*(.*)"
TEXT_LABEL = r"^([A-Z][A-Z0-9 .\-']+):\s*$"
UNUSUAL = "[^A-Z '.]"


def noise_type(line: Column) -> Column:
    """The first kind of layout line that fits, else null."""
    out = None
    for kind, pattern in NOISE.items():
        out = (F if out is None else out).when(line.rlike(pattern), kind)
    return out


def page_lines(raw: DataFrame) -> DataFrame:
    """Lines once each, trimmed, without blank ones; (file_idx, page_idx, line_no, line).

    Of lines with an equal key and different text the smaller text stays; rows without a key are left out.
    """
    line = F.regexp_replace("line", r"(?U)^\s+|\s+$", "")
    return raw.select("file_idx", "page_idx", "line_no", line.alias("line")).where(
        "file_idx is not null and page_idx is not null and line_no is not null and line <> ''"
    ).groupBy("file_idx", "page_idx", "line_no").agg(F.min("line").alias("line"))


def labelled_lines(raw: DataFrame, boilerplate: bool = True) -> DataFrame:
    """Lines of speech with the number of the turn they belong to (0 before the first label),
    (file_idx, page_idx, line_no, line, is_label, raw_name, rest, turn_idx)."""
    lines = page_lines(raw).where(noise_type(F.col("line")).isNull())
    if boilerplate:
        lines = lines.where(~F.col("line").rlike(BOILERPLATE))
    lines = lines.withColumn("is_label", F.col("line").rlike(PAGE_LABEL)).withColumn(
        "raw_name", F.when(F.col("is_label"), F.trim(F.regexp_extract("line", PAGE_LABEL, 1)))).withColumn(
        "rest", F.when(F.col("is_label"), F.regexp_extract("line", PAGE_LABEL, 2)).otherwise(F.col("line")))
    return running_total(lines, "file_idx", "page_idx", "line_no", F.col("is_label"), "turn_idx")


def turns(raw: DataFrame, boilerplate: bool = True) -> DataFrame:
    """(file_idx, turn_idx, raw_name, body): the turns in order, empty ones too."""
    said = labelled_lines(raw, boilerplate).where("turn_idx > 0")
    piece = F.when(F.col("rest") != "", F.struct("page_idx", "line_no", "rest"))
    return said.groupBy("file_idx", "turn_idx").agg(
        F.max("raw_name").alias("raw_name"),
        F.array_join(F.transform(F.sort_array(F.collect_list(piece)), lambda x: x["rest"]), " ").alias("body"))


def noise_counts(raw: DataFrame) -> DataFrame:
    """(file_idx, kind, n) of layout lines."""
    return page_lines(raw).withColumn("kind", noise_type(F.col("line"))).where("kind is not null").groupBy("file_idx", "kind").agg(F.count("*").alias("n"))


def words_of(body: Column) -> Column:
    return F.size(tokens(body)).cast("bigint")


def speaker_file_words(turn_rows: DataFrame, name: str = "raw_name") -> DataFrame:
    """(file_idx, speaker, words, turns): words of each speaker in each file; turns without words count as turns."""
    return turn_rows.groupBy("file_idx", F.col(name).alias("speaker")).agg(F.sum(words_of(F.col("body"))).alias("words"), F.count("*").alias("turns"))


def segment_range(turn_rows: DataFrame, name: str = "raw_name") -> DataFrame:
    """(speaker, words, files, shortest, longest) over segments with words."""
    return turn_rows.withColumn("w", words_of(F.col("body"))).where("w > 0").groupBy(F.col(name).alias("speaker")).agg(
        F.sum("w").alias("words"), F.count_distinct("file_idx").alias("files"), F.min("w").alias("shortest"), F.max("w").alias("longest"))


def file_overview(raw: DataFrame) -> DataFrame:
    """(file_idx, pages, words, turns, speakers, unusual_speakers, unusual_names) of each file; the last
    holds the names with characters that names seldom have, in order, parted by semicolons."""
    lines = page_lines(raw)
    pages = lines.groupBy("file_idx").agg(F.count_distinct("page_idx").alias("pages"))
    t = turns(raw, boilerplate=False)
    said = t.groupBy("file_idx").agg(
        F.sum(words_of(F.col("body"))).alias("words"), F.count("*").alias("turns"), F.count_distinct("raw_name").alias("speakers"),
        F.sort_array(F.collect_set(F.when(F.col("raw_name").rlike(UNUSUAL), F.col("raw_name")))).alias("names"))
    said = said.withColumns({"unusual_speakers": F.size("names").cast("bigint"), "unusual_names": F.array_join("names", "; ")}).drop("names")
    zero = {c: 0 for c in ("words", "turns", "speakers", "unusual_speakers")}
    return pages.join(said, "file_idx", "left").fillna(zero).fillna({"unusual_names": ""})


def raw_speakers(turn_rows: DataFrame) -> DataFrame:
    """One row: the distinct raw names that say anything, before aliases."""
    return turn_rows.where(words_of(F.col("body")) > 0).agg(F.count_distinct("raw_name").alias("raw_speakers"))


def overview_totals(overview: DataFrame) -> DataFrame:
    """One row: files, sum, least, most and average of pages, sums of words and turns."""
    return overview.agg(
        F.count("*").alias("files"), F.sum("pages").alias("pages"), F.min("pages").alias("min_pages"), F.max("pages").alias("max_pages"),
        F.round(F.avg("pages"), 4).alias("avg_pages"), F.sum("words").alias("words"), F.sum("turns").alias("turns"))
