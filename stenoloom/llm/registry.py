"""Queries of this subpackage over whole tables, and the SQL that checks them where SQL can."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stenoloom.llm.bpe_lexicon import encode
from stenoloom.llm.components import connected_groups
from stenoloom.llm.golden_record import PLACEHOLDERS, golden_records
from stenoloom.llm.golden_record import TITLES as NAME_TITLES
from stenoloom.llm.language_id import stretches, wrong_labels
from stenoloom.llm.leakage import leaks
from stenoloom.llm.name_variants import name_groups, name_pairs
from stenoloom.llm.page_repair import page_findings, page_paragraphs
from stenoloom.llm.sentences import sentence_ends
from stenoloom.llm.speaker_turns import pauses, speaker_turns
from stenoloom.llm.term_frequency import term_statistics
from stenoloom.sources.tables import table

TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


def p1_turns(spark: SparkSession, folder: str) -> DataFrame:
    return speaker_turns(table(spark, folder, "transcript_original"), table(spark, folder, "speakers"))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return p1_turns(spark, folder).select("file_idx", "page_idx", "line_no", "spk_id")


def p1_pauses(spark: SparkSession, folder: str) -> DataFrame:
    return pauses(table(spark, folder, "transcript_original"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return golden_records(table(spark, folder, "speaker_records")).select("grp", "speaker_name", "total_words")


def p3_terms(spark: SparkSession, folder: str) -> DataFrame:
    return term_statistics(table(spark, folder, "term_freq"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return p3_terms(spark, folder).where("mark is not null").select("category", "token", "mark")


def p4_groups(spark: SparkSession, folder: str) -> DataFrame:
    return name_groups(table(spark, folder, "speaker_aliases"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return name_pairs(table(spark, folder, "speaker_aliases"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    links = table(spark, folder, "speaker_links")
    return connected_groups(links, "left_speaker_id", "right_speaker_id", F.col("is_match") == 1).select(
        F.col("id").alias("speaker_id"), "group_id")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return page_findings(table(spark, folder, "scanned_pages"), table(spark, folder, "wordlist"), "transcript_original")


def p6_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    return page_paragraphs(table(spark, folder, "scanned_pages"), table(spark, folder, "wordlist"), "transcript_original")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return sentence_ends(table(spark, folder, "transcript_turns"), "turn_id", "transcript_original", "lang").distinct()


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode(table(spark, folder, "documents"), "doc_id", "text", f"{TOKENIZERS}/byte_bpe_50k.tiktoken")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaks(table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "eval_items"), "item_id", "text")


def p10_stretches(spark: SparkSession, folder: str) -> DataFrame:
    return stretches(table(spark, folder, "documents"), "doc_id", "text", "lang")


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return wrong_labels(table(spark, folder, "documents"), "doc_id", "text", "lang")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [p1_turns, p1_found, p1_pauses, p2_found, p3_terms, p3_found, p4_groups, p4_found, p5_found, p6_found, p6_paragraphs, p7_found, p8_ids, p9_found, p10_stretches, p10_found]
    return {f.__name__: f for f in found}


_TERMS = r"""
WITH latest AS (
  SELECT file_idx, category, token, frequency FROM (
    SELECT *, row_number() OVER (PARTITION BY file_idx, category, token
                                 ORDER BY loaded_at DESC NULLS LAST, frequency DESC NULLS LAST) AS rn
    FROM term_freq WHERE token IS NOT NULL AND file_idx IS NOT NULL)
  WHERE rn = 1 AND frequency >= 1),
clean AS (
  SELECT file_idx, category, frequency,
         CASE WHEN category = 'Word' THEN regexp_replace(lower(token), '^[^\pL'']+|[^\pL'']+$', '', 'g')
              ELSE regexp_replace(token, '^\s+|\s+$', '', 'g') END AS token
  FROM latest),
terms AS (
  SELECT category, token, CAST(sum(frequency) AS BIGINT) AS total, count(DISTINCT file_idx) AS files
  FROM clean WHERE token <> '' GROUP BY category, token),
marked AS (
  SELECT category, token, total, files,
         CASE WHEN files > 0.5 * (SELECT count(DISTINCT file_idx) FROM term_freq) THEN 'common'
              WHEN total < 3 OR files = 1 THEN 'rare' END AS mark
  FROM terms)
"""


_BEST = rf"""
WITH r AS (SELECT DISTINCT record_id, grp, speaker_name, title, first_name, middle_name, surname, total_words, coalesce(reviewed, 0) AS rev, updated_at AS ts, file_count, shortest_segment, longest_segment FROM speaker_records),
u AS (SELECT *, upper(trim(speaker_name)) AS u FROM r WHERE speaker_name IS NOT NULL),
s AS (SELECT grp, speaker_name, max(rev) AS rev, count(*) AS n, max(ts) AS ts FROM u
  WHERE regexp_full_match(u, '[\pL\pM.,''’ -]+') AND NOT contains(u, '..') AND regexp_matches(u, '\pL') AND string_split(replace(u, '.', ''), ' ')[1] NOT IN ({", ".join(f"'{x}'" for x in PLACEHOLDERS)})
  GROUP BY ALL),
v AS (SELECT grp, part, value, max(rev) AS rev, count(*) AS n FROM (SELECT grp, rev, unnest(['title', 'first', 'middle', 'surname']) AS part,
  unnest([upper(trim(title)), upper(trim(first_name)), upper(trim(middle_name)), upper(trim(surname))]) AS value FROM r) WHERE value <> '' GROUP BY ALL),
best AS (SELECT grp, max(value) FILTER (WHERE part = 'title') AS title, max(value) FILTER (WHERE part = 'first') AS f, max(value) FILTER (WHERE part = 'middle') AS m, max(value) FILTER (WHERE part = 'surname') AS l
  FROM (SELECT *, row_number() OVER (PARTITION BY grp, part ORDER BY rev DESC, n DESC, value DESC) AS k FROM v) WHERE k = 1 GROUP BY grp),
w AS (SELECT *, list_transform(list_filter(regexp_split_to_array(upper(speaker_name), '\s+'), lambda x: x <> ''), lambda x: regexp_replace(x, '[.,]+$', '')) AS w FROM s),
t AS (SELECT w.*, coalesce(w[1] IN ({", ".join("'" + x.replace("'", "''") + "'" for x in NAME_TITLES)}), false) AS titled, best.* EXCLUDE (grp) FROM w LEFT JOIN best ON w.grp IS NOT DISTINCT FROM best.grp),
p AS (SELECT *, list_filter(CASE WHEN titled THEN w[2:] ELSE w END, lambda x: length(x) > 1) AS fw,
  list_filter([f, m, l], lambda x: x IS NOT NULL) AS held, list_filter(regexp_split_to_array(concat_ws(' ', f, m, l), '\s+'), lambda x: x <> '') AS pw FROM t),
c AS (SELECT *, len(fw) AS k, len(list_filter(list_distinct(fw), lambda x: list_contains(held, x))) AS agreed,
  len(list_filter(regexp_split_to_array(coalesce(l, ''), '\s+'), lambda x: x <> '' AND NOT list_contains(fw, x))) > 0 AND len(fw) > 0 AND NOT list_contains(pw, fw[-1]) AS bad_l,
  len(list_filter(regexp_split_to_array(coalesce(f, ''), '\s+'), lambda x: x <> '' AND NOT list_contains(fw, x))) > 0 AND len(fw) > 1 AND NOT list_contains(pw, fw[1]) AS bad_f,
  len(list_filter(regexp_split_to_array(coalesce(m, ''), '\s+'), lambda x: x <> '' AND NOT list_contains(fw, x))) > 0 AND len(list_filter(fw[2:len(fw) - 1], lambda x: NOT list_contains(pw, x))) > 0 AS bad_m
  FROM p),
chosen AS (SELECT grp, speaker_name FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY (len(held) = 0 OR agreed > 0) AND NOT bad_l AND NOT bad_f AND NOT bad_m DESC, k + titled::INT DESC, rev DESC, agreed DESC,
  coalesce((titled AND w[1] = regexp_replace(title, '[.]+$', ''))::INT, 0) DESC, n DESC, ts DESC NULLS LAST, speaker_name DESC) AS place FROM c) WHERE place = 1),
counts AS (SELECT grp, total_words FROM (SELECT grp, total_words, row_number() OVER (PARTITION BY grp ORDER BY ts DESC NULLS LAST, total_words DESC) AS place FROM r WHERE total_words BETWEEN 1 AND 50000000) WHERE place = 1)
SELECT g.grp, speaker_name, total_words FROM (SELECT DISTINCT grp FROM r) g LEFT JOIN chosen ON g.grp IS NOT DISTINCT FROM chosen.grp LEFT JOIN counts ON g.grp IS NOT DISTINCT FROM counts.grp"""


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": _BEST,
        "p3_terms": _TERMS + "SELECT * FROM marked",
        "p3_found": _TERMS + "SELECT category, token, mark FROM marked WHERE mark IS NOT NULL",
        "p5_found": """
WITH RECURSIVE e AS (
  SELECT DISTINCT left_speaker_id AS a, right_speaker_id AS b FROM speaker_links
  WHERE is_match = 1 AND left_speaker_id IS NOT NULL AND right_speaker_id IS NOT NULL AND left_speaker_id <> right_speaker_id),
both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
ids AS (SELECT left_speaker_id AS id FROM speaker_links WHERE left_speaker_id IS NOT NULL
        UNION SELECT right_speaker_id FROM speaker_links WHERE right_speaker_id IS NOT NULL),
reach(id, g) AS (SELECT id, id FROM ids UNION SELECT b.b, r.g FROM reach r JOIN both_ways b ON b.a = r.id AND r.g < b.b)
SELECT id AS speaker_id, min(g) AS group_id FROM reach GROUP BY id""",
    }
