"""SQL for the queries of the core, written apart from them."""

from __future__ import annotations

from stenoloom.functions.nsw import CATEGORIES
from stenoloom.functions.numbers import ONES, TENS

_WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

_TEXTS = "texts AS (SELECT DISTINCT turn_id, file_idx, turn_idx, raw_name, transcript_original AS body FROM transcript_turns WHERE transcript_original IS NOT NULL)"

_LINES = rf"""
lines AS (SELECT file_idx, page_idx, line_no, min(l) AS line FROM (
    SELECT file_idx, page_idx, line_no, regexp_replace(line, '^{_WS}+|{_WS}+$', '', 'g') AS l FROM transcript_original
    WHERE file_idx IS NOT NULL AND page_idx IS NOT NULL AND line_no IS NOT NULL) WHERE l <> '' GROUP BY ALL),
noise AS (SELECT *, CASE WHEN regexp_full_match(line, 'Transcribed by TERES') THEN 'watermark' WHEN regexp_full_match(line, '[0-9]+') THEN 'line_number'
    WHEN regexp_full_match(line, '[0-9]{{1,2}}:[0-9]{{2}}\s*[AP]M\s*IST') THEN 'timestamp' WHEN regexp_full_match(line, '\S+@\S+\.\S+') THEN 'email' END AS kind FROM lines)"""

_TURNS = _LINES + r"""
, speech AS (SELECT *, regexp_matches(line, '^[A-Z][A-Z0-9 .\-'']+?:') AS is_label FROM noise WHERE kind IS NULL {boilerplate}),
parted AS (SELECT *, CASE WHEN is_label THEN trim(regexp_extract(line, '^([A-Z][A-Z0-9 .\-'']+?):\s*(.*)', 1)) END AS name,
    CASE WHEN is_label THEN regexp_extract(line, '^([A-Z][A-Z0-9 .\-'']+?):\s*(.*)', 2) ELSE line END AS rest,
    sum(CASE WHEN is_label THEN 1 ELSE 0 END) OVER (PARTITION BY file_idx ORDER BY page_idx, line_no) AS turn_idx FROM speech),
turns AS (SELECT file_idx, CAST(turn_idx AS BIGINT) AS turn_idx, max(name) AS raw_name,
    coalesce(string_agg(rest, ' ' ORDER BY page_idx, line_no) FILTER (WHERE rest <> ''), '') AS body
    FROM parted WHERE turn_idx > 0 GROUP BY file_idx, turn_idx),
counted AS (SELECT *, CAST(len(list_filter(regexp_split_to_array(body, '""" + _WS + r"""+'), lambda x: x <> '')) AS BIGINT) AS w FROM turns)"""
_SPEECH = _TURNS.replace("{boilerplate}", r"AND NOT regexp_matches(line, '(?i)END\s+OF\s+DAY''?S?\s+PROCEEDINGS')")
_ALL_SPEECH = _TURNS.replace("{boilerplate}", "")


def _ranked(words: str, column: str, percent: str = "") -> str:
    return f"""{words}, n AS (SELECT {column}, count(*) AS frequency FROM w GROUP BY {column})
SELECT row_number() OVER (ORDER BY frequency DESC, encode({column})) AS rank, {column}, frequency{percent} FROM n"""


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


#: Words of n below 100, of up to three digits, and in groups, from arrays of words.
_B100 = f"(CASE WHEN ({{n}}) < 20 THEN {_list(ONES)}[({{n}}) + 1] ELSE {_list(TENS)}[({{n}}) // 10 - 1] || CASE WHEN ({{n}}) % 10 > 0 THEN ' ' || {_list(ONES)}[({{n}}) % 10 + 1] ELSE '' END END)"


def _b100(n: str) -> str:
    return _B100.replace("{n}", n)


def _b1000(n: str) -> str:
    return f"(CASE WHEN ({n}) < 100 THEN {_b100(n)} ELSE {_b100(f'({n}) // 100')} || ' hundred' || CASE WHEN ({n}) % 100 > 0 THEN ' and ' || {_b100(f'({n}) % 100')} ELSE '' END END)"


def _cardinal(n: str) -> str:
    low, high = f"({n}) % 1000", f"({n}) // 1000"
    return (f"(CASE WHEN ({n}) < 1000 THEN {_b1000(n)} ELSE {_b1000(high)} || ' thousand' || CASE WHEN {low} = 0 THEN '' WHEN {low} < 100 THEN ' and ' || {_b100(low)} "
            f"ELSE ', ' || {_b1000(low)} END END)")


def _chunked(n: str) -> str:
    h, r = f"({n}) // 100", f"({n}) % 100"
    return (f"(CASE WHEN ({n}) < 100 THEN {_b100(n)} WHEN ({n}) >= 10000 THEN {_cardinal(n)} WHEN {r} = 0 AND ({n}) >= 1000 AND ({h}) % 10 = 0 THEN {_b100(f'({n}) // 1000')} || ' thousand' "
            f"WHEN {r} = 0 THEN {_b100(h)} || ' hundred' ELSE {_b100(h)} || ' ' || {_b100(r)} END)")


_DIGITS = f"array_to_string(list_transform(regexp_extract_all({{s}}, '[0-9]'), lambda d: {_list(ONES[:10])}[CAST(d AS INT) + 1]), ' ')"
_ORDINAL = """CASE WHEN {c} LIKE '%one' THEN regexp_replace({c}, 'one$', 'first') WHEN {c} LIKE '%two' THEN regexp_replace({c}, 'two$', 'second') WHEN {c} LIKE '%three' THEN regexp_replace({c}, 'three$', 'third')
 WHEN {c} LIKE '%five' THEN regexp_replace({c}, 'five$', 'fifth') WHEN {c} LIKE '%eight' THEN {c} || 'h' WHEN {c} LIKE '%nine' THEN regexp_replace({c}, 'nine$', 'ninth')
 WHEN {c} LIKE '%twelve' THEN regexp_replace({c}, 'twelve$', 'twelfth') WHEN {c} LIKE '%ty' THEN regexp_replace({c}, 'ty$', 'tieth') ELSE {c} || 'th' END"""

_DIM = ", ".join(f"('{c}')" for c in ("Word", *CATEGORIES))
_TITLE = (r"^(HON''BLE THE CHIEF JUSTICE OF INDIA|HON''BLE THE CHIEF JUSTICE|HON''BLE MRS\. JUSTICE|HON''BLE MR\. JUSTICE|HON''BLE MS\. JUSTICE|ADDITIONAL SOLICITOR GENERAL|"
          r"CHIEF JUSTICE OF INDIA|SOLICITOR GENERAL|ATTORNEY GENERAL|HON''BLE JUSTICE|CHIEF JUSTICE|JUSTICE|PROF|MRS|CJI|MR|MS|DR)\b\.?" + _WS + r"*([^\s.])")

_ROLE = (r"ADVOCATE|COUNSEL|PETITIONER''S COUNSEL( [0-9]*)?|RESPONDENT''S COUNSEL( [0-9]*)?|CLAIMANT''S COUNSEL|NODAL COUNSEL|COURT MASTER|BENCH|COURT|INTERPRETER|REGISTRAR|AMICUS|JUDGE|JUSTICE|SPEAKER")
_TITLES = _TITLE[2 : _TITLE.index(")")]
#: Parts of the names of a table raw(raw_name).
_PARSED = rf"""u AS (SELECT raw_name, upper(regexp_replace(raw_name, '^{_WS}+|{_WS}+$', '', 'g')) AS u FROM raw),
t AS (SELECT *, regexp_full_match(u, '{_ROLE}') AS role, regexp_replace(u, '^((?:{_TITLES})\b\.?{_WS}*)+([^\s.])', '\2') AS s FROM u),
l AS (SELECT *, list_filter(regexp_split_to_array(replace(s, '.', ' '), '{_WS}+'), lambda x: x <> '') AS p FROM t),
n AS (SELECT *, list_max(list_transform(list_filter(range(1, len(p) + 1), lambda i: NOT regexp_full_match(p[i], '\pL{{1,2}}')), lambda i: i)) AS long FROM l),
parsed AS (SELECT raw_name, role, CASE WHEN NOT role AND k > 1 THEN p[1] END AS first, CASE WHEN NOT role AND k > 2 THEN array_to_string(p[2:k - 1], ' ') ELSE '' END AS middles,
 CASE WHEN NOT role AND k > 0 THEN p[k] END AS surname, array_to_string(regexp_extract_all(left(u, length(u) - length(s)), '({_TITLES})\b', 1), ' ') AS title
 FROM (SELECT *, coalesce(long, len(p)) AS k FROM n))"""
#: Turns as they come back from the text the sink writes: names that no label of a text can be lose theirs.
_WRITTEN = _SPEECH + r""", written AS (SELECT file_idx, turn_idx, raw_name, body FROM turns)"""

ORACLES: dict[str, str] = {
    "word_freq_tokens": _ranked(f"WITH {_TEXTS}, w AS (SELECT x AS word FROM (SELECT unnest(regexp_split_to_array(lower(body), '{_WS}+')) AS x FROM texts) WHERE x <> '')", "word"),
    "word_freq_stripped": _ranked(
        f"WITH w AS (SELECT word FROM (SELECT regexp_replace(unnest(regexp_split_to_array(lower(text), '{_WS}+')), '^[^a-zA-Z''’]+|[^a-zA-Z''’]+$', '', 'g') AS word FROM documents) WHERE word <> '')",
        "word", ", round(100.0 * frequency / sum(frequency) OVER (), 4) AS percent"),
    "char_freq": _ranked(f"WITH {_TEXTS}, w AS (SELECT ch FROM (SELECT unnest(regexp_extract_all(body, '(?s).')) AS ch FROM texts) WHERE ch NOT IN (chr(10), chr(13)))",
                         "ch", ", round(100.0 * frequency / sum(frequency) OVER (), 3) AS percent"),
    "turns_from_lines": f"WITH {_SPEECH} SELECT file_idx, turn_idx, raw_name, body FROM turns",
    "noise_line_counts": f"WITH {_LINES} SELECT file_idx, kind, count(*) AS n FROM noise WHERE kind IS NOT NULL GROUP BY ALL",
    "noise_totals": f"WITH {_LINES} SELECT kind, count(*) AS n FROM noise WHERE kind IS NOT NULL GROUP BY ALL",
    "speaker_file_words": f"WITH {_SPEECH} SELECT file_idx, raw_name AS speaker, CAST(sum(w) AS BIGINT) AS words, count(*) AS turns FROM counted GROUP BY ALL",
    "speaker_file_matrix": f"""WITH {_SPEECH}, per AS (SELECT file_idx, raw_name AS s, CAST(sum(w) AS BIGINT) AS n FROM counted GROUP BY ALL)
SELECT file_idx, count(*) AS speakers, string_agg(s || '=' || n, '; ' ORDER BY encode(s)) AS cells FROM per WHERE n > 0 GROUP BY file_idx""",
    "segment_range": f"""WITH {_SPEECH} SELECT raw_name AS speaker, CAST(sum(w) AS BIGINT) AS words, count(DISTINCT file_idx) AS files, min(w) AS shortest, max(w) AS longest
FROM counted WHERE w > 0 GROUP BY raw_name""",
    "file_overview": f"""WITH {_ALL_SPEECH}, p AS (SELECT file_idx, count(DISTINCT page_idx) AS pages FROM lines GROUP BY file_idx),
s AS (SELECT file_idx, CAST(sum(w) AS BIGINT) AS words, count(*) AS turns, count(DISTINCT raw_name) AS speakers,
 count(DISTINCT CASE WHEN regexp_matches(raw_name, '[^A-Z ''.]') THEN raw_name END) AS unusual_speakers,
 array_to_string(list_sort(list(DISTINCT raw_name) FILTER (WHERE regexp_matches(raw_name, '[^A-Z ''.]'))), '; ') AS unusual_names FROM counted GROUP BY file_idx)
SELECT file_idx, pages, coalesce(words, 0) AS words, coalesce(turns, 0) AS turns, coalesce(speakers, 0) AS speakers, coalesce(unusual_speakers, 0) AS unusual_speakers,
 coalesce(unusual_names, '') AS unusual_names FROM p LEFT JOIN s USING (file_idx)""",
    "overview_totals": f"""WITH {_ALL_SPEECH}, p AS (SELECT file_idx, count(DISTINCT page_idx) AS pages FROM lines GROUP BY file_idx)
SELECT (SELECT count(*) FROM p) AS files, (SELECT CAST(sum(pages) AS BIGINT) FROM p) AS pages, (SELECT min(pages) FROM p) AS min_pages, (SELECT max(pages) FROM p) AS max_pages,
 (SELECT round(avg(pages), 4) FROM p) AS avg_pages, (SELECT CAST(sum(w) AS BIGINT) FROM counted) AS words, (SELECT count(*) FROM counted) AS turns""",
    "alias_resolution": """WITH a AS (SELECT raw_name AS raw, min(canonical) AS use FROM speaker_aliases WHERE canonical IS NOT NULL GROUP BY raw_name)
SELECT coalesce(use, raw_name) AS name, count(*) AS n FROM speaker_aliases LEFT JOIN a ON raw_name = raw GROUP BY 1""",
    "raw_speakers": f"WITH {_ALL_SPEECH} SELECT count(DISTINCT raw_name) AS raw_speakers FROM counted WHERE w > 0",
    "corpus_totals": f"""WITH {_TEXTS} SELECT count(DISTINCT file_idx) AS files, count(DISTINCT raw_name) AS speakers, count(*) AS turns,
 CAST(sum(len(list_filter(regexp_split_to_array(body, '{_WS}+'), lambda x: x <> ''))) AS BIGINT) AS words, CAST(sum(length(replace(replace(body, chr(10), ''), chr(13), ''))) AS BIGINT) AS characters
FROM texts WHERE body <> ''""",
    "raw_turn_text": f"WITH {_SPEECH} SELECT file_idx, turn_idx, raw_name || ':' || chr(10) || body || chr(10) AS value FROM turns WHERE body <> ''",
    "text_turns_dropped": f"WITH {_WRITTEN} SELECT * FROM written WHERE body <> ''",
    "text_turns_kept": f"WITH {_WRITTEN} SELECT * FROM written",
    "cast_sheet": f"""WITH {_TEXTS}, c AS (SELECT t.*, s.spk_id, len(list_filter(regexp_split_to_array(body, '{_WS}+'), lambda x: x <> '')) AS w FROM texts t JOIN speakers s ON raw_name = speaker_name),
g AS (SELECT spk_id, raw_name AS canonical, CAST(sum(w) AS BIGINT) AS words, count(DISTINCT file_idx) AS files, array_to_string(list_sort(list(DISTINCT file_idx)), ', ') AS file_list,
 CAST(min(w) AS BIGINT) AS shortest, CAST(max(w) AS BIGINT) AS longest FROM c WHERE w > 0 GROUP BY ALL), raw AS (SELECT DISTINCT canonical AS raw_name FROM g), {_PARSED}
SELECT spk_id, canonical, p.title, coalesce(p.first, '') AS first_name, p.middles AS middle_names, coalesce(p.surname, canonical) AS surname, CASE WHEN p.role THEN 'Role' ELSE 'Named' END AS speaker_type,
 words, files, file_list, shortest, longest FROM g JOIN parsed p ON p.raw_name = canonical""",
    "cast_matrix": f"""WITH {_TEXTS}, c AS (SELECT file_idx, spk_id, CAST(sum(len(list_filter(regexp_split_to_array(body, '{_WS}+'), lambda x: x <> ''))) AS BIGINT) AS w FROM texts JOIN speakers ON raw_name = speaker_name
 GROUP BY ALL) SELECT file_idx, count(*) AS speakers, string_agg(spk_id || '=' || w, '; ' ORDER BY encode(spk_id)) AS cells FROM c WHERE w > 0 GROUP BY file_idx""",
    "parsed_names": f"WITH raw AS (SELECT DISTINCT raw_name FROM speaker_aliases WHERE raw_name IS NOT NULL), {_PARSED} SELECT raw_name, first, middles, surname, title FROM parsed",
    "resolved_speakers": f"""WITH {_TEXTS} SELECT raw_name, coalesce(s.spk_id, raw_name) AS spk_id, s.spk_id IS NOT NULL AS mapped, count(*) AS turns
FROM texts LEFT JOIN speakers s ON raw_name = speaker_name WHERE raw_name IS NOT NULL GROUP BY ALL""",
    "unmapped_speakers": f"WITH {_TEXTS} SELECT raw_name, count(*) AS turns FROM texts WHERE raw_name IS NOT NULL AND raw_name NOT IN (SELECT speaker_name FROM speakers) GROUP BY ALL",
    "name_parts": rf"""WITH r AS (SELECT DISTINCT raw_name FROM speaker_aliases WHERE raw_name IS NOT NULL), u AS (SELECT raw_name, upper(regexp_replace(raw_name, '^{_WS}+|{_WS}+$', '', 'g')) AS u FROM r),
t AS (SELECT *, regexp_replace(u, '^((?:{_TITLES})\b\.?{_WS}*)+([^\s.])', '\2') AS s FROM u),
k AS (SELECT *, regexp_extract_all(regexp_replace(translate(regexp_replace(upper(raw_name), '[.'' ]', '', 'g'), 'VCQZP', 'WKKSB'), '[AEIOU]', '', 'g'), '(?s).') AS c FROM t)
SELECT raw_name, trim(regexp_replace(replace(s, '.', ' '), '{_WS}+', ' ', 'g')) AS stripped,
 CASE WHEN regexp_full_match(u, 'ADVOCATE|COUNSEL|PETITIONER''S COUNSEL( [0-9]*)?|RESPONDENT''S COUNSEL( [0-9]*)?|CLAIMANT''S COUNSEL|NODAL COUNSEL|COURT MASTER|BENCH|COURT|INTERPRETER|REGISTRAR|AMICUS|JUDGE|JUSTICE|SPEAKER')
  THEN 'Role' ELSE 'Named' END AS kind,
 array_to_string(list_filter(c, lambda x, i: i = 1 OR x <> c[i - 1]), '') AS key FROM k""",
    "name_order": f"""WITH {_SPEECH}, seen AS (SELECT raw_name AS name, CAST(sum(w) AS BIGINT) AS words, min((file_idx, turn_idx)) AS place FROM counted WHERE w > 0 GROUP BY raw_name)
SELECT name, words, row_number() OVER (ORDER BY place) AS name_ord FROM seen""",
    "dedup_mapping_ranked": f"""WITH {_SPEECH}, seen AS (SELECT raw_name AS name, CAST(sum(w) AS BIGINT) AS words, min((file_idx, turn_idx)) AS place FROM counted WHERE w > 0 GROUP BY raw_name)
SELECT row_number() OVER (ORDER BY words DESC, place) AS rank, name, words FROM seen""",
    "ascii_folded": rf"""WITH {_TEXTS} SELECT turn_id, translate(regexp_replace(translate(body, '—–', '--'), '[^\x00-\x7F‘’]', ' ', 'g'), '‘’', '''''') AS folded,
 trim(regexp_replace(regexp_replace(body, '["‘’—–…²]', ' ', 'g'), ' +', ' ', 'g')) AS pre FROM texts""",
    "spoken_numbers": f"""WITH v AS (SELECT DISTINCT n FROM (SELECT l_partkey AS n FROM lineitem UNION ALL SELECT CAST(floor(l_extendedprice) AS BIGINT) FROM lineitem))
, c AS (SELECT n, {_cardinal('n')} AS c FROM v)
SELECT n, {_chunked('n')} AS chunked, {_DIGITS.replace('{s}', 'CAST(n AS VARCHAR)')} AS digits, CASE WHEN n < 10000 THEN {_ORDINAL.replace('{c}', 'c')} END AS ordinal, c AS cardinal FROM c""",
    "spoken_items": f"""WITH v AS (SELECT DISTINCT CAST(floor(l_extendedprice) AS BIGINT) AS p, CAST(round(l_discount * 100) AS BIGINT) AS d, l_linenumber AS k, l_shipdate AS t FROM lineitem)
, x AS (SELECT *, {_cardinal('k')} AS c FROM v)
SELECT 'Rs ' || p || ' at ' || d || '% on ' || strftime(t, '%d/%m/%Y') || ' for the ' || k || 'th item at ' || strftime(t, '%H:%M') AS written,
 'rs ' || CASE WHEN p >= 10000 THEN {_DIGITS.replace('{s}', 'CAST(p AS VARCHAR)')} ELSE {_chunked('p')} END || ' at ' || {_chunked('d')} || ' percent on ' || {_chunked('day(t)')} || ' ' || {_chunked('month(t)')} || ' ' || {_chunked('year(t)')}
 || ' for the ' || {_ORDINAL.replace('{c}', 'c')} || ' item at ' || {_chunked('hour(t)')} || CASE WHEN minute(t) = 0 THEN ' o''clock' ELSE ' ' || {_chunked('minute(t)')} END AS spoken FROM x""",
    "spoken_events": f"""WITH v AS (SELECT event_id, upper(event_type) AS e, CAST(1000 + event_id % 9000 AS BIGINT) AS p, CAST(event_id % 400 AS BIGINT) AS k, CAST(1900 + 10 * (event_id % 10) AS BIGINT) AS y FROM events),
x AS (SELECT *, CASE WHEN regexp_full_match(e, '[A-Z*/ -]+') THEN '' ELSE '[' || e || '] ' END AS b FROM v)
SELECT event_id, b || 'page ' || p || ' Volume IV km ' || k || ' km J&K A K in the ' || y || 's' AS v1,
 CASE WHEN b = '' THEN '' ELSE lower(e) || ' ' END || 'page ' || {_DIGITS.replace('{s}', 'CAST(p AS VARCHAR)')} || ' volume four kilometre ' || {_b1000('k')} || ' kilometre j and k a k in the ' ||
 CASE WHEN y = 1900 THEN 'nineteen hundreds' ELSE regexp_replace({_chunked('y')}, 'ty$', 'tie') || 's' END AS v3 FROM x""",
    "nsw_bracketed": rf"""WITH {_TEXTS}, b AS (SELECT body FROM texts UNION ALL SELECT DISTINCT line FROM transcript_original)
SELECT token, count(*) AS frequency FROM (SELECT trim(unnest(regexp_extract_all(body, '\[[^\]]*\]'))) AS token FROM b) GROUP BY token""",
    "term_rank": """WITH n AS (SELECT category, token, CAST(sum(frequency) AS BIGINT) AS total FROM term_freq WHERE token IS NOT NULL AND frequency >= 1 GROUP BY ALL)
SELECT row_number() OVER (ORDER BY total DESC, encode(category), encode(token)) AS rank, category, token, total FROM n""",
    "term_category_totals": f"""WITH dim(category) AS (VALUES {_DIM}), n AS (SELECT category, CAST(sum(frequency) AS BIGINT) AS occurrences, count(DISTINCT token) AS distinct_tokens FROM term_freq
 WHERE token IS NOT NULL AND frequency >= 1 GROUP BY category)
SELECT category, coalesce(occurrences, 0) AS occurrences, coalesce(distinct_tokens, 0) AS distinct_tokens FROM dim LEFT JOIN n USING (category)""",
    "line_stream_statistics": rf"""SELECT date_trunc('day', loaded_at) AS start, file_idx,
 CASE WHEN regexp_matches(line, '^\s*Transcribed by TERES\s*$') THEN 'watermark' WHEN regexp_matches(line, '^\s*[0-9]+\s*$') THEN 'line_number'
  WHEN regexp_matches(line, '^\s*[0-9]{{1,2}}:[0-9]{{2}}\s*[AP]M\s*IST\s*$') THEN 'timestamp' WHEN regexp_matches(line, '^\s*\S+@\S+\.\S+\s*$') THEN 'email'
  WHEN regexp_matches(line, '(?i)END\s+OF\s+DAY''?S?\s+PROCEEDINGS') THEN 'boilerplate' ELSE 'speech' END AS kind,
 count(*) AS lines, CAST(sum(len(list_filter(regexp_split_to_array(line, '{_WS}+'), lambda x: x <> ''))) AS BIGINT) AS words
FROM transcript_original WHERE loaded_at IS NOT NULL AND trim(line) <> '' GROUP BY ALL""",
}
