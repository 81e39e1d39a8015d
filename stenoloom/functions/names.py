"""Parts and keys of speaker names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from stenoloom.functions.regex import let

# Honorifics, and labels that name a role and no person.
TITLES = (
    "HON'BLE THE CHIEF JUSTICE OF INDIA", "HON'BLE THE CHIEF JUSTICE", "HON'BLE MR. JUSTICE", "HON'BLE MS. JUSTICE", "HON'BLE MRS. JUSTICE", "HON'BLE JUSTICE",
    "CHIEF JUSTICE OF INDIA", "CHIEF JUSTICE", "ATTORNEY GENERAL", "SOLICITOR GENERAL", "ADDITIONAL SOLICITOR GENERAL",
    "JUSTICE", "CJI", "MR.", "MRS.", "MS.", "DR.", "MR", "MRS", "MS", "DR", "PROF.", "PROF",
)
ROLES = (
    "ADVOCATE", "COUNSEL", r"PETITIONER'S COUNSEL(?: \d*)?", r"RESPONDENT'S COUNSEL(?: \d*)?", "CLAIMANT'S COUNSEL", "NODAL COUNSEL",
    "COURT MASTER", "BENCH", "COURT", "INTERPRETER", "REGISTRAR", "AMICUS", "JUDGE", "JUSTICE", "SPEAKER",
)
_ONE = "(" + "|".join(re.escape(t) for t in sorted(TITLES, key=len, reverse=True)) + r")\b\.?+\s*+"
#: All titles one after another, but for what would leave nothing.
_LEADING = rf"(?U)^(?:{_ONE}(?=\S))++"
_ROLE = "^(?:" + "|".join(ROLES) + ")$"


def upper_trim(raw: Column) -> Column:
    return F.upper(F.regexp_replace(raw, r"(?U)^\s+|\s+$", ""))


def is_role(raw: Column) -> Column:
    return upper_trim(raw).rlike(_ROLE)


def speaker_type(raw: Column) -> Column:
    return F.when(is_role(raw), "Role").otherwise("Named")


def strip_titles(raw: Column) -> Column:
    """Capitals without leading titles (kept where nothing would be left) and dots."""
    name = F.regexp_replace(upper_trim(raw), _LEADING, "")
    return F.trim(F.regexp_replace(F.translate(name, ".", " "), r"(?U)\s+", " "))


def titles_of(raw: Column) -> Column:
    """The titles that :func:`strip_titles` takes off, in order."""
    leading = F.regexp_extract(upper_trim(raw), _LEADING, 0)
    return F.array_join(F.regexp_extract_all(leading, F.lit(rf"(?U)\G{_ONE}"), F.lit(1)), " ")


def parse_name(raw: Column) -> Column:
    """Struct (first, middles, surname): the surname is the last word of more than two letters
    (what follows it is dropped), else the last; all null for roles and empty names."""
    def body(parts: Column) -> Column:
        long = F.transform(parts, lambda p: ~p.rlike(r"^\p{L}{1,2}$"))
        at = F.size(parts) - F.array_position(F.reverse(long), True).cast("int") + 1
        at = F.when(F.array_contains(long, True), at).otherwise(F.size(parts))
        none = is_role(raw) | (F.size(parts) == 0)
        return F.struct(
            F.when(~none & (at > 1), F.element_at(parts, 1)).alias("first"),
            F.when(~none & (at > 2), F.slice(parts, F.lit(2), at - 2)).otherwise(F.array().cast("array<string>")).alias("middles"),
            F.when(~none, F.element_at(parts, F.greatest(at, F.lit(1)))).alias("surname"))

    return let(F.filter(F.split(strip_titles(raw), r"\s+"), lambda w: w != ""), body)


def consonant_key(word: Column) -> Column:
    """Consonants with like sounds made equal, vowels out, repeated letters once."""
    w = F.translate(F.regexp_replace(F.upper(F.coalesce(word, F.lit(""))), "[.' ]", ""), "VCQZP", "WKKSB")
    return F.regexp_replace(F.regexp_replace(w, "[AEIOU]", ""), r"(.)\1+", "$1")
