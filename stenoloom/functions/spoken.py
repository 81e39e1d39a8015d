"""The spoken form (V3) of a cleaned text: numbers, dates, abbreviations in words."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from stenoloom.functions import numbers as N
from stenoloom.functions.regex import let, replace_with, steps
from stenoloom.sources.lexicon import Abbreviation, read_abbreviations

ROMAN_ALONE = ("II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X")


def _group(m: Column, pattern: str, k: int) -> Column:
    return F.regexp_extract(m, pattern, k)


def _point(whole: Column, fraction: Column) -> Column:
    return F.when(fraction == "", whole).otherwise(F.concat_ws(" ", whole, F.lit("point"), N.digits(fraction)))


def abbreviation_pattern(short: str) -> str:
    base = re.escape(short.rstrip("."))
    return rf"(?i)\b{base}\s?\.(?=[\s,;:!?)]|$)" if short.endswith(".") else rf"(?i)\b{base}\b"


def contextual(text: Column) -> Column:
    """Art. and No. before a number, para where no number follows."""
    return steps(text, (r"(?i)\bArt\s?\.(?=\s+\d)", "article"), (r"(?i)\bNo\s?\.(?=\s+\d)", "number"), (r"(?i)\bpara\b(?!\s*\d)", "paragraph"))


def distances(text: Column) -> Column:
    p = r"(?i)\b(\d+)(?:\.(\d+))?\s*(kms?)\b"
    def make(m: Column, _: Column) -> Column:
        n = _group(m, p, 1)
        unit = F.when(F.lower(_group(m, p, 3)) == "kms", "kilometres").otherwise("kilometre")
        return F.concat_ws(" ", _point(F.coalesce(N.cardinal(N.whole(n)), N.digits(n)), _group(m, p, 2)), unit)
    return replace_with(text, p, make)


def abbreviations(text: Column, table: list[Abbreviation]) -> Column:
    return steps(text, *[(abbreviation_pattern(a.short), a.spoken.replace("$", r"\$")) for a in table])


def percents(text: Column) -> Column:
    p = r"\b(\d+)(?:\.(\d+))?%"
    return replace_with(text, p, lambda m, _: F.concat(_point(N.spoken(_group(m, p, 1)), _group(m, p, 2)), F.lit(" percent")))


def times(text: Column) -> Column:
    p = r"\b(\d{1,2}):(\d{2})\b"
    return replace_with(text, p, lambda m, _: F.concat_ws(
        " ", N.spoken(_group(m, p, 1)), F.when(_group(m, p, 2) == "00", "o'clock").otherwise(N.spoken(_group(m, p, 2)))))


def dates(text: Column) -> Column:
    p = r"\b(\d{1,2})/(\d{1,2})/(\d{2,4})\b"
    return replace_with(text, p, lambda m, _: F.concat_ws(" ", *[N.spoken(_group(m, p, k)) for k in (1, 2, 3)]))


def decimals(text: Column) -> Column:
    p = r"\b(\d+)\.(\d+)\b"
    return replace_with(text, p, lambda m, _: _point(N.spoken(_group(m, p, 1)), _group(m, p, 2)))


def romans(text: Column) -> Column:
    """Roman numbers after volume, chapter, part, section; II to X anywhere."""
    p = r"(?i)\b(volume|chapter|part|section)\s+([IVXLCDM]+)(?:-([A-Za-z0-9]+))?\b"
    def make(m: Column, _: Column) -> Column:
        def body(n: Column) -> Column:
            said = F.concat_ws(" ", _group(m, p, 1), N.chunked(n), F.when(_group(m, p, 3) != "", _group(m, p, 3)))
            return F.when(n.between(1, 3999), said).otherwise(m)
        return let(N.roman(_group(m, p, 2)), body)
    text = replace_with(text, p, make)
    return steps(text, *[(rf"(?i)\b{r}\b", N.ONES[k]) for k, r in enumerate(ROMAN_ALONE, 2)])


def decades(text: Column) -> Column:
    p = r"(?i)\b(\d{4}|\d{2})s\b"
    d = lambda m: F.regexp_extract(m, p, 1)
    return replace_with(text, p, lambda m, _: F.when((F.length(m) == 3) & ~m.rlike(r"^\d0"), m).otherwise(N.decade(N.spoken(d(m)))))


def ordinals(text: Column) -> Column:
    p = r"(?i)\b(\d{1,4})(?:st|nd|rd|th)\b"
    return replace_with(text, p, lambda m, _: N.ordinal(_group(m, p, 1).cast("bigint")))


def integers(text: Column) -> Column:
    """Five or more digits one by one, four of them also after page or para, else in chunks."""
    return replace_with(text, r"\b\d+\b", lambda m, before: F.when(
        (F.length(m) >= 5) | ((F.length(m) == 4) & before.rlike(r"(?i)(?:^|\s)(?:page|para)\s+$")), N.digits(m)).otherwise(N.spoken(m)))


def endings(text: Column) -> Column:
    """Hyphens, edge apostrophes, case and the punctuation of the spoken form."""
    text = steps(text, ("-", " "), (r"(?<!\w)'|'(?!\w)", ""))
    return steps(F.lower(text), (r"\.([A-Za-z])", ". $1"), (r"[,;:\[\]/]", " "), (r"([^\s])([.?!])", "$1 $2"))


def spoken_form(text: Column, table: list[Abbreviation] | None = None) -> Column:
    """V3 of a V1 text; tags are taken out and what they part is spoken by itself; null stays null.

    Give it a column and not the expression of :func:`cleaned`: each replacement with a made text
    is one more level of lambdas for the analyzer, and both chains in one expression are too deep.
    """
    table = read_abbreviations() if table is None else table

    def segment(t: Column) -> Column:
        t = F.translate(t, "()", "")
        t = contextual(F.regexp_replace(t, r"(?<!\w)&(?!\w)", "and"))
        t = abbreviations(distances(t), table)
        t = decimals(dates(times(percents(t))))
        t = F.regexp_replace(decades(romans(t)), r"\b(\d+)-([A-Za-z]+)\b", "$1 $2")
        return endings(integers(ordinals(t)))

    pieces = F.split(text, "<[^>]+>")
    return F.trim(F.regexp_replace(F.array_join(F.transform(pieces, lambda p: segment(p)), " "), " {2,}", " "))
