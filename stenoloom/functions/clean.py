"""Written text: the pre-clean, the cleaned form (V1), and preparation for review."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stenoloom.functions.regex import let, replace_with, steps, tokens

# Which words take which contracted ending after a lost apostrophe.
CONTRACTIONS = {
    "ve": "you we they who would could should might must",
    "m": "",
    "re": "you we they who there",
    "ll": "you we they he she it that who there",
    "d": "you we they he she it that who",
    "s": "he she it that there here what who",
    "t": "isn aren wasn weren don doesn didn won can couldn wouldn shouldn haven hasn hadn needn mustn shan",
}
#: Endings that "I" takes, in this writing only.
WITH_I = ("ve", "m", "ll", "d")
# Abbreviations that keep their period in review, besides the table's.
COMMON_ABBREVIATIONS = frozenset(
    "mr mrs ms dr prof hon rev st smt sri vs v no nos art arts sec cl sch para paras vol vols ch pt rs ltd pvt co ors anr ano govt dept etc ie eg viz ibid u s".split())

DOTS = ((r"\.{2,}\s*(?=[.?!;:,])", " "), (r"\.{2,}\s*(?=\S)", " , "), (r"\.{2,}", ""))


def pre_clean(text: Column) -> Column:
    """Quotes, dashes, the ellipsis sign and a superscript as spaces; spaces collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, '["‘’—–…²]', " "), " {2,}", " "))


def ascii_fold(text: Column) -> Column:
    """Long dashes as hyphens, everything beyond ASCII but curly apostrophes as space, those straight."""
    return steps(text, ("[—–]", "-"), (r"[^\x00-\x7F‘’]", " "), ("[‘’]", "'"))


def dotted_initials(text: Column) -> Column:
    """A.K. as A K."""
    return replace_with(text, r"\b(?:[A-Z]\.){2,}", lambda m, _: F.array_join(F.filter(F.split(m, r"\."), lambda c: c != ""), " "))


def space_punctuation(text: Column) -> Column:
    """Dots collapsed, brackets, commas and full stops apart from words; 3.14 and 32,381 stay."""
    return steps(
        text, *DOTS, (r"\(", " ( "), (r"\)", " ) "),
        ("([a-zA-Z]),", "$1 ,"), (r"(\d),(?!\d)", "$1 ,"), (",([a-zA-Z])", ", $1"),
        (r"([a-zA-Z])\.", "$1 ."), (r"(\d)\.(?!\d)", "$1 ."), (r"\.([a-zA-Z])", ". $1"))


def hyphens(text: Column) -> Column:
    """Words of three or more parts apart; of two parts joined after up to three letters, else apart."""
    text = replace_with(text, r"\b[A-Za-z]+(?:-[A-Za-z]+){2,}\b", lambda m, _: F.translate(m, "-", " "))
    return replace_with(text, r"\b[A-Za-z]+-[A-Za-z]+\b", lambda m, _: F.when(F.instr(m, "-") > 4, F.translate(m, "-", " ")).otherwise(F.translate(m, "-", "")))


def split_numbers(text: Column) -> Column:
    """Digits apart from letters, but ordinals, years and round decades with s."""
    kept = r"(?i)^(\d+(?:st|nd|rd|th)|\d{4}s|\d0s)$"
    text = replace_with(text, r"\b\d+[A-Za-z]+\b", lambda m, _: F.when(m.rlike(kept), m).otherwise(F.regexp_replace(m, r"^(\d+)", "$1 ")))
    return F.regexp_replace(text, r"\b([A-Za-z]+)(\d+)\b", "$1 $2")


def annotations(text: Column) -> Column:
    """[UNCLEAR] as a noise tag; other notes of the transcribers as space."""
    return steps(
        text, (r"(?i)\[UNCLEAR\]", "<noise>"),
        (r"(?i)\[NO\s+AUDIO(?:\s*/\s*VIDEO)?\]|<<[^>]*>>|END\s+OF\s+(?:THIS\s+)?PROCEEDINGS?\*?", " "),
        (r"\[[A-Z][A-Z\s/*-]*\]", " "), (r"(?i)\[inaudible\]", " "))


def contractions(text: Column) -> Column:
    """I ve as I've, and so on for each family."""
    rules = []
    for ending, stems in CONTRACTIONS.items():
        if ending in WITH_I:
            rules.append((rf"\b(I)\s+{ending}\b", f"$1'{ending}"))
        if stems:
            rules.append((rf"(?i)\b({'|'.join(stems.split())})\s+{ending}\b", f"$1'{ending}"))
    return steps(text, *rules)


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, " {2,}", " "))


def cleaned(text: Column) -> Column:
    """The cleaned written form of a text, V1; null stays null."""
    text = space_punctuation(dotted_initials(ascii_fold(text)))
    text = steps(hyphens(text), ("([A-Za-z]+)/([A-Za-z]+)", "$1 $2"), (r"([A-Za-z]+):(?!/)", "$1 "))
    text = contractions(collapse(annotations(split_numbers(text))))
    return collapse(F.regexp_replace(text, r"([!?,;])\1+", "$1"))


def for_review(text: Column, keep: frozenset[str]) -> Column:
    """The written side of a review: dots and separators reduced as in the spoken form, but the
    period of abbreviations, initials and decimals kept."""
    text = steps(text, (r"\.{2,}\s*(?=[.?!;:,])", " "), (r"\.{2,}\s*(?=\S)", " "), (r"\.{2,}", ""), ("[,;:]", " "), (r"([^\s?!])([?!]+)", "$1 $2"))
    held = F.array(*[F.lit(k) for k in sorted(keep)])

    def one(t: Column) -> Column:
        base = F.substring(t, F.lit(1), F.length(t) - 1)
        kept = base.contains(".") | base.rlike(r"^\p{L}$") | F.array_contains(held, F.lower(base)) | F.array_contains(held, F.lower(t))
        return F.when(t.endswith(".") & ~kept, F.concat(base, F.lit(" ."))).otherwise(t)

    return F.trim(F.regexp_replace(let(tokens(text), lambda ts: F.array_join(F.transform(ts, lambda t: one(t)), " ")), r"\s{2,}", " "))
