"""Small tab-separated word lists, read on the driver."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

DATA = Path(__file__).resolve().parents[1] / "data"


@dataclass(frozen=True)
class Abbreviation:
    short: str
    spoken: str
    context: str = "body"


def _rows(path: str | Path) -> list[list[str]]:
    text = Path(path).read_text(encoding="utf-8")
    return [[p.strip() for p in x.split("\t")] for x in text.split("\n") if x.strip() and not x.lstrip().startswith("#") and "\t" in x.strip()]


def read_abbreviations(path: str | Path = DATA / "abbreviations.tsv") -> list[Abbreviation]:
    """Entries of at least two fields, the longest short form first (equal ones as in the file)."""
    found = [Abbreviation(r[0], r[1], (r[2].lower() if len(r) > 2 and r[2] else "body")) for r in _rows(path)]
    return sorted(found, key=lambda a: -len(a.short))


def abbreviation_set(path: str | Path = DATA / "abbreviations.tsv") -> frozenset[str]:
    """Short forms in lower case, with and without their final period."""
    low = {a.short.lower() for a in read_abbreviations(path)}
    return frozenset(low | {x.rstrip(".") for x in low})


def read_aliases(path: str | Path = DATA / "aliases.tsv") -> dict[str, str]:
    """Raw name to the name to use; of repeated raw names the last entry holds."""
    return {r[0]: r[1] for r in _rows(path) if r[0] and r[1]}
