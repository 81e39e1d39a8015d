"""Regular-expression combinators on Columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), lambda x: body(x)), 1)


def replace_with(text: Column, pattern: str, make: Callable[[Column, Column], Column]) -> Column:
    """``text`` with every match replaced by ``make(match, text before it up to the last match)``."""
    def body(t: Column) -> Column:
        pieces = F.split(t, pattern, -1)
        hits = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        made = F.zip_with(hits, F.slice(pieces, 1, F.size(hits)), lambda m, before: F.concat(before, make(m, before)))
        return F.concat(F.array_join(made, ""), F.element_at(pieces, -1))

    return let(text, lambda t: F.when(t.rlike(pattern), body(t)).otherwise(t))


def steps(text: Column, *rules: tuple[str, str]) -> Column:
    """``regexp_replace`` of each (pattern, replacement) in order."""
    for pattern, new in rules:
        text = F.regexp_replace(text, pattern, new)
    return text


def tokens(text: Column) -> Column:
    """Pieces between white space of any kind, without empty ones."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")
