"""Numbers as spoken words, natively."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stenoloom.functions.regex import let

ONES = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
SCALES = ("thousand", "million", "billion", "trillion")
#: Last words whose ordinal is not just "th" added.
ORDINALS = {"one": "first", "two": "second", "three": "third", "five": "fifth", "eight": "eighth", "nine": "ninth", "twelve": "twelfth"}

_BELOW_100 = [ONES[n] if n < 20 else TENS[n // 10 - 2] + (f" {ONES[n % 10]}" if n % 10 else "") for n in range(100)]


def _table(words: list[str]) -> Column:
    """A constant array, written as one literal so that plans stay small; folded by the optimizer."""
    return F.split(F.lit("|".join(words)), r"\|")


def _below_100(n: Column) -> Column:
    return F.element_at(_table(_BELOW_100), (n + 1).cast("int"))


def digits(text: Column) -> Column:
    """Each digit by itself: 105 -> one zero five."""
    found = F.regexp_extract_all(text, F.lit("[0-9]"), F.lit(0))
    return F.array_join(F.transform(found, lambda d: F.element_at(_table(ONES[:10]), d.cast("int") + 1)), " ")


def _below_1000(n: Column) -> Column:
    h, r = F.floor(n / 100), n % 100
    return F.when(n < 100, _below_100(n)).otherwise(
        F.concat(_below_100(h), F.lit(" hundred"), F.when(r == 0, "").otherwise(F.concat(F.lit(" and "), _below_100(r)))))


def cardinal(number: Column) -> Column:
    """A whole number (BIGINT, below 10^15) in words, with "and" before the last two digits and
    commas between the groups of three."""
    def body(n: Column) -> Column:
        def group(k: Column) -> Column:
            g = F.floor(n / F.pow(F.lit(1000), k)).cast("bigint") % 1000
            return let(g, lambda x: F.when(x > 0, F.concat_ws(" ", _below_1000(x), F.element_at(_table(list(SCALES)), k))))

        high = F.array_join(F.array_compact(F.transform(F.array(*[F.lit(k) for k in range(len(SCALES), 0, -1)]), group)), ", ")
        low = n % 1000
        comma = F.when(low == 0, "").when(low < 100, " and ").otherwise(", ")
        return F.when(n < 1000, _below_1000(n)).otherwise(F.concat(high, comma, F.when(low > 0, _below_1000(low)).otherwise("")))

    return let(number.cast("bigint"), body)


def chunked(number: Column) -> Column:
    """Up to four digits by twos and hundreds as read aloud: 370 -> three seventy, 1950 ->
    nineteen fifty, 1100 -> eleven hundred, 1000 -> one thousand; larger ones as :func:`cardinal`."""
    def body(n: Column) -> Column:
        h, r = F.floor(n / 100).cast("bigint"), n % 100
        thousand = (r == 0) & (h >= 10) & (h % 10 == 0)
        head = _below_100(F.when(thousand, F.floor(h / 10)).otherwise(h))
        tail = F.when(thousand, "thousand").when(r == 0, "hundred").otherwise(_below_100(r))
        return F.when(n < 100, _below_100(n)).when(n < 10000, F.concat_ws(" ", head, tail)).otherwise(cardinal(n))

    return let(number.cast("bigint"), body)


def ordinal(number: Column) -> Column:
    """0..9999 as an ordinal: 21 -> twenty first."""
    words = cardinal(number)
    last = F.regexp_extract(words, r"(\w+)$", 1)
    table = F.create_map(*[F.lit(x) for kv in ORDINALS.items() for x in kv])
    ending = F.coalesce(F.element_at(table, last), F.regexp_replace(F.concat(F.regexp_replace(last, "y$", "ie"), F.lit("th")), "ieth$", "ieth"))
    return F.concat(F.regexp_replace(words, r"\w+$", ""), ending)


def decade(spoken: Column) -> Column:
    """The plural of spoken tens: nineteen sixty -> nineteen sixties."""
    return F.when(spoken.rlike("ty$"), F.regexp_replace(spoken, "ty$", "ties")).otherwise(F.concat(spoken, F.lit("s")))


def roman(text: Column) -> Column:
    """Value of roman digits by the subtractive rule, right to left, without validation."""
    values = F.create_map(*[F.lit(x) for kv in {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}.items() for x in kv])
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("last"))

    def step(acc: Column, c: Column) -> Column:
        v = F.coalesce(F.element_at(values, c), F.lit(0))
        return F.struct((acc["n"] + F.when(v >= acc["last"], v).otherwise(-v)).alias("n"), v.alias("last"))

    return F.aggregate(F.reverse(F.split(F.upper(text), "")), start, step, lambda a: a["n"])


def whole(text: Column) -> Column:
    """Digits as a number; null beyond 15 digits."""
    return F.when(F.length(text) <= 15, text.try_cast("bigint"))


def spoken(text: Column) -> Column:
    """Digits as :func:`chunked`, one by one beyond 15 of them."""
    return F.coalesce(chunked(whole(text)), digits(text))
