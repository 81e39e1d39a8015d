"""Sentence boundaries across languages and scripts, with statistics learned unsupervised.

Per language the whole collection gives: how often a word stands with and without a period,
what follows it, and how words are written inside sentences.  From these come, by
log-likelihood ratios, abbreviations, collocations around the period of a number, an initial or an
abbreviation ("8. Mai", "v. The") and sentence starters; each period of a text is then classified by them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stenoloom.operators.order import spread
from stenoloom.plans.durable import cut, drop

# Final marks, quotes and brackets of the scripts handled.
STRONG = "!?؟。！？｡।॥։።"
CLOSER_OF = {"“": "”", "„": "“”", "«": "»", "‹": "›", "「": "」", "『": "』", "(": ")", "（": "）", "[": "]", "【": "】", '"': '"'}
CLOSERS = "”“»›」』)）]】\"'’"
BRACKETS = "([（【"
# Polite particles that end a Thai sentence; Japanese particles that go on after a quotation.
THAI_FINAL = ("ครับ", "ค่ะ", "คะ", "นะ", "จ้ะ", "จ้า", "ฮะ")
JA_QUOTE_GOES_ON = ("と", "って", "を", "は", "が", "に", "で", "の", "も", "か")

_NUM = "##"
_TOKEN = regex.compile(r"[\p{L}\p{M}\p{N}][\p{L}\p{M}\p{N}.'’/-]*")
_TOKEN_CHAR = regex.compile(r"[\p{L}\p{M}\p{N}.'’/-]")
_SPACES, _LETTER = regex.compile(r"\s*"), regex.compile(r"[^\W\d_]")
_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+(?:['’-][\p{L}\p{M}\p{N}]+)*")
_SCAN = regex.compile(r"\n[^\S\n]*(?:\n\s*)+|\.+|…+|[!?؟。！？｡।॥|։።]+|[“”„«»‹›「」『』()（）\[\]【】\"]|(?<=\p{Thai})\s+(?=\S)")
_SCRIPTS = (("Deva", regex.compile(r"\p{Devanagari}")), ("Arab", regex.compile(r"\p{Arabic}")), ("Thai", regex.compile(r"\p{Thai}")),
            ("Kana", regex.compile(r"[\p{Hiragana}\p{Katakana}]")), ("Hani", regex.compile(r"\p{Han}")), ("Latn", regex.compile(r"\p{Latin}")))


def _script(text: str) -> str:
    """The first script in order of _SCRIPTS that has a fifth of the letters of the whole text."""
    letters = sum(c.isalpha() for c in text) or 1
    return next((n for n, p in _SCRIPTS if sum(1 for _ in p.finditer(text)) * 5 >= letters), "Zyyy")


def _norm(w: str) -> str:
    w = w.rstrip(".").lower()
    return _NUM if w and not any(c.isalpha() for c in w) else w


def _case(w: str) -> str:
    return "d" if w[0].isdigit() else "u" if w[0].isupper() else "l" if w[0].islower() else "x"


def _starts_low(text: str) -> bool:
    """Whether this text writes the beginnings of its sentences small."""
    first = next((c for c in text if c.isalpha()), "")
    return first.islower()


def _events(text: str, lang: str, out: Counter) -> None:
    """Count into ``out`` the keys (lang, kind, word, next word, case of the next word).

    kind P: a word with a period (next: the word after it or '' where a line or the text ends);
    N: a word without a period; M, C: a word inside a sentence, written small or with a capital; S: a word that certainly begins
    a sentence or line, that is not after a period, which may be an abbreviation's.
    """
    low, last_end, last_period, last = _starts_low(text), 0, False, ""
    for m in _TOKEN.finditer(text):
        raw = m.group()
        # a period at the end of a token belongs to it as a mark only before white space, a closer or the end
        word = raw.rstrip("'’/-")
        period = word.endswith(".")
        if not period and text[m.end() : m.end() + 1] == "." and word == raw:
            period = True
        n = _norm(word)
        gap = text[last_end : m.start()]
        if last:
            if last_period:
                nxt = "" if "\n" in gap else n
                if not low:
                    out[lang, "P", last, nxt, _case(raw)] += 1
                else:
                    out[lang, "P", last, nxt, "?"] += 1
        if not last or "\n" in gap or any(c in gap for c in STRONG):
            out[lang, "S", n, "", ""] += 1
        elif not last_period and not low and (raw[0].islower() or raw[0].isupper()):
            out[lang, "M" if raw[0].islower() else "C", n, "", ""] += 1
        if not period:
            out[lang, "N", n, "", ""] += 1
        last, last_period, last_end = n, period and "..." not in text[m.end() - 2 : m.end() + 2], m.end()
    if last and last_period:
        out[lang, "P", last, "", "x"] += 1


def _language(lang: str | None) -> str:
    return (lang or "").strip().lower().split("-")[0]


def count_events(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """The events of all texts; each Arrow batch is counted before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c: Counter = Counter()
            for t, code in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if t and not t.isspace():
                    _events(t, _language(code) or "und-" + _script(t), c)
            cols = list(zip(*c)) if c else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.string()) for x in cols), pa.array(list(c.values()), pa.int64())],
                ["lang", "kind", "word", "nxt", "cas", "n"])

    schema = "lang string, kind string, word string, nxt string, cas string, n bigint"
    return spread(docs.select(text, lang)).mapInArrow(count, schema).groupBy("lang", "kind", "word", "nxt", "cas").agg(F.sum("n").alias("n"))


def _llr(k1, n1, k2, n2):
    """Dunning's log-likelihood ratio of two binomials, natively."""
    def ll(k, n, p):
        p = F.greatest(F.least(p, F.lit(1 - 1e-9)), F.lit(1e-9))
        return k * F.log(p) + (n - k) * F.log(1 - p)

    p = (k1 + k2) / (n1 + n2)
    return 2 * (ll(k1, n1, k1 / n1) + ll(k2, n2, k2 / F.greatest(n2, F.lit(1))) - ll(k1, n1, p) - ll(k2, n2, p))


def learn(docs: DataFrame, text: str, lang: str, model_size: int = 20_000) -> dict:
    """The statistics of each language: abbreviations, those that may end a sentence,
    collocations, sentence starters, and frequent words (for texts without a language).

    All counts are over all texts.  ``model_size`` bounds each kind of entry per language, the
    strongest first; languages have some hundred abbreviations, so it is a bound on the memory
    of a worker and not a selection.
    """
    events = cut(count_events(docs, text, lang))
    by = ["lang", "word"]
    words = events.groupBy(*by).agg(*[
        F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(k.lower()) for k in "PNMSC"])
    words = words.withColumn("total", F.col("p") + F.col("n"))
    size = words.groupBy("lang").agg(F.sum("total").alias("all_n"), F.sum("p").alias("all_p"), F.sum("s").alias("all_s"))
    words = words.join(F.broadcast(size), "lang")
    length = F.greatest(F.length(F.regexp_replace("word", r"[.\p{M}]", "")), F.lit(1))
    inner = F.length("word") - F.length(F.replace(F.col("word"), F.lit("."), F.lit(""))) + 1
    # log-likelihood that the period belongs to the word, for short words and against those seen without one
    strength = _llr(F.col("p"), F.col("total"), F.col("all_p") - F.col("p"), F.col("all_n") - F.col("total"))
    score = F.when(F.col("p") / F.col("total") > F.col("all_p") / F.col("all_n"), strength).otherwise(0.0)
    score = score * F.exp(-length) * inner * F.pow(length, -F.col("n"))
    abbreviations = words.where((F.col("p") > 1) & (F.col("word") != _NUM)).withColumn("score", score).where("score > 0.3")

    pairs = events.where("kind = 'P'")
    known_low = words.select("lang", F.col("word").alias("nxt"), F.col("m"))
    follow = pairs.join(abbreviations.select("lang", "word", "score"), by)
    # ends of lines have no next word, and are most of the rows
    follow = follow.where("nxt <> ''").join(known_low, ["lang", "nxt"], "left").unionByName(follow.where("nxt = ''").withColumn("m", F.lit(None).cast("bigint")))
    # followed by an end of line or text, or by a capital that this language also writes small: it ends sentences
    ends = (F.col("nxt") == "") | ((F.col("cas") == "u") & (F.coalesce("m", F.lit(0)) > 0))
    # scripts without capitals: abbreviations hardly ever stand last in a line
    rate = F.sum(F.when(ends, F.col("n")).otherwise(0)) / F.sum("n")
    last = F.sum(F.when(F.col("nxt") == "", F.col("n")).otherwise(0)) / F.sum("n")
    caseless = F.sum(F.when(F.col("cas") == "x", F.col("n")).otherwise(0)) > 0.3 * F.sum("n")
    enders = follow.groupBy(*by).agg(
        F.max("score").alias("score"),
        F.when(caseless & (last > 0.05), F.lit(1.0)).otherwise(rate).alias("rate"),
        (F.sum(F.when(F.col("cas").isin("l", "d"), F.col("n")).otherwise(0)) / F.sum("n")).alias("goes_on"))
    starters = words.where((F.col("s") > 4) & (F.col("s") / F.col("total") > 2 * F.col("all_s") / F.col("all_n"))).withColumn(
        "score", _llr(F.col("s"), F.col("total"), F.col("all_s") - F.col("s"), F.col("all_n") - F.col("total"))).where("score > 30").withColumn(
        # how often it is written small inside sentences; names and nouns that begin many sentences are not
        "small", F.col("m") / F.greatest(F.col("m") + F.col("c"), F.lit(1)))
    # a capitalised word that follows the period of this number, initial or abbreviation more often than other periods
    capital = pairs.where((F.col("cas") == "u") & (F.col("nxt") != "")).groupBy("lang", "word", "nxt").agg(F.sum("n").alias("k"))
    kinds = enders.select(*by, F.col("rate").alias("may_end"))
    first = starters.select("lang", F.col("word").alias("nxt"), F.lit(True).alias("first"))
    small = words.where("m > c").select("lang", F.col("word").alias("nxt"), F.lit(True).alias("mostly_small"))
    of_word = capital.groupBy(*by).agg(F.sum("k").alias("of_word"))
    of_nxt = capital.groupBy("lang", "nxt").agg(F.sum("k").alias("of_nxt"))
    of_all = capital.groupBy("lang").agg(F.sum("k").alias("of_all"))
    collocations = capital.join(kinds, by, "left").where(
        (F.col("k") > 1) & (F.col("may_end").isNotNull() | (F.col("word") == _NUM) | F.col("word").rlike(r"^\p{L}(\.\p{L})*$"))).join(
        of_word, by).join(of_nxt, ["lang", "nxt"]).join(F.broadcast(of_all), "lang")
    # numbers and abbreviations that may end sentences: only with a word that begins no sentences, elsewhere has its capital too
    collocations = collocations.join(first, ["lang", "nxt"], "left").join(small, ["lang", "nxt"], "left")
    others, elsewhere = F.col("of_nxt") - F.col("k"), F.col("of_all") - F.col("of_word")
    collocations = collocations.where(F.col("k") * elsewhere > others * F.col("of_word")).withColumn(
        "score", _llr(F.col("k"), F.col("of_word"), others, elsewhere)).where("score > 7.88").where(
        ((F.col("word") != _NUM) & (F.coalesce("may_end", F.lit(0)) <= 0.3)) | (F.col("first").isNull() & F.col("mostly_small").isNull() & (F.col("k") > others))).select(
        "lang", F.concat_ws(" ", "word", "nxt").alias("word"), "score")
    frequent = words.where(F.col("word") != _NUM).withColumn("score", F.col("total") / F.col("all_n"))

    def entries(df: DataFrame, kind: str, most: int, rate: str = "cast(0 as double)") -> DataFrame:
        return df.selectExpr("lang", f"'{kind}' as kind", "word", f"{rate} as rate", "cast(score as double) as score", f"{most} as most")

    found = cut(entries(enders, "A", model_size, "if(goes_on < 0.02 and rate > 0.3, 1.0, if(rate > 0.3, 0.5, 0.0))").unionByName(
        entries(collocations, "D", model_size)).unionByName(entries(starters, "S", model_size, "small")).unionByName(entries(frequent.where("score > 1e-3"), "F", 150)))
    # the strongest of each language: what lies under a quantile that leaves more than them is gone before they are brought together
    halves = [1 - 2.0**-k for k in range(40)]
    at = F.greatest(F.floor(F.log2(F.col("k") / F.col("most"))), F.lit(0)).cast("int")
    least = found.groupBy("lang", "kind", "most").agg(F.count("*").alias("k"), F.percentile_approx("score", halves, 10_000).alias("q")).select("lang", "kind", F.get("q", at).alias("least"))
    strongest = found.join(F.broadcast(least), ["lang", "kind"]).where("score >= least").groupBy("lang", "kind").agg(
        F.sort_array(F.collect_list(F.struct("score", "word", "rate")), False).alias("x"), F.max("most").alias("most"))
    model: dict = {}
    for r in strongest.select("lang", "kind", F.expr("slice(x, 1, most)").alias("x")).collect():
        model.setdefault(r["lang"], {})[r["kind"]] = {x["word"]: (x["score"], x["rate"]) for x in r["x"]}
    drop(found)
    drop(events)
    return model


class Splitter:
    """Splits texts by a learned model."""

    def __init__(self, model: dict):
        self.model = model
        self.none: dict = {}

    def of(self, lang: str, text: str) -> dict:
        """The model of a language, or of the language whose frequent words a text shares most."""
        if lang and lang in self.model:
            return self.model[lang]
        words = Counter(m.group().lower() for m in _WORD.finditer(text))
        best, most = "", 0.0
        for code in sorted(self.model):
            if not code.startswith("und-"):
                f = self.model[code].get("F", {})
                hit = sum(n for w, n in words.items() if w in f)
                if hit > most:
                    best, most = code, hit
        return self.model.get(best) or self.model.get("und-" + _script(text)) or self.none

    def ends(self, text: str, lang: str | None) -> list[int]:
        """Offsets after the last character of each sentence of ``text``."""
        if not text or text.isspace():
            return []
        m = self.of(_language(lang), text)
        abbr, pairs, starters = m.get("A", {}), m.get("D", {}), m.get("S", {})
        low, n = _starts_low(text), len(text)
        out: list[int] = []
        begin = 0
        stack: list[tuple[str, bool]] = []
        upto = 0  # marks before this offset are used up

        def close(at: int) -> None:
            nonlocal begin
            piece = text[begin:at]
            stripped = piece.rstrip()
            if any(c.isalnum() for c in stripped):
                out.append(begin + len(stripped))
                begin = at
            elif stripped and out:  # nothing but marks: they belong to the sentence before
                out[-1] = begin + len(stripped)
                begin = at

        for hit in _SCAN.finditer(text):
            a, z = hit.span()
            if a < upto:
                continue
            mark = hit.group()
            if mark.isspace():
                if mark.count("\n") > 1:
                    stack.clear()
                    close(a)
                elif not stack and text[:a].endswith(THAI_FINAL):
                    close(a)
                continue
            top = stack[-1][0] if stack else ""
            if mark in top and mark:
                _, at_start = stack.pop()
                if stack:
                    continue
                bare = mark in ")）]】"
                before = text[begin : a].rstrip()
                if not before or before[-1] not in STRONG + ".…|":
                    continue
                if self._after_closed(text, z, at_start, bare, low):
                    close(z)
                continue
            if mark in CLOSER_OF:
                closer = CLOSER_OF[mark]
                stop = text.find("\n\n", z)
                found = [p for c in closer if (p := text.find(c, z, stop if stop >= 0 else n)) >= 0]
                if found:
                    stack.append((closer, not any(c.isalnum() for c in text[begin:a])))
                continue
            if stack or mark in CLOSERS:
                continue
            if mark[0] == "|" and not regex.search(r"\p{Devanagari}\s*$", text[max(0, a - 4) : a]):
                continue
            e = z
            while e < n and text[e] in STRONG + ".…":
                e += 1
            while e < n and text[e] in CLOSERS and text[e] not in CLOSER_OF:
                e += 1
            upto = e
            if mark[0] in "!?" and e < n and text[e].isalnum() and ord(text[e]) < 0x2E80:
                continue
            if mark[0] in ".…" and not self._period(text, begin, a, e, mark, abbr, pairs, starters, low):
                continue
            close(e)
        close(n)
        return out

    @staticmethod
    def _after_closed(text: str, z: int, at_start: bool, bracket: bool, low: bool) -> bool:
        """Whether a sentence ends with a quotation or bracket that closes at ``z`` after a final mark."""
        at = _SPACES.match(text, z).end()
        if at == len(text) or "\n\n" in text[z:at]:
            return True
        after, spaced = text[at : at + 1], at > z
        if after[0] in STRONG + ".…,;:，、；：":
            return False
        if not at_start:
            letter = _LETTER.search(text, at)
            return not bracket and not low and bool(letter) and letter.group().isupper() and spaced
        if text.startswith(JA_QUOTE_GOES_ON, at) and not spaced:
            return False
        return low or not after[0].islower()

    @staticmethod
    def _period(text, begin, a, e, mark, abbr, pairs, starters, low) -> bool:
        """Whether the period or ellipsis at ``a``..``e`` ends a sentence."""
        at = _SPACES.match(text, e).end()
        if at == len(text) or "\n\n" in text[e:at].replace(" ", ""):
            return True
        after, spaced = text[at], at > e
        nxt = _WORD.search(text, at)
        word = nxt.group() if nxt else ""
        w = _norm(word) if word else ""
        z = a
        while z > begin and not _TOKEN_CHAR.match(text[z - 1]):
            z -= 1
        k = z
        while k > begin and _TOKEN_CHAR.match(text[k - 1]):
            k -= 1
        tail = _TOKEN.findall(text[k:z])
        prev = tail[-1] if tail and text[a - 1 : a].strip() else ""
        if mark[0] == "…" or len(mark) > 1:
            spoken = _norm(tail[-1]) if tail else ""
            return bool(word) and word[0].isupper() and w != spoken and bool(prev) and (w in starters)
        if mark[0] == "." and not spaced and (after.isalnum() or after in ",;:'’-/"):
            return False
        if after in ",;:":
            return False
        p = _norm(prev)
        joined = f"{p} {w}" in pairs
        if p == _NUM:
            return not joined
        # a capitalised starter begins a sentence after an abbreviation or initial, unless it belongs to it or is an initial itself
        begins = not low and word[:1].isupper() and not joined and starters.get(w, (0, 0))[1] >= 0.5 and not (
            len(word) == 1 and text[nxt.end() : nxt.end() + 1] == ".")
        initials = bool(prev) and all(len(x) == 1 and x.isupper() for x in prev.split("."))
        if p in abbr:
            ends = abbr[p][1]
            if ends >= 0.5:
                return (low and (w in starters or ends == 1.0)) or not after.islower() and not joined
            return begins
        return not initials or begins


def sentence_ends(docs: DataFrame, key: str, text: str, lang: str, model: dict | None = None) -> DataFrame:
    """(key, end_pos INT): a row for each sentence of each row of ``docs``.

    end_pos counts code points up to the sentence's last character, with its final marks,
    closing quotes and brackets, without white space after it.  Null and blank texts have no
    sentence; a null language is replaced by the one whose frequent words the text shares; a
    text without any final mark is one sentence (blank lines still part it).  Repeated rows
    repeat their sentences; a null key stays null; other columns are not read.  Texts are
    processed whole, each on its own, so neither length nor skew gathers rows anywhere.
    """
    if model is None:
        model = learn(docs, text, lang)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Splitter(shared.value)
        for b in batches:
            at, ends = [], []
            for i, (t, code) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                x = split.ends(t, code) if t else []
                at += [i] * len(x)
                ends += x
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(ends, pa.int32())], [key, "end_pos"])

    of_key = docs.select(key).schema[0].dataType.simpleString()
    return spread(docs.select(key, text, lang)).mapInArrow(run, f"`{key}` {of_key}, end_pos int")
