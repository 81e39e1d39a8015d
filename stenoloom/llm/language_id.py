"""Languages of documents and of their stretches, by prediction by partial matching.

Per language a byte context tree of variable order holds how often which byte follows which
context inside words.  Its frozen statistics give every word an exact code length in bits, with
escapes to shorter contexts; the language with the shortest code has a text, and a cheapest
path over the sentences finds where a text changes its language.
"""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stenoloom.operators.order import spread

# The two-letter codes of languages (ISO 639-1).
CODES = frozenset(
    "aa ab ae af ak am an ar as av ay az ba be bg bh bi bm bn bo br bs ca ce ch co cr cs cu cv cy da de dv dz ee el en eo es et eu "
    "fa ff fi fj fo fr fy ga gd gl gn gu gv ha he hi ho hr ht hu hy hz ia id ie ig ii ik io is it iu ja jv ka kg ki kj kk kl km kn "
    "ko kr ks ku kv kw ky la lb lg li ln lo lt lu lv mg mh mi mk ml mn mr ms mt my na nb nd ne ng nl nn no nr nv ny oc oj om or os "
    "pa pi pl ps pt qu rm rn ro ru rw sa sc sd se sg si sk sl sm sn so sq sr ss st su sv sw ta te tg th ti tk tl tn to tr ts tt tw "
    "ty ug uk ur uz ve vi vo wa wo xh yi yo za zh zu".split()
)

ORDER = 6
_RUN = regex.compile(r"[\p{L}\p{M}]+")
_SENTENCE = regex.compile(r"[^.!?؟。！？।॥\n]+")
#: Bits that a change of language costs: less than any whole sentence gains, more than a stray fragment does.
SWITCH_BITS = 32.0


def language_code(label):
    """The two-letter code a label names, in any case and with any region; null if it names none."""
    code = F.lower(F.regexp_extract(F.trim(label), r"^([A-Za-z]{2})(?:[-_].*)?$", 1))
    return F.when(code.isin(*sorted(CODES)), code)


def _tokens(text: str) -> list[bytes]:
    return [(" " + w).encode() for w in _RUN.findall(unicodedata.normalize("NFKC", text).lower())]


class ContextTree:
    """Byte statistics of one language, frozen: bits of a byte in a context and of an escape from it."""

    def __init__(self, counts: Counter):
        sym: Counter = Counter()
        for tok, n in counts.items():
            for i in range(1, len(tok) + 1):
                end = tok[i : i + 1] or b" "  # a word ends with a space
                for k in range(min(ORDER, i) + 1):
                    sym[tok[i - k : i] + end] += n
        total: Counter = Counter()
        distinct: Counter = Counter()
        for key, n in sym.items():
            if len(key) <= 3 or n > 1:
                total[key[:-1]] += n
                distinct[key[:-1]] += 1
        self.bits = {}
        self.escape = {c: log2((total[c] + distinct[c]) / distinct[c]) for c in total}
        for key, n in sym.items():
            if len(key) <= 3 or n > 1:
                c = key[:-1]
                self.bits[key] = log2((total[c] + distinct[c]) / n)

    def length(self, tok: bytes) -> float:
        """Code length of a word in bits."""
        bits, escape, out, top = self.bits, self.escape, 0.0, 0
        tok += b" "  # a word ends with a space
        for i in range(1, len(tok)):
            # a context that occurs begins with one that occurs, so the longest grows by one at most
            top = min(ORDER, top + 1)
            while tok[i - top : i] not in escape and top:
                top -= 1
            for k in range(top, -1, -1):
                b = bits.get(tok[i - k : i + 1])
                if b is not None:
                    out += b
                    break
                out += escape.get(tok[i - k : i], 0.0)
            else:
                out += 8.0
        return out


class Models:
    """The trees of all languages and a memory of the words coded last.

    ``scale`` says how many bits of difference count as one: code lengths of bytes that depend on
    each other overstate what a text tells, by a factor that is fitted where texts are held out.
    """

    def __init__(self, trees: dict[str, ContextTree], scale: float = 1.0):
        self.languages = sorted(trees)
        self.trees = [trees[x] for x in self.languages]
        self.scale = scale
        self.known: dict[bytes, np.ndarray] = {}

    def lengths(self, tok: bytes) -> np.ndarray:
        v = self.known.get(tok)
        if v is None:
            if len(self.known) > 200_000:
                self.known.clear()
            v = np.array([tree.length(tok) for tree in self.trees])
            if len(tok) <= 64:
                self.known[tok] = v
        return v

    def sentences(self, text: str) -> np.ndarray:
        """Code lengths (sentence, language) of the sentences that have letters."""
        rows = []
        for m in _SENTENCE.finditer(text):
            toks = _tokens(m.group())
            if toks:
                rows.append(np.sum([self.lengths(t) for t in toks], axis=0))
        return np.array(rows).reshape(len(rows), len(self.languages))

    def best(self, text: str) -> str | None:
        s = self.sentences(text)
        return self.languages[int(s.sum(0).argmin())] if len(s) else None

    def stretches(self, text: str) -> list[tuple[str, float, int]]:
        """(language, confidence, sentences) of the longest runs of sentences in one language."""
        cost = self.sentences(text)
        if not len(cost):
            return []
        path = np.empty(cost.shape, np.int64)
        at = cost[0]
        own = np.arange(cost.shape[1])
        for i in range(1, len(cost)):
            j = int(at.argmin())
            change = at[j] + SWITCH_BITS
            path[i] = np.where(at <= change, own, j)
            at = np.minimum(at, change) + cost[i]
        lang = [int(at.argmin())]
        for i in range(len(cost) - 1, 0, -1):
            lang.append(int(path[i, lang[-1]]))
        lang.reverse()
        out, begin = [], 0
        for i in range(1, len(lang) + 1):
            if i == len(lang) or lang[i] != lang[begin]:
                total = cost[begin:i].sum(0)
                odds = np.exp2(np.maximum((total[lang[begin]] - total) / self.scale, -1000.0))
                out.append((self.languages[lang[begin]], float(1 / odds.sum()), i - begin))
                begin = i
        return out


#: Scales of confidence that are tried.
SCALES = tuple(2.0 ** (k / 4) for k in range(0, 33))


def fitted_scale(lengths: list[tuple[np.ndarray, int]]) -> float:
    """The scale under which the true languages of (code lengths, its number) are the least surprise."""
    if not lengths:
        return 1.0
    gain = np.array([v[k] - v for v, k in lengths])  # bits for the true language against each
    loss = [np.log2(np.exp2(np.clip(gain / s, -1000, 1000)).sum(1)).mean() for s in SCALES]
    return SCALES[int(np.argmin(loss))]


def train(rows: list[tuple[str, str]]) -> tuple[dict[str, ContextTree], float]:
    """(trees, scale of confidence) from (label, text) rows of which some labels are wrong.

    Each half of the rows is judged by trees of the other half; a row stays only if it gets
    its own label, a language only if most of its rows stay.  The final trees are of what stays.
    The scale is fitted to the single sentences of the rows that stay and are in one language, as
    they are judged by the half they are not in.
    """
    def trees(some: list[tuple[str, str]]) -> dict[str, ContextTree]:
        counts: dict[str, Counter] = defaultdict(Counter)
        for code, text in some:
            counts[code].update(_tokens(text))
        return {c: ContextTree(n) for c, n in counts.items() if n}

    kept: list[tuple[str, str]] = []
    seen: Counter = Counter()
    told: list[tuple[np.ndarray, int]] = []
    for odd in (0, 1):
        judge = trees(rows[odd::2])
        if not judge:
            continue
        models = Models(judge)
        for code, text in rows[1 - odd :: 2]:
            seen[code] += 1
            lengths = models.sentences(text)
            if len(lengths) and models.languages[int(lengths.sum(0).argmin())] == code:
                kept.append((code, text))
                if len(models.stretches(text)) == 1:
                    told += [(v, models.languages.index(code)) for v in lengths]
    stay = Counter(c for c, _ in kept)
    good = {c for c in seen if stay[c] * 2 > seen[c]}
    most = max((len(v) for v, _ in told), default=0)
    told = [x for x in told if len(x[0]) == most]  # where one half lacks a language its lengths are no comparison
    return trees([r for r in kept if r[0] in good] or rows), fitted_scale(told)


def _pieces(text: str, longest: int) -> Iterator[str]:
    """A text in pieces of whole sentences of at most ``longest`` characters (words, where a sentence is longer)."""
    at = 0
    while len(text) - at > longest:
        part = text[at : at + longest]
        end = 1 + max(part.rfind(c) for c in ".!?؟。！？।\n")
        end = end or 1 + max(part.rfind(c) for c in " \t") or longest
        yield text[at : at + end]
        at += end
    yield text[at:]


def training_rows(docs: DataFrame, text: str, lang: str, sample: int = 200, longest: int = 20_000) -> list[tuple[str, str]]:
    """A bounded sample of the labelled texts: about ``sample`` distinct ones of each code, chosen by a hash
    of the text, three times as many of a code at most; texts above ``longest`` characters go in as pieces."""
    labelled = docs.select(F.col(text).alias("t"), language_code(F.col(lang)).alias("c")).where(F.col("c").isNotNull() & F.col("t").rlike(r"\p{L}"))

    def cut_long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                parts = list(_pieces(t, longest))
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.string()), pa.array([c] * len(parts), pa.string())], ["t", "c"])

    long = labelled.where(F.length("t") > longest).mapInArrow(cut_long, "t string, c string").where(F.col("t").rlike(r"\p{L}"))
    labelled = labelled.where(F.length("t") <= longest).unionByName(long)
    h = F.xxhash64("t")
    n = {r["c"]: r["count"] for r in labelled.select("c", h.alias("h")).distinct().groupBy("c").count().collect()}
    if not n:
        return []
    share = F.create_map(*[x for c, k in sorted(n.items()) for x in (F.lit(c), F.lit(min(1.0, sample / k)))])
    at = F.pmod(h, F.lit(1 << 20)) / float(1 << 20)
    # the filter leaves some ``sample`` distinct texts of a code, so a code's window is small
    some = labelled.where(at < share[F.col("c")]).distinct()
    order = Window.partitionBy("c").orderBy(F.xxhash64("t", F.lit(1)), "t")
    some = some.withColumn("k", F.row_number().over(order)).where(F.col("k") <= 3 * sample).orderBy("c", "k")
    return [(r["c"], r["t"]) for r in some.collect()]


def stretches(docs: DataFrame, key: str, text: str, lang: str, sample: int = 200) -> DataFrame:
    """(key, label, seg_no, lang, confidence, n_sentences, is_case): every stretch of every text.

    ``label`` is the code that the column ``lang`` names (null: none), ``lang`` the code found,
    ``confidence`` its share of the probability over all languages by code length, on the scale
    that held-out sentences fit, ``is_case``
    whether the document's label is missing or wrong or its text in several languages.  The trees
    are fitted to a bounded sample of the labelled rows (see :func:`training_rows`), all rows
    are judged whole.  Null, empty and wordless texts have no stretch; repeated rows repeat
    theirs; without any labelled row there is no language and no row comes out; other columns
    are not read.
    """
    spark = docs.sparkSession
    model = train(training_rows(docs, text, lang, sample))
    shared = spark.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = Models(*shared.value) if shared.value[0] else None
        for b in batches:
            rows, out = [], []
            for i, (t, label) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                found = models.stretches(t) if t and models else []
                case = len(found) > 1 or bool(found) and found[0][0] != label
                for no, (code, sure, n) in enumerate(found):
                    rows.append(i)
                    out.append((no + 1, code, sure, n, case))
            at = pa.array(rows, pa.int64())
            cols = list(zip(*out)) or [[]] * 5
            types = (pa.int32(), pa.string(), pa.float64(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), b.column(2).take(at), *(pa.array(c, t) for c, t in zip(cols, types))],
                ["key", "label", "seg_no", "lang", "confidence", "n_sentences", "is_case"])

    of_key = docs.select(key).schema[0].dataType.simpleString()
    schema = f"key {of_key}, label string, seg_no int, lang string, confidence double, n_sentences int, is_case boolean"
    return spread(docs.select(F.col(key).alias("key"), F.col(text).alias("text"), language_code(F.col(lang)).alias("label"))).mapInArrow(
        run, schema).withColumnRenamed("key", key)


def wrong_labels(docs: DataFrame, key: str, text: str, lang: str, sample: int = 200) -> DataFrame:
    """(key, seg_no, lang): the stretches of documents whose label is missing or names another
    language than the text's, or whose text is in more than one language (see :func:`stretches`).

    The decision needs the first stretch and whether there is a second, so it is taken where
    the stretches are made: a document's rows carry it and nothing is shuffled.
    """
    found = stretches(docs, key, text, lang, sample)
    return found.where("is_case").select(key, "seg_no", "lang")
