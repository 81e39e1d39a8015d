"""Noise in text from scanned pages: furniture, words cut at line ends, misread characters."""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stenoloom.operators.order import spread
from stenoloom.operators.skew import lookup_join
from stenoloom.plans.durable import cut

HYPHENS = "-‐‑¬­"
#: How many lines from either edge of a page may be furniture.
EDGE = 3
BLOCK = 8
#: Most words a worker holds of the word list; longer lists are refused, not cut.
MOST_WORDS = 2_000_000

# What scanning takes for what (read : right).
CONFUSIONS = (
    ("0", "o"), ("1", "l"), ("1", "i"), ("!", "i"), ("!", "l"), ("|", "l"), ("|", "i"), ("5", "s"), ("9", "g"), ("6", "b"), ("8", "b"),
    ("l", "i"), ("i", "l"), ("c", "e"), ("e", "c"), ("c", "o"), ("o", "c"), ("b", "h"), ("h", "b"), ("f", "t"), ("t", "f"), ("u", "n"), ("n", "u"),
    ("m", "rn"), ("rn", "m"), ("m", "in"), ("m", "ni"), ("vv", "w"), ("cl", "d"), ("d", "cl"), ("ii", "u"), ("u", "ii"), ("ri", "n"), ("n", "ri"),
    ("li", "h"), ("h", "li"), ("$", "s"), ("@", "a"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff"), ("ﬃ", "ffi"), ("ﬄ", "ffl"),
)
_SKELETON = (("rn", "m"), ("ri", "n"), ("vv", "w"), ("cl", "d"), ("ii", "u"), ("li", "h"))
_SKELETON_CHARS = str.maketrans("01!|i5968cfb", "ollllsgbbeth")

_NUMBER = r"[0-9OoIl|!S]*[0-9][0-9OoIl|!S]*"
_PAGE_NO = regex.compile(
    rf"^\s*(?P<deco>[\[(\-–—]\s*|p(?:age|g)?\.?\s+|sheet\s+|fol(?:io)?\.?\s+)?(?P<n>{_NUMBER}|[OIl|!]{{1,4}})(?P<of>\s*(?:of|/)\s*(?:{_NUMBER}|[A-Za-z]))?\s*(?P<end>[\])\-–—])?\s*$", regex.I)
_NUM_TOKEN = regex.compile(rf"(?<![\p{{L}}\p{{N}}])(?:p(?:age|g)?\.?\s+)?(?:{_NUMBER})(?:\s*(?:of|/)\s*(?:{_NUMBER}|[a-z](?![a-z])))?(?![\p{{L}}\p{{N}}])", regex.I)
#: The end of a line of running text.
_GOES_ON = regex.compile(r"(?:[.,;:?!\"'”’]|\p{L}[-‐‑¬\u00ad])\s*$")
_MARKS = ".,;:!?\"'“”‘’()[]{}«»"


def plain(word: str) -> str:
    """A word in lower case without marks at its ends."""
    return word.strip(_MARKS + HYPHENS + "–—*").lower()


def line_form(line: str) -> str:
    """A line's form under which running headers and footers repeat: without page numbers,
    case and spacing, and with characters that scanning confuses made alike."""
    text = unicodedata.normalize("NFKD", line)
    text = "".join(c for c in text if not unicodedata.combining(c))
    text = _NUM_TOKEN.sub(" ", text).lower()
    for a, b in _SKELETON:
        text = text.replace(a, b)
    text = text.translate(_SKELETON_CHARS)
    return regex.sub(r"[^\p{L}]+", " ", text).strip()


def page_number(line: str) -> tuple[int, bool] | None:
    """(number, decorated) of a line that is nothing but a page number."""
    m = _PAGE_NO.match(line)
    if not m:
        return None
    digits = m["n"].translate(str.maketrans("OoIl|!Ss", "00111155"))
    decorated = bool(m["deco"] and (m["end"] or m["deco"].strip()[-1:].isalpha() or m["deco"].strip().endswith("."))) or bool(m["of"])
    if not digits.isdigit():
        return None
    return int(digits), decorated


def _edges(lines: list[str]) -> list[int]:
    """Numbers of the non-blank lines near the edges of a page."""
    full = [i for i, x in enumerate(lines) if x.strip()]
    return sorted(set(full[:EDGE] + full[-EDGE:]))


def furniture_forms(pages: DataFrame, page: str, files: int = 3) -> DataFrame:
    """(block, forms, offs): the repeated edge lines of each block of pages and how its printed
    page numbers differ from the page count.

    A block is BLOCK pages of one file, and every page is in two blocks that overlap by half, as
    one file may hold many records with headers of their own.  A form is furniture of a block
    when it stands near an edge on two of its pages or more; on half of its pages where it ends as
    running text may; or on one, when it is furniture of ``files`` files and of a quarter of those
    that have it near an edge.  Blocks are small whatever the size of a file or of the collection,
    so neither weighs on one task, and forms reach pages by their block and not through the driver.
    """
    def edge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for file, no, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                lines = (text or "").split("\n")
                for i in _edges(lines):
                    n = page_number(lines[i])
                    form = "" if n else line_form(lines[i])
                    off = n[0] - no if n and no is not None else None
                    if off is not None or form:
                        out.append((file, no, form, off, bool(form and _GOES_ON.search(lines[i]))))
            cols = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.bool_()))], ["file_idx", "page_idx", "form", "off", "runs"])

    rows = spread(pages.select("file_idx", "page_idx", page)).mapInArrow(edge, "file_idx int, page_idx int, form string, off bigint, runs boolean").where("page_idx is not null")
    both = rows.select("*", F.explode(F.array(*_blocks())).alias("block"))
    counted = cut(both.groupBy("block", "file_idx", "form", "off").agg(F.count_distinct("page_idx").alias("n"), F.min("runs").alias("runs")).withColumn(
        "own", (F.col("n") >= 2) & (~F.col("runs") | (F.col("n") >= BLOCK // 2))))
    forms = counted.where("form <> ''")
    shared = forms.groupBy("form", "file_idx").agg(F.max("own").cast("int").alias("own")).groupBy("form").agg(F.sum("own").alias("owners"), F.count("*").alias("held"))
    shared = shared.where((F.col("owners") >= files) & (F.col("owners") * 4 >= F.col("held"))).select("form", F.lit(True).alias("common"))
    found = lookup_join(forms, shared, "form").where("own or common").select("block", "form", F.lit(None).cast("bigint").alias("off"))
    numbers = counted.where("off is not null and n >= 2").groupBy("block").agg(F.max(F.struct("n", "off")).getField("off").alias("off")).select(
        "block", F.lit(None).cast("string").alias("form"), "off")
    return found.unionByName(numbers).groupBy("block").agg(F.sort_array(F.collect_set("form")).alias("forms"), F.max("off").alias("off"))


def _blocks() -> list:
    """Keys of the two blocks of a page."""
    def key(half: str, shift: int):
        return F.concat_ws("/", F.coalesce(F.col("file_idx").cast("string"), F.lit("-")), F.lit(half), F.floor((F.col("page_idx") + shift) / BLOCK).cast("string"))

    return [key("a", 0), key("b", BLOCK // 2)]


def cut_words(lines: list[str]) -> Iterator[tuple[str, str, str]]:
    """(first part, second part, mark) of the words cut at ends of lines."""
    full = [x.split() for x in lines if x.strip()]
    for one, two in zip(full, full[1:]):
        last = one[-1]
        if last[-1] in HYPHENS and len(last) > 1 and last[-2].isalnum():
            yield last.rstrip(HYPHENS), two[0], last[-1]


def counted_cuts(pages: DataFrame, page: str) -> DataFrame:
    """(page_id, counts): of the cut words of each page how often they stand whole in all pages,
    in lower case without marks at their ends, joined and with a hyphen."""
    of_key = pages.schema["page_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, out, tokens = [], [], Counter()
            for i, text in enumerate(b.column(1).to_pylist()):
                tokens.update((text or "").split())
                for form in {plain(x) for h, t, _ in cut_words((text or "").split("\n")) for x in (h + t, h + "-" + t)}:
                    at.append(i)
                    out.append(form)
            counts: Counter = Counter()
            for w, n in tokens.items():
                if w[-1] not in HYPHENS and (p := plain(w)):
                    counts[p] += n
            keys = pa.concat_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.nulls(len(counts), b.column(0).type)])
            yield pa.RecordBatch.from_arrays([keys, pa.array(out + list(counts), pa.string()), pa.array([None] * len(out) + list(counts.values()), pa.int64())], ["page_id", "word", "n"])

    found = cut(spread(pages.select("page_id", page)).mapInArrow(read, f"page_id {of_key}, word string, n bigint"))
    wanted = found.where("n is null and page_id is not null").drop("n")
    counts = found.where("n is not null").join(wanted.select("word").distinct(), "word", "left_semi").groupBy("word").agg(F.sum("n").alias("n"))
    return lookup_join(wanted, counts, "word", how="inner").groupBy("page_id").agg(F.map_from_entries(F.collect_set(F.struct("word", "n"))).alias("counts"))


class Repairer:
    """Finds and mends the noise of one page."""

    def __init__(self, vocabulary: list[str]):
        self.words = {w.lower() for w in vocabulary if w}
        self.known: dict[tuple[str, bool], str | None] = {}
        reads = defaultdict(list)
        for a, b in CONFUSIONS:
            reads[a].append(b)
        self.reads = dict(reads)
        self.holes: dict[tuple[str, str], set[str]] = defaultdict(set)
        for w in self.words:
            for i in range(len(w)):
                self.holes[w[:i], w[i + 1 :]].add(w)

    def right(self, word: str, name: bool) -> str | None:
        """The listed word that ``word`` is a misreading of; null where it is right or unknown."""
        key = (word, name)
        if key not in self.known:
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[key] = self._right(word, name)
        return self.known[key]

    def _right(self, word: str, name: bool) -> str | None:
        if word in self.words or len(word) < 2 or not any(c.isalpha() for c in word):
            return None
        bare = "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))
        if bare != word and bare in self.words:
            return bare
        frontier, seen = {bare}, {bare}
        for depth in range(2):
            found, nxt = set(), set()
            for w in frontier:
                for i in range(len(w)):
                    for k in (1, 2):
                        for b in self.reads.get(w[i : i + k], ()) if i + k <= len(w) else ():
                            v = w[:i] + b + w[i + k :]
                            if v in self.words:
                                found.add(v)
                            elif v not in seen:
                                nxt.add(v)
            found = {f for f in found if len(f) > 3 or any(not c.isalpha() for c in word) or depth == 0 and len(word) > 2}
            if found:
                return min(found)
            if len(word) < 5 and all(c.isalpha() for c in word):
                return None
            frontier, seen = nxt, seen | nxt
        if len(word) >= 5 and not name:
            found = {v for i in range(len(bare)) for v in self.holes.get((bare[:i], bare[i + 1 :]), ())}
            if len(found) == 1:
                return found.pop()
        return None

    def furniture(self, lines: list[str], page_idx: int | None, forms: list[str], offs: list[int]) -> set[int]:
        own = set(forms)
        full = [i for i, x in enumerate(lines) if x.strip()]
        out: set[int] = set()
        for order in (full[:EDGE], full[::-1][:EDGE]):
            for i in order:
                line = lines[i]
                n = page_number(line)
                if n is not None:
                    hit = n[1] or page_idx is not None and n[0] - page_idx in offs
                else:
                    form = line_form(line)
                    hit = bool(form) and (form in own or len(form) > 5 and any(_alike(form, f) for f in own))
                if not hit:
                    break
                out.add(i)
        return out

    def page(self, text: str, page_idx: int | None, forms: list[str], offs: list[int], counts: dict[str, int]) -> tuple[list[tuple[int, str, str]], list[str]]:
        """((line_no, kind, word), ...) and the repaired paragraphs."""
        lines = text.split("\n")
        noise = self.furniture(lines, page_idx, forms, offs)
        found = [(i + 1, "furniture", "") for i in sorted(noise)]
        paragraphs: list[list[str]] = [[]]
        carried = None  # first part of a cut word and its line
        for i, line in enumerate(lines):
            if i in noise:
                continue
            words = line.split()
            if not words:
                if paragraphs[-1] and carried is None:
                    paragraphs.append([])
                continue
            if carried is not None:
                at, head, mark = carried
                carried = None
                whole = self._join(head, words[0], mark, counts)
                if whole is None:
                    paragraphs[-1].append(head + mark)
                else:
                    fixed = plain(whole)
                    right = self.right(fixed, False)
                    found.append((at + 1, "hyphen", right or fixed))
                    paragraphs[-1].append(_put(whole, fixed, right))
                    words = words[1:]
            if words and words[-1][-1] in HYPHENS and len(words[-1]) > 1 and words[-1][-2].isalnum():
                carried = (i, words[-1].rstrip(HYPHENS), words[-1][-1])
                words = words[:-1]
            for k, w in enumerate(words):
                p = plain(w)
                if not p and w.strip("\"'“”‘’()[].,;:?"):
                    p = w.strip("\"'“”‘’()[].,;:?").lower()
                right = None
                for q in dict.fromkeys((w.strip("\"'“”‘’()[]{}.,;:?*–—" + HYPHENS).lower(), p)):
                    if q in self.words:
                        break
                    right = right or self.right(q, w[:1].isupper() and k > 0)
                else:
                    if right:
                        found.append((i + 1, "char", right))
                paragraphs[-1].append(_put(w, p, right))
        if carried is not None:
            paragraphs[-1].append(carried[1] + carried[2])
        return found, [" ".join(p) for p in paragraphs if p]

    def _join(self, head: str, tail: str, mark: str, counts: dict[str, int]) -> str | None:
        """The word cut into ``head`` and ``tail``: joined if the word list has it so, with a
        hyphen if it has it so, else as it stands whole more often in the corpus; where it never
        does, joined unless the second part begins large."""
        if not tail[:1].isalnum() and tail[:1] not in "!|":
            return None
        joined, kept = head + tail, head + "-" + tail
        for whole in (joined, kept):
            if plain(whole) in self.words:
                return whole
        for whole in (joined, kept):
            if self.right(plain(whole), False):
                return whole
        seen = [counts.get(plain(whole), 0) for whole in (joined, kept)]
        if seen[0] != seen[1]:
            return joined if seen[0] > seen[1] else kept
        return kept if tail[:1].isupper() and mark == "-" else joined


def _put(word: str, was: str, right: str | None) -> str:
    """``word`` with its misread part put right, in its own case and with its marks."""
    if not right:
        return word
    at = word.lower().find(was)
    if at < 0:
        return right
    new = right.upper() if len(was) > 1 and word[at : at + len(was)].isupper() else right.capitalize() if word[at : at + 1].isupper() else right
    return word[:at] + new + word[at + len(was) :]


def _alike(a: str, b: str) -> bool:
    """Whether two forms differ in at most an eighth of their characters."""
    most = max(len(a), len(b)) // 8
    if most == 0 or abs(len(a) - len(b)) > most:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        if min(row) > most:
            return False
    return row[-1] <= most


def _repair(pages: DataFrame, vocabulary: DataFrame, text: str, paragraphs: bool) -> DataFrame:
    spark = pages.sparkSession
    rows = pages.select("page_id", F.col("file_idx").cast("int").alias("file_idx"), F.col("page_idx").cast("int").alias("page_idx"), text)
    forms = cut(furniture_forms(rows, text))
    listed = sorted(r[0] for r in vocabulary.select("word").where("word is not null").distinct().take(MOST_WORDS + 1))
    if len(listed) > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} words in the list")
    shared = spark.sparkContext.broadcast(listed)
    one, two = (forms.select(F.col("block").alias(k), F.col("forms").alias("forms_" + k), F.col("off").alias("off_" + k)) for k in "ab")
    a, b = _blocks()
    # what belongs to a page is put together by its place, and meets the texts in one join
    empty = F.array().cast("array<string>")
    places = rows.select("file_idx", "page_idx").distinct().withColumn("a", a).withColumn("b", b).join(one, "a", "left").join(two, "b", "left").select(
        "file_idx", "page_idx", F.array_union(F.coalesce("forms_a", empty), F.coalesce("forms_b", empty)).alias("forms"), F.array_compact(F.array("off_a", "off_b")).alias("offs"))
    placed = rows.join(places.where("file_idx is not null and page_idx is not null"), ["file_idx", "page_idx"], "left")
    joined = placed.join(counted_cuts(rows, text), "page_id", "left").select("page_id", "page_idx", text, "forms", "offs", "counts")
    of_key = pages.select("page_id").schema[0].dataType.simpleString()
    schema = f"page_id {of_key}, " + ("par_no int, text string" if paragraphs else "line_no int, kind string, word string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mend = Repairer(shared.value)
        for b in batches:
            at, out = [], []
            for i, (no, t, f, offs, counts) in enumerate(zip(*(b.column(k).to_pylist() for k in range(1, 6)))):
                found, pars = mend.page(t, no, f or [], offs or [], dict(counts or ())) if t and not t.isspace() else ([], [])
                new = [(k + 1, p) for k, p in enumerate(pars)] if paragraphs else found
                at += [i] * len(new)
                out += new
            types = (pa.int32(), pa.string()) if paragraphs else (pa.int32(), pa.string(), pa.string())
            cols = list(zip(*out)) or [[]] * len(types)
            names = ["page_id", "par_no", "text"] if paragraphs else ["page_id", "line_no", "kind", "word"]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(cols, types))], names)

    return joined.mapInArrow(run, schema).distinct()


def page_findings(pages: DataFrame, vocabulary: DataFrame, text: str) -> DataFrame:
    """(page_id, line_no, kind, word): every piece of noise, once.

    ``pages`` has page_id, file_idx, page_idx and the text column, ``vocabulary`` a column word.
    kind ``furniture``: a line near an edge that repeats (fuzzily) on a page nearby,
    or that is furniture of many files, or a page number in step with the page count; ``hyphen``:
    a word cut at the end of the line (a word cut at the end of a page stays cut), ``char``: a listed word misread, told by the confusions of
    scanning, or by the one listed word that differs in a single character.
    Null, empty and blank pages have none; pages without a file or a number have no furniture that
    repeats; repeated rows count once; other columns are not read.
    """
    return _repair(pages, vocabulary, text, False)


def page_paragraphs(pages: DataFrame, vocabulary: DataFrame, text: str) -> DataFrame:
    """(page_id, par_no, text): the repaired running text of each page, see :func:`page_findings`."""
    return _repair(pages, vocabulary, text, True)
