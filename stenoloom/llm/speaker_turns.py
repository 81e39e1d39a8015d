"""Speech transcripts into clean, ordered speaker turns by a sweep over sorted page lines."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stenoloom.operators.order import spread
from stenoloom.operators.skew import lookup_join
from stenoloom.plans.durable import cut

# How speakers are addressed, and marks that a speaker goes on.
TITLES = frozenset("MR MRS MS MISS DR PROF PROFESSOR JUSTICE SHRI SMT SIR MADAM ADV ADVOCATE THE LEARNED HON'BLE HONBLE LORD LADY CHIEF".split())
_GOES_ON = r"(?:[(\[]\s*(?:contd|cont'd|cont|continuing|continued)\.?\s*[)\]])"

_TIME = r"[\[(<{]?\s*\d{1,2}[:.]\d{2}(?:[:.]\d{2})?(?:[.,]\d{1,3})?(?:\s*[ap]\.?m\b\.?)?(?:\s+IST)?\s*[\])>}]?"
_AHEAD = regex.compile(rf"^(?:\s+|>>+|-->|{_TIME}(?=\s|-->|[A-Za-z>])|\[[^\]]{{0,60}}\]|\{{[^}}]{{0,60}}\}}|<<?[^<>]{{0,60}}>>?|\*[^*]{{1,60}}\*)*", regex.I)
_LABEL = regex.compile(rf"([\p{{L}}][\p{{L}}\p{{N}}\p{{M}} .,'’\t]{{1,70}}?)\s*{_GOES_ON}?\s*(?::-|:|(?<=[\s)\]])(?:>|–|—|-)(?=\s|$))", regex.I)
#: Whole lines that are layout, whatever the collection.
_LAYOUT = regex.compile(
    r"^\s*(?:\d+|\[?\s*page\s+\d+(?:\s+of\s+\d+)?\s*\]?|\d{1,2}:\d{2}\s*[AP]M(?:\s+IST)?|\S+@\S+\.\S+|transcribed\s+by\s+\S+(?:\s+\S+)?|end\s+of\s+day'?s?\s+proceedings\W*)\s*$", regex.I)
_NOTES = regex.compile(r"\[[^\]]{0,200}\]|\([^)]{0,200}\)|<<[^<>]{0,200}>>|<[^<>]{0,200}>|\{[^}]{0,200}\}|\*[^*]{1,80}\*")
_TIMES = regex.compile(r"(?<!\S)\d{1,2}:\d{2}:\d{2}(?:[.,]\d{1,3})?(?!\S)|-->")
_HESITATION = regex.compile(r"(?<![\p{L}'’-])(?:u+h*m+|u+h+|e+r+m*|a+h+m*|h+m+|m{2,})(?![\p{L}'’-])(?:\s*(?:\.{2,}|…|,))?", regex.I)
_SPACE = regex.compile(r"\s+")


def spoken(raw: str) -> str:
    """What is said in ``raw``: without annotations, time marks and hesitation sounds."""
    text = _NOTES.sub(" ", raw)
    text = _TIMES.sub(" ", text)
    text = _HESITATION.sub(" ", text)
    return _SPACE.sub(" ", text).strip(" >")


def overlap(text: list[str], line: list[str]) -> int:
    """Words of the longest suffix of ``text`` that is a prefix of ``line``, in time linear in the line."""
    fall = [0] * len(line)  # of each prefix of the line the longest proper suffix that is a prefix too
    k = 0
    for i in range(1, len(line)):
        while k and line[i] != line[k]:
            k = fall[k - 1]
        k += line[i] == line[k]
        fall[i] = k
    k = 0
    for w in text[len(text) - min(len(text), len(line)) :]:
        while k and (k == len(line) or w != line[k]):
            k = fall[k - 1]
        k += w == line[k]
    return k


def join_captions(lines: list[str], least: int = 4) -> str:
    """Lines joined; of rolling captions the words that a line repeats from the end of the text
    so far (its longest suffix that is a prefix of the line, of ``least`` words or more) come once."""
    out: list[str] = []
    for line in lines:
        new = line.split()
        k = overlap(out, new) if len(new) >= least and len(out) >= least else 0
        out += new[k:] if k >= least else new
    return " ".join(out)


def _has_words(text: str) -> bool:
    return any(c.isalnum() for c in text)


def _close(a: str, b: str, most: int) -> int | None:
    """Edits (with transpositions) from a to b if at most ``most``, else null."""
    if abs(len(a) - len(b)) > most:
        return None
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                row[j] = min(row[j], before[j - 2] + 1)
        before = last
        if min(row) > most:
            return None
    return row[-1] if row[-1] <= most else None


class Cast:
    """Finds the speaker that a label means."""

    def __init__(self, speakers: list[tuple[str, str | None, str | None, str | None, str | None, str | None]]):
        self.surnames: dict[str, list[tuple[str, list[str]]]] = {}
        self.roles: dict[str, str] = {}
        self.joined: dict[str, str] = {}
        self.known: dict[str, str | None] = {}
        for spk, name, first, middle, surname, kind in sorted(speakers, key=lambda s: str(s[0])):
            if kind == "Role" or not surname:
                if name:
                    self.roles.setdefault(" ".join(name.upper().split()), spk)
                continue
            given = [g.upper() for g in (first, middle) if g]
            self.surnames.setdefault(surname.upper(), []).append((spk, given))
            for g in given:
                self.joined.setdefault(g + surname.upper(), spk)

    def find(self, label: str) -> str | None:
        if label not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[label] = self._find(label)
        return self.known[label]

    def _find(self, label: str) -> str | None:
        name = " ".join(regex.sub(r"[.\t]", " ", label.upper().replace("’", "'")).split())
        role = regex.sub(r"^THE ", "", name)
        if role in self.roles:
            return self.roles[role]
        if "," in name:
            surname, _, given = name.partition(",")
            given = given.split()
            surname = " ".join(w for w in surname.split() if w not in TITLES)
        else:
            words = name.split()
            while words and words[0] in TITLES:
                words = words[1:]
            if not words:
                return None
            surname, given = words[-1], words[:-1]
        given = [g for g in given if g not in TITLES]
        if not surname or len(given) > 3 or " " in surname:
            return None
        best: list[tuple[int, str]] = []
        if surname in self.surnames:
            best = [(self._given(given, g), spk) for spk, g in self.surnames[surname]]
        elif len(surname) >= 5:
            most = 1 if len(surname) < 7 else 2
            best = [(e * 3 + self._given(given, g), spk) for s, held in self.surnames.items()
                    if (e := _close(surname, s, most)) is not None for spk, g in held]
            if not best:
                if surname in self.joined:
                    return self.joined[surname]
                near = [(e, self.roles[r]) for r in self.roles if len(r) >= 5 and (e := _close(role, r, 1)) is not None]
                return min(near)[1] if near else None
        if not best:
            near = [(e, self.roles[r]) for r in self.roles if len(r) >= 5 and (e := _close(role, r, 1)) is not None]
            return min(near)[1] if near else None
        best.sort()
        if best[0][0] >= 100 or len(best) > 1 and best[0][0] == best[1][0]:
            return None
        return best[0][1]

    @staticmethod
    def _given(typed: list[str], given: list[str]) -> int:
        """0 where the typed given names fit, 1 where they are near, 100 where they contradict."""
        cost = 0
        for t in typed:
            if t in given or len(t) <= 2 and (len(given) == 0 or t[0] in {g[0] for g in given}):
                continue
            if any(_close(t, g, 2) is not None or g.startswith(t) for g in given):
                cost += 1
            else:
                return 100
        return cost


def split_label(line: str, cast: Cast) -> tuple[str, str] | None:
    """(spk_id, rest of the line) where a line begins with a label that means a speaker."""
    at = _AHEAD.match(line).end()
    m = _LABEL.match(line, at)
    if not m:
        return None
    spk = cast.find(m.group(1).strip())
    return (spk, line[m.end() :]) if spk is not None else None


#: Pages that make a block: what is sorted and counted together in one task.
BLOCK = 64
#: Most speakers a worker holds; more are refused, not cut.
MOST_SPEAKERS = 500_000
_MARK = regex.compile(r"^[\[(<{\s>]*(\d{1,2}):(\d\d):(\d\d)(?!\d)")


def _form(line: Column) -> Column:
    """A hash of a line as it may repeat as layout: small, with digits as 9; null where it ends as a label does."""
    text = F.trim(F.lower(F.regexp_replace(line, r"\d+", "9")))
    return F.when(~text.rlike(r"[:>]$"), F.xxhash64(text))


def page_layout(rows: DataFrame, share: float = 0.1, least: int = 3) -> DataFrame:
    """(file_idx, block, layout): hashes of the lines that are layout in a block of pages.

    A line is layout in a block when it stands among the first or last two of at least ``share``
    of the block's pages, and of at least ``least``; and in any block when it is so in ``least``
    files and in a quarter of those with it at an edge, as the lines of a transcription service
    are.  How large the rest of the collection is makes no difference to a file.
    """
    block = F.floor(F.col("page_idx") / BLOCK).alias("block")
    said = rows.select("file_idx", block, "page_idx", F.struct("line_no", _form(F.col("line")).alias("l")).alias("x"))
    pages = said.groupBy("file_idx", "block", "page_idx").agg(F.sort_array(F.collect_set("x")).alias("x"))  # the lines of one page
    pages = pages.select("file_idx", "block", F.array_distinct(F.concat(F.slice("x", 1, 2), F.slice(F.reverse("x"), 1, 2))["l"]).alias("edges"))
    size = pages.groupBy("file_idx", "block").agg(F.count("*").alias("pages"))
    edges = pages.select("file_idx", "block", F.explode("edges").alias("l")).where("l is not null").groupBy("file_idx", "block", "l").agg(F.count("*").alias("n"))
    edges = cut(edges.join(size, ["file_idx", "block"]).withColumn("own", (F.col("n") >= least) & (F.col("n") >= share * F.col("pages"))))
    files = edges.groupBy("l", "file_idx").agg(F.max("own").cast("int").alias("own")).groupBy("l").agg(F.sum("own").alias("owners"), F.count("*").alias("files"))
    common = files.where((F.col("owners") >= least) & (F.col("owners") * 4 >= F.col("files")))
    found = lookup_join(edges, common, "l").where(F.col("own") | F.col("files").isNotNull())
    return found.groupBy("file_idx", "block").agg(F.collect_set("l").alias("layout"))


_PARSED = "file_idx int, page_idx int, line_no int, line string, spk_id string, rest int, known boolean, seconds int"


def _parsed(lines: DataFrame, speakers: DataFrame) -> DataFrame:
    """Lines with the speaker of their label, where its text begins, whether they are layout by
    themselves, and the time mark they begin with; line by line, in whatever order."""
    spark = lines.sparkSession
    people = [tuple(r) for r in speakers.select("spk_id", "speaker_name", "first_name", "middle_name", "surname", "speaker_type").where("spk_id is not null").distinct().take(MOST_SPEAKERS + 1)]
    if len(people) > MOST_SPEAKERS:
        raise ValueError(f"more than {MOST_SPEAKERS} speakers")
    shared = spark.sparkContext.broadcast(people)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cast = Cast(shared.value)
        for b in batches:
            out = []
            for line in b.column(3).to_pylist():
                known = _LAYOUT.match(line) is not None
                hit = None if known else split_label(line, cast)
                mark = _MARK.match(line)
                out.append((hit[0] if hit else None, len(line) - len(hit[1]) if hit else 0, known, int(mark[1]) * 3600 + int(mark[2]) * 60 + int(mark[3]) if mark else None))
            cols = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.bool_(), pa.int32())))],
                                             [*b.schema.names, "spk_id", "rest", "known", "seconds"])

    return spread(lines).mapInArrow(parse, _PARSED)


def _keyed(lines: DataFrame) -> DataFrame:
    cols = [F.col(c).cast("int").alias(c) for c in ("file_idx", "page_idx", "line_no")]
    return lines.select(*cols, "line").where("file_idx is not null and page_idx is not null and line_no is not null and trim(line) <> ''")


_ORDER = ("page_idx", "line_no")


def _in_block():
    return W.partitionBy("file_idx", "block").orderBy(*_ORDER)


def _counted(rows: DataFrame, *flags: str) -> DataFrame:
    """``rows`` (with file_idx, block) with each 0/1 column of ``flags`` replaced by its running sum in
    the file: summed in a block, and over the blocks of a file, so that no file is sorted in one task."""
    totals = rows.groupBy("file_idx", "block").agg(*[F.sum(f).alias(f) for f in flags])
    earlier = W.partitionBy("file_idx").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    before = totals.select("file_idx", "block", *[F.coalesce(F.sum(f).over(earlier), F.lit(0)).alias(f"{f}_before") for f in flags])
    run = _in_block().rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumns({f: F.sum(f).over(run) for f in flags}).join(before, ["file_idx", "block"]).withColumns(
        {f: (F.col(f) + F.col(f"{f}_before")).cast("bigint") for f in flags}).drop(*[f"{f}_before" for f in flags])


def _previous(rows: DataFrame, value: str, name: str) -> DataFrame:
    """``rows`` with the ``value`` of the row before in the file, across blocks."""
    last = rows.groupBy("file_idx", "block").agg(F.max_by(value, F.struct(*_ORDER)).alias("_last"))
    last = last.select("file_idx", "block", F.lag("_last").over(W.partitionBy("file_idx").orderBy("block")).alias("_last"))
    return rows.withColumn(name, F.lag(value).over(_in_block())).join(last, ["file_idx", "block"]).withColumn(name, F.coalesce(name, "_last")).drop("_last")


def _pauses(parsed: DataFrame, forward: float = 0.9, least: int = 8, fences: float = 3.0) -> DataFrame:
    marks = parsed.where("seconds is not null").groupBy("file_idx", F.floor(F.col("page_idx") / BLOCK).alias("block"), *_ORDER).agg(F.min("seconds").alias("seconds"))
    gaps = cut(_previous(marks, "seconds", "before").withColumn("pause", F.col("seconds") - F.col("before")).where("pause is not null"))
    q = lambda p: F.percentile_approx(F.when(F.col("pause") >= 0, F.col("pause")), p, 10_000)
    of_file = gaps.groupBy("file_idx").agg(F.count("*").alias("n"), F.avg((F.col("pause") >= 0).cast("int")).alias("ahead"), (q(0.75) + fences * (q(0.75) - q(0.25))).alias("bound"))
    of_file = of_file.where((F.col("n") >= least) & (F.col("ahead") >= forward))
    return gaps.join(of_file, "file_idx").where("pause > bound and pause > 0").select("file_idx", *_ORDER, "pause")


def pauses(lines: DataFrame) -> DataFrame:
    """(file_idx, page_idx, line_no, pause): lines before which nobody speaks for remarkably long.

    Pauses are between one time mark at the beginning of a line and the next, in seconds.  What is
    long is calibrated for each file: above the third quartile of its pauses by three times the
    range between the quartiles.  Files in which fewer than nine of ten time marks run forward,
    or of fewer than eight pauses, have no time axis and no pauses.
    """
    nobody = lines.sparkSession.createDataFrame([], "spk_id string, speaker_name string, first_name string, middle_name string, surname string, speaker_type string")
    return _pauses(cut(_parsed(_keyed(lines), nobody).select("file_idx", *_ORDER, "seconds")))


def speaker_turns(lines: DataFrame, speakers: DataFrame, split_at_pauses: bool = False) -> DataFrame:
    """(file_idx, page_idx, line_no, spk_id, text): the turns of every file.

    ``lines`` has file_idx, page_idx, line_no, line; ``speakers`` has spk_id, speaker_name,
    first_name, middle_name, surname, speaker_type.  A turn is the longest run of speech by one
    speaker, not broken by speech of another; its place is the label line under which its first
    spoken word falls.  A label is a name that means one of the speakers (in any of its usual
    spellings, small typing errors included) at the beginning of a line, after time marks and
    caption signs, before a colon or a dash; other colons are speech.  Hesitation sounds,
    annotations (of up to 200 characters, in stars up to 80), time marks and layout lines are no
    spoken words; speech before the first label of a file has no speaker and is left out.  With
    ``split_at_pauses`` a turn also ends before a line after a calibrated pause (see :func:`pauses`),
    and such a line is the place of what follows.

    Labels are read line by line.  Then a sweep in order of (page, line) over blocks of pages
    numbers the segments from label to label, the blocks' totals carry the numbers over a file,
    and a sweep over the segments joins those of one speaker: the longest file is spread over as
    many tasks as it has blocks, and what is gathered is the text of one turn.

    Null and blank lines say nothing; lines without file, page or line number are left out;
    files without a label give no turn; of lines with equal keys and different text the first in
    order of text counts; other columns are not read.
    """
    rows = _keyed(lines)
    parsed = cut(_parsed(rows, speakers))
    layout = cut(page_layout(rows))
    placed = parsed.withColumn("block", F.floor(F.col("page_idx") / BLOCK)).repartition("file_idx", "block").groupBy("file_idx", "block", *_ORDER).agg(
        F.min("line").alias("line"), *[F.min_by(c, "line").alias(c) for c in ("spk_id", "rest", "known")])
    page = W.partitionBy("file_idx", "block", "page_idx")
    at, n = F.row_number().over(page.orderBy("line_no")), F.count("*").over(page)
    placed = placed.withColumn("edge", (at <= 2) | (at > n - 2)).join(layout, ["file_idx", "block"], "left").where(
        ~F.col("known") & ~F.coalesce(F.col("edge") & F.col("spk_id").isNull() & F.array_contains("layout", _form(F.col("line"))), F.lit(False)))
    placed = placed.select("file_idx", "block", *_ORDER, F.expr("substring(line, rest + 1)").alias("text"), "spk_id", F.col("spk_id").isNotNull().cast("int").alias("label"))
    if split_at_pauses:
        placed = placed.join(_pauses(parsed).withColumn("paused", F.lit(1)).drop("pause"), ["file_idx", *_ORDER], "left").withColumn("paused", F.coalesce("paused", F.lit(0)))
    else:
        placed = placed.withColumn("paused", F.lit(0))
    numbered = _counted(placed.withColumn("begins", F.greatest("label", "paused")), "label", "begins").where("label > 0")
    piece = F.struct(*_ORDER, "text")
    segments = numbered.groupBy("file_idx", "label", "begins").agg(
        F.min(F.struct(*_ORDER)).alias("place"), F.min("spk_id").alias("spk_id"), F.max("paused").alias("paused"), F.sort_array(F.collect_list(piece)).alias("pieces"))

    def say(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [spoken(join_captions(x)) for x in b.column(6).to_pylist()]
            kept = pa.array([_has_words(t) for t in text])
            yield pa.RecordBatch.from_arrays([*(c.filter(kept) for c in b.columns[:6]), pa.array(text, pa.string()).filter(kept)], [*b.schema.names[:6], "text"])

    said = segments.select("file_idx", "place.page_idx", "place.line_no", "label", "spk_id", "paused", F.col("pieces.text").alias("text"))
    said = said.mapInArrow(say, "file_idx int, page_idx int, line_no int, label bigint, spk_id string, paused int, text string")
    if split_at_pauses:  # what follows a pause is said by the speaker of the last label
        own = numbered.where("spk_id is not null").select("file_idx", "label", F.col("spk_id").alias("_own"))
        said = said.join(own, ["file_idx", "label"]).withColumn("spk_id", F.col("_own")).drop("_own")
    said = cut(said.withColumn("block", F.floor(F.col("page_idx") / BLOCK)))
    turned = _previous(said, "spk_id", "_before").withColumn("turn", F.when((F.col("spk_id") == F.col("_before")) & (F.col("paused") == 0), 0).otherwise(1))
    turns = _counted(turned.drop("_before"), "turn").groupBy("file_idx", "turn").agg(
        F.min(F.struct(*_ORDER)).alias("place"), F.min("spk_id").alias("spk_id"),
        F.array_join(F.transform(F.sort_array(F.collect_list(piece)), lambda x: x["text"]), " ").alias("text"))
    return turns.select("file_idx", "place.page_idx", "place.line_no", "spk_id", "text")
