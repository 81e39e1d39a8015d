"""Variant spellings of typed names linked to one entity, by a noisy channel."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from math import log

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stenoloom.llm.components import connected_groups
from stenoloom.operators.order import spread
from stenoloom.operators.skew import lookup_join
from stenoloom.plans.durable import cut

# Forms of address, which belong to no name.
TITLES = frozenset("MR MRS MS MISS DR PROF PROFESSOR JUSTICE SHRI SMT SIR HON'BLE HONBLE ADVOCATE ADV LD LEARNED SR JR SENIOR THE M/S MESSRS".split())
# Words for kinds of organisations and their usual short forms.
ORG_WORDS = {
    "ASSOCIATION": "ASSN ASSOC", "AUTHORITY": "AUTH AUTHY", "BOARD": "BRD", "BUREAU": "BUR", "COMMISSION": "COMMN COMM", "COMMITTEE": "CTTE CMTE", "COMPANY": "CO COY",
    "COOPERATIVE": "CO-OP COOP", "CORPORATION": "CORPN CORP", "COUNCIL": "CNCL", "DEPARTMENT": "DEPT", "FEDERATION": "FEDN FED", "FOUNDATION": "FDN FNDN",
    "INSTITUTE": "INST", "LIMITED": "LTD", "MINISTRY": "MINY", "SOCIETY": "SOCY", "TRUST": "TRST", "UNION": "UNN", "UNIVERSITY": "UNIV",
}
_SHORT_ORG = {s: w for w, shorts in ORG_WORDS.items() for s in shorts.split()} | {w: w for w in ORG_WORDS}
# Usual short names of given names.
NICKNAMES = {
    "ALEXANDER": "ALEX SANDY ALEC", "CHARLES": "CHARLIE CHUCK", "DOROTHY": "DOLLY DOT DOTTIE", "EDWARD": "ED TED NED EDDIE", "ELIZABETH": "BETTY LIZ BETH ELIZA LIZZIE",
    "FRANCISCO": "CISCO PACO FRANK", "HENRY": "HANK HARRY", "JAMES": "JIM JIMMY", "JOHN": "JACK JOHNNY", "KATHERINE": "KATE KATHY KATIE KIT", "MARGARET": "MAGGIE PEGGY MEG",
    "MATTHIAS": "MATT", "MICHAEL": "MIKE MICK", "NATALIA": "NATASHA TALIA", "RAJENDRA": "RAJU RAJ", "RICHARD": "DICK RICK RICH", "ROBERT": "BOB ROB BOBBY ROBBIE",
    "SURENDRA": "SURI", "THEODORE": "THEO TEDDY", "THOMAS": "TOM TOMMY", "VALERIE": "VAL", "VENKATESH": "VENKY VENKAT", "WILLIAM": "WILL BILL BILLY LIAM",
}
_NICK = {s: w for w, shorts in NICKNAMES.items() for s in shorts.split()}
# What scanning reads for letters.
_OCR = str.maketrans("01358|", "OIESBI")


@lru_cache(maxsize=100_000)
def edits(a: str, b: str, most: int = 2) -> int:
    """Edits with transpositions between two words, ``most`` + 1 where there are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                row[j] = min(row[j], before[j - 2] + 1)
        before = last
        if min(row) > most:
            return most + 1
    return min(row[-1], most + 1)


def tidy(raw: str) -> str:
    """Capitals without accents, marks and outer or repeated white space; letters for the digits
    that scanning put into words."""
    text = "".join(c for c in unicodedata.normalize("NFKD", raw.upper()) if not unicodedata.combining(c)).replace("’", "'")
    text = regex.sub(r"[\s:;*\"“”()\[\]]+", " ", text).strip(" ,-")
    return " ".join(w.translate(_OCR) if regex.search(r"\d", w) and regex.search(r"[A-Z]", w) else w for w in text.split())


def _spelled(word: str) -> str:
    return word.replace(".", "").replace("-", "")


class Speller:
    """The words that many names share (given names, parts of organisations), by frequency: the
    prior of the channel.  A word goes to the known word from which it most likely came."""

    def __init__(self, counts: dict[str, int]):
        self.n = counts
        self.memo: dict[str, str | None] = {}
        self.by_size: dict[int, list[str]] = {}
        for w in sorted(counts):
            self.by_size.setdefault(len(w), []).append(w)

    def known(self, word: str) -> str | None:
        """The known word that ``word`` stands for; null if none is likely."""
        if word not in self.memo:
            if len(self.memo) > 200_000:
                self.memo.clear()
            self.memo[word] = self._known(word)
        return self.memo[word]

    def _known(self, word: str) -> str | None:
        if word in _NICK:
            return _NICK[word]
        if word in _SHORT_ORG:
            return _SHORT_ORG[word]
        if len(word) < 3 or not word.isalpha():
            return None
        own = self.n.get(word, 0)
        best, score = (word, log(own)) if own else (None, -1e9)
        most = 1 if len(word) < 6 else 2
        for size in range(len(word) - most, len(word) + most + 1):
            for w in self.by_size.get(size, ()):
                if w != word and self.n[w] > own and (d := edits(word, w, most)) <= most:
                    s = log(self.n[w]) - 2.2 * d
                    if s > score:
                        best, score = w, s
        return best


# Forms of address that people keep.
KEPT_TITLES = ("MRS", "MS", "MR", "DR", "PROF", "JUSTICE")


def kept_title(raw: str) -> str:
    """The lasting form of address at the beginning of a name, or an empty text."""
    first = tidy(raw).split(" ")[0].rstrip(".")
    return first if first in KEPT_TITLES else ""


def parse(raw: str, speller: Speller) -> tuple[str, int, str, str, str] | None:
    """(kind, level, given, family, letters) of a typed name.

    kind R: a role, family is the whole; kind O: an organisation, given its kind and subject,
    family its own word; kind P: a person.  level 3: in full, 2: with an initial, 1: without
    given name, or the letters of an organisation only.
    """
    text = tidy(raw)
    if not any(c.isalnum() for c in text):
        return None
    if regex.search(r"COUNSEL|COURT MASTER|REGISTRAR|STENOGRAPHER|INTERPRETER|\bBENCH\b|AMICUS|USHER", text) and (
        regex.search(r"\d\s*$", text) or not regex.search(r"\b(?:LD|LEARNED|SR|ADV)\b", text)):
        return "R", 3, "", regex.sub(r"[^A-Z0-9]", "", regex.sub(r"\bTHE\b", "", text)), ""
    comma = ""
    if "," in text:
        comma, _, text = text.partition(",")
        comma = regex.sub(r"[^A-Z']", "", " ".join(w for w in comma.split() if _spelled(w) not in TITLES))
    letters = regex.fullmatch(r"(?:[A-Z]\.\s?){2,6}|[A-Z]{2,5}", text.strip())
    if letters and not comma:
        return "O", 1, "", "", regex.sub(r"[^A-Z]", "", text)
    words = [w for w in regex.split(r"\s+|(?<=[A-Z]\.)(?=[A-Z])", text.strip()) if w]
    while len(words) > 1 and (_spelled(words[0]) in TITLES or words[0] in TITLES or words[0] == "COUNSEL"):
        words = words[1:]
    words = [x for w in words if (x := regex.sub(r"[^A-Z']", "", w) if "-" not in w else regex.sub(r"[^A-Z'-]", "", w))]
    if comma:
        return _person(words, comma, speller)
    if not words:
        return None
    if len(words) == 1:
        return _one(words[0], speller)
    known = [speller.known(w) for w in words]
    if words[-1] == "TR" and len(words) > 2 and words[-2] in speller.n:
        known[-1] = "TRUST"
    kinds = [i for i, k in enumerate(known) if k in ORG_WORDS]
    if kinds:
        own, rest = [], []
        turned = "OF" in words
        for i, w in enumerate(words):
            if w == "OF":
                continue
            (rest if known[i] and (known[i] in ORG_WORDS or not turned or i < words.index("OF")) else own).append(known[i] or w)
        own = [w for w in own if w]
        if not own:
            own, rest = rest[:1], rest[1:]
        family = "".join(own)
        given = " ".join(sorted(rest, key=lambda w: (w in ORG_WORDS, w)))
        return "O", 3, given, family, family[:1] + "".join(w[0] for w in given.split())
    if len(words[-1]) == 1 or len(words[-1]) == 2 and len(words) == 2 and len(words[0]) > 3 and not speller.known(words[0]):
        return "P", 2, words[-1][0], "".join(words[:-1]), ""
    if speller.known(words[-1]) and not known[0] and len(words) == 2 and speller.n.get(words[-1], 0) > 3:
        return _person(words[1:], words[0], speller)
    # given names, then what is no given name: a family name that was typed in pieces
    if not known[0] and len(words) > 2 and (k := speller.known(words[0] + words[1])) and len(words[0]) > 1 and k in speller.n:
        words = [words[0] + words[1], *words[2:]]
    at = 1
    while at < len(words) - 1 and (len(words[at]) == 1 or words[at] in speller.n or len(words[at]) > 4 and speller.known(words[at]) in speller.n):
        at += 1
    return _person(words[:at], "".join(words[at:]), speller)


def _person(given: list[str], family: str, speller: Speller) -> tuple[str, int, str, str, str] | None:
    if not family:
        return None
    if not given:
        return "P", 1, "", family, ""
    if len(given[0]) <= 2 and not speller.known(given[0]):
        return "P", 2, given[0][0], family, ""
    return "P", 3, speller.known(given[0]) or given[0], family, ""


def _one(word: str, speller: Speller) -> tuple[str, int, str, str, str]:
    """One word: a family name, or several words typed without a space."""
    for cut_at in range(min(12, len(word) - 4), 2, -1):
        head = word[:cut_at]
        if head in speller.n and speller.n[head] > 3 and speller.known(head) == head or head in _NICK:
            tail = word[cut_at:]
            return "P", 3, speller.known(head) or head, tail, ""
    for w in sorted(ORG_WORDS):
        if word.endswith(w) and len(word) > len(w) + 6:
            rest = word[: -len(w)]
            for size in range(9, 3, -1):
                if rest[-size:] in speller.n and len(rest) > size + 2:
                    family = rest[:-size]
                    return "O", 3, f"{rest[-size:]} {w}", family, family[:1] + rest[-size] + w[0]
    # a given name with a typing error before the family name
    for cut_at in range(min(12, len(word) - 4), 3, -1):
        k = speller.known(word[:cut_at])
        if k and k in speller.n and edits(word[:cut_at], k) == 1 and word[0] == k[0] and word[cut_at - 1] == k[-1]:
            return "P", 3, k, word[cut_at:], ""
    return "P", 1, "", word, ""


def known_words(names: DataFrame, raw: str, tag: str, share: int = 500) -> dict[str, int]:
    """Words found in at least 4 tags and in one row of ``share``, with their number of rows.

    Counted over all rows; by the share there are at most ``share`` times the words of a name.
    """
    text = F.regexp_replace(F.upper(F.col(raw)), r"[.,:;\s]+| ", " ")
    words = names.select(F.col(tag).alias("t"), F.explode(F.array_distinct(F.split(F.trim(text), " +"))).alias("w")).where(F.col("w").rlike(r"^[A-Z]{3,}$"))
    per = words.groupBy("w", "t").agg(F.count("*").alias("n")).groupBy("w").agg(F.sum("n").alias("n"), F.count("*").alias("tags"))
    total = max(1, names.count())
    rows = per.where((F.col("tags") >= 4) & (F.col("n") * share >= total)).select("w", "n").collect()
    return {r["w"]: r["n"] for r in rows if r["w"] not in TITLES and r["w"] not in ("OF", "AND", "COUNSEL")}


def _holes(word, most: int):
    """Keys by which words within ``most`` edits meet: the word with up to ``most`` letters left out."""
    i = F.sequence(F.lit(1), F.length(word))
    one = F.transform(i, lambda k: F.concat(F.substring(word, F.lit(1), k - 1), F.substring(word, k + 1, F.length(word))))
    if most == 1:
        return F.array_distinct(F.concat(F.array(word), one))
    two = F.flatten(F.transform(one, lambda v: F.transform(F.sequence(F.lit(1), F.greatest(F.length(v), F.lit(1))), lambda k: F.concat(F.substring(v, F.lit(1), k - 1), F.substring(v, k + 1, F.length(v))))))
    return F.array_distinct(F.concat(F.array(word), one, two))


def near_given(forms: DataFrame, known: DataFrame) -> DataFrame:
    """(tag, kind, given, c_given, d): given names of a tag that the prior leaves alone, and those they
    may have come from, ``d`` edits away.

    The channel of :class:`Speller` over the rows of all given names, whatever their number; that the
    family name meets too counts 1.6 against the 2.2 of an edit.  ``known`` has the words of the prior: they are names.
    """
    count = forms.groupBy("kind", "given").agg(F.sum("n").alias("rows"))
    given = forms.select("tag", "kind", "given").distinct().where(F.length("given") >= 3).join(count, ["kind", "given"])
    given = cut(given.withColumn("hole", F.explode(F.when(F.length("given") >= 6, _holes(F.col("given"), 2)).otherwise(_holes(F.col("given"), 1)))))
    own = given.join(F.broadcast(known), "given", "left_anti")
    d = _turned_edits("given", "c_given")
    pairs = own.join(given.select("tag", "kind", "hole", F.col("given").alias("c_given"), F.col("rows").alias("c_rows")), ["tag", "kind", "hole"])
    return pairs.where("given <> c_given").select("tag", "kind", "given", "c_given", "rows", "c_rows", d.alias("d")).distinct().where(
        (F.col("d") <= F.when(F.length("given") >= 6, 2).otherwise(1)) & (F.log("c_rows") - 2.2 * F.col("d") + 1.6 >= F.log("rows"))).drop("rows", "c_rows")


def _turned_edits(a: str, b: str):
    """Edits between two names, two letters that changed places counting as one."""
    turned = F.array_join(F.array_sort(F.split(a, "")), "") == F.array_join(F.array_sort(F.split(b, "")), "")
    d = F.levenshtein(a, b)
    return F.when(turned & (d == 2), 1).otherwise(d)


def _meetings(forms: DataFrame, known: DataFrame) -> DataFrame:
    """(fid, c_fid, via): numbers of forms that may mean one another, in one join on hashed keys.

    A key is of tag, kind and family name with up to two letters left out, and of the given name, its
    initial, or neither, as the shorter of the two forms has it (via 0); of a near given name
    outside the prior (via 1); or of given and family name as one with one letter left out (via 2).
    What meets by a hash is compared in full afterwards.
    """
    left_out = F.array_union(*[F.when(F.length(c) >= 6, _holes(F.col(c), 2)).otherwise(_holes(F.col(c), 1)) for c in ("family", "joined")])
    keyed = cut(forms.select("fid", "tag", "kind", "level", "given", F.explode(left_out).alias("hole")))
    base = [F.col("tag"), F.col("kind"), F.col("hole")]
    full, short, none = F.xxhash64(*base, F.lit(3), "given"), F.xxhash64(*base, F.lit(2), F.substring("given", 1, 1)), F.xxhash64(*base, F.lit(1))
    asks = keyed.select("fid", F.when(F.col("level") == 3, full).when(F.col("level") == 2, short).otherwise(none).alias("key"), F.lit(0).alias("via"))
    near = cut(near_given(forms.where("level = 3"), known))
    asks = asks.unionByName(keyed.where("level = 3").join(near.select("tag", "kind", "given", "c_given"), ["tag", "kind", "given"]).select(
        "fid", F.xxhash64(*base, F.lit(3), "c_given").alias("key"), F.lit(1).alias("via")))
    answers = keyed.where("level >= 2").select(F.col("fid").alias("c_fid"), F.explode(F.when(F.col("level") == 3, F.array(full, short, none)).otherwise(F.array(short, none))).alias("key"))
    whole = forms.where("kind = 'P' and level <> 2").withColumn("whole", F.concat("given", "family"))
    whole = whole.where(F.length("whole") >= 8).withColumn("hole", F.explode(_holes(F.col("whole"), 1))).withColumn("key", F.xxhash64("tag", F.lit("one"), "hole"))
    asks = asks.unionByName(whole.join(F.broadcast(known), "given", "left_anti").select("fid", "key", F.lit(2).alias("via")))
    answers = answers.unionByName(whole.where("level = 3").select(F.col("fid").alias("c_fid"), "key"))
    return asks.join(answers, "key").where("fid <> c_fid").select("fid", "c_fid", "via").distinct()


#: Costs of a channel before anything is attached: of an edit, of an initial or nothing for a given name.
EDIT, LACKS = 3.0, {1: 6.0, 2: 4.0, 3: 0.0}


def _channel_cost(scored: DataFrame):
    """The cost of a candidate's edits and of what its form lacks, learned from the attachments.

    With the first costs every form is attached to its best candidate; how often the forms in full
    that were attached have one, two and more edits tells what an edit costs, and likewise an
    initial and a missing given name among all; costs are logs of these odds, not below half nor
    above twice the first ones, which hold where there is too little to learn from.
    """
    lacks = F.create_map(*[F.lit(x) for pair in LACKS.items() for x in pair])[F.col("lacks")]
    first = scored.withColumn("_p", F.col("prior") - EDIT * F.col("edits") - lacks)
    best = first.groupBy("form").agg(F.max_by(F.struct("n", "edits", "lacks"), F.struct("_p", "c_form")).alias("x")).select("x.*")
    n = {(r["lacks"], r["edits"]): r["n"] for r in best.groupBy("lacks", F.least("edits", F.lit(4)).alias("edits")).agg(F.sum("n").alias("n")).collect()}  # at most 15 rows
    bound = lambda x, at: min(max(x, at / 2), at * 2)
    total = sum(n.values())
    edited = sum(k * v for (_, k), v in n.items())
    edit = bound(log((total + 1) / (edited + 1)), EDIT) if total >= 100 else EDIT
    cost = {k: bound(log((total + 1) / (sum(v for (x, _), v in n.items() if x == k) + 1)), at) if at and total >= 100 else at for k, at in LACKS.items()}
    return F.lit(edit) * F.col("edits") + F.create_map(*[F.lit(x) for pair in cost.items() for x in pair])[F.col("lacks")]


def name_groups(names: DataFrame, key: str = "name_id", tag: str = "tag", raw: str = "raw_name") -> DataFrame:
    """(key, tag, entity): the entity that each typed name means, within its tag.

    Spellings are tidied and parsed into forms; the frequent words of the whole collection are
    the prior by which given names and the words of organisations are put right (typing errors,
    short and pet names, missing spaces).  Forms in full are candidates for canonical spellings;
    every form is attached to the candidate of its tag with the highest posterior, that is the
    log of its frequency less the cost of the edits, of an initial in place of the given name,
    or of a missing given name, as the attachments show them (:func:`_channel_cost`), and two more or
    less for the same or another form of address; a form is attached only to one with a fuller name, or an
    equally full one that is more frequent (of equals the smaller spelling).  Attachments are
    consolidated by :func:`connected_groups`.

    Forms meet by their family name with up to two letters left out, together with the tag and,
    where both have one, the given name or initial, so a tag of any size is spread over as many
    keys as it has names.  Given names outside the prior also meet near ones of their tag
    (:func:`near_given`), and by given and family name written as one, with one letter left out.  Numbered counsel and other roles are linked only where they are equal.

    Names that are null, blank or without letters belong to no entity and are left out, as are
    rows without key; a null tag is a tag of its own; repeated rows count once; other columns
    are not read.
    """
    spark = names.sparkSession
    rows = names.select(F.col(key).alias("id"), F.col(tag).alias("tag"), F.col(raw).alias("raw")).where("id is not null and raw is not null").distinct()
    words = known_words(rows, "raw", "tag")
    shared = spark.sparkContext.broadcast(words)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = Speller(shared.value)
        for b in batches:
            at, out = [], []
            for i, x in enumerate(b.column(2).to_pylist()):
                p = parse(x, speller)
                if p:
                    at.append(i)
                    out.append((*p, kept_title(x)))
            t = pa.array(at, pa.int64())
            cols = list(zip(*out)) or [[]] * 6
            types = (pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(t), b.column(1).take(t), *(pa.array(c, k) for c, k in zip(cols, types))],
                ["id", "tag", "kind", "level", "given", "family", "letters", "title"])

    of_key = names.select(key).schema[0].dataType.simpleString()
    parsed = spread(rows).mapInArrow(read, f"id {of_key}, tag string, kind string, level int, given string, family string, letters string, title string")
    form = F.concat_ws("\x01", F.coalesce("tag", F.lit("\x02")), "kind", F.col("level").cast("string"), "given", "family", F.when(F.col("level") == 1, F.col("letters")).otherwise(""),
                       F.when(F.col("level") < 3, F.col("title")).otherwise(""))
    parsed = cut(parsed.withColumn("form", form))
    forms = parsed.groupBy("form").agg(
        F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("tag", "kind", "level", "given", "family", "letters")],
        F.array_remove(F.collect_set("title"), "").alias("titles"))
    # letters that scanning takes apart also meet as one; a form has a number that stands for it in the joins
    forms = cut(forms.withColumn("joined", F.replace(F.replace(F.col("family"), F.lit("RN"), F.lit("M")), F.lit("VV"), F.lit("W"))).withColumn(
        "tag", F.coalesce("tag", F.lit("\x02"))).withColumn("fid", F.monotonically_increasing_id()))
    tagged = forms.where("kind <> 'R' and family <> ''")
    known = spark.createDataFrame([(w,) for w in sorted(words)], "given string")
    own = ("kind", "level", "given", "family", "joined", "titles", "n", "form")
    met = cut(_meetings(tagged, known))
    pairs = met.join(tagged.select("fid", "tag", *own), "fid").join(
        tagged.select(F.col("fid").alias("c_fid"), F.col("tag").alias("c_tag"), *[F.col(c).alias("c_" + c) for c in own]), "c_fid")
    pairs = pairs.where((F.col("tag") == F.col("c_tag")) & (F.col("kind") == F.col("c_kind")))
    initial = lambda c: F.substring(c, 1, 1)
    same = F.when(F.col("level") == 3, (F.col("c_level") == 3) & (F.col("given") == F.col("c_given"))).when(F.col("level") == 2, initial("given") == initial("c_given")).otherwise(True)
    given_edits = F.when((F.col("via") == 1) & (F.col("level") == 3), _turned_edits("given", "c_given")).otherwise(0)
    as_one = F.levenshtein(F.concat("given", "family"), F.concat("c_given", "c_family"))
    parted = (as_one <= 1) & (F.col("given") != F.col("c_given")) & (F.length("family") != F.length("c_family"))
    d = F.when(F.col("via") == 2, as_one).otherwise(F.least(F.levenshtein("family", "c_family"), F.levenshtein("joined", "c_joined")))
    swapped = F.array_join(F.array_sort(F.split("family", "")), "") == F.array_join(F.array_sort(F.split("c_family", "")), "")
    near = (d <= 1) | ((d <= 2) & ((F.least(F.length("family"), F.length("c_family")) >= 6) | swapped))
    rank = F.struct("c_level", "c_n"), F.struct("level", "n")
    fuller = (rank[0] > rank[1]) | ((rank[0] == rank[1]) & (F.col("c_form") < F.col("form")))
    lacks = F.when((F.col("via") == 2) | (F.col("level") == 3), 3).otherwise(F.col("level"))
    # the form of address tells persons of one family name apart
    address = F.when(F.arrays_overlap("titles", "c_titles"), 2.0).when((F.size("titles") > 0) & (F.size("c_titles") > 0), -2.0).otherwise(0.0)
    scored = cut(pairs.where(F.when(F.col("via") == 0, same).when(F.col("via") == 1, F.col("c_level") == 3).otherwise(parted) & near & fuller).select(
        "form", "c_form", "n", (d + given_edits).alias("edits"), lacks.alias("lacks"), (F.log("c_n") + address + F.when(F.col("c_level") == 3, 1.0).otherwise(0.0)).alias("prior")))
    scored = scored.withColumn("posterior", F.col("prior") - _channel_cost(scored))

    letters = forms.where("kind = 'O'")
    short = letters.where("level = 1").select("tag", "letters", "form")
    by_letters = short.join(
        letters.where("level = 3 and letters <> ''").select("tag", "letters", F.col("form").alias("c_form"), F.col("n").alias("c_n")), ["tag", "letters"]
    ).select("form", "c_form", F.log("c_n").alias("posterior"))
    best = scored.select("form", "c_form", "posterior").unionByName(by_letters).groupBy("form").agg(
        F.max_by("c_form", F.struct("posterior", "c_form")).alias("c_form"))
    groups = connected_groups(cut(best), "form", "c_form")
    # one spelling may be typed in a third of all rows
    found = lookup_join(parsed.select("id", "tag", "form"), groups.select(F.col("id").alias("form"), "group_id"), "form")
    return found.select(F.col("id").alias(key), F.col("tag").alias(tag), F.coalesce("group_id", "form").alias("entity"))


def name_pairs(names: DataFrame, key: str = "name_id", tag: str = "tag", raw: str = "raw_name", part: int = 2000) -> DataFrame:
    """(key_a, key_b): every two keys of one tag whose names mean the same, smaller key first.

    See :func:`name_groups`; the pairs of an entity are the stated result, so all are given.
    """
    g = cut(name_groups(names, key, tag, raw).select(F.col("entity"), F.col(key).alias("k")).distinct())
    # an entity of many keys is parted: each part of it meets all of it in a task of its own
    many = g.groupBy("entity").agg(F.ceil(F.count("*") / part).cast("int").alias("parts")).where("parts > 1")
    g = lookup_join(g, many, "entity").withColumn("parts", F.coalesce("parts", F.lit(1)))
    a = g.select("entity", F.pmod(F.xxhash64("k"), F.col("parts")).cast("int").alias("part"), F.col("k").alias(f"{key}_a"))
    b = g.select("entity", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("k").alias(f"{key}_b"))
    return a.join(b, ["entity", "part"]).where(F.col(f"{key}_a") < F.col(f"{key}_b")).select(f"{key}_a", f"{key}_b").distinct()
