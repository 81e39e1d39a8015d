"""Best representative of each duplicate group: name and parts that agree, and whole count figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stenoloom.operators.skew import lookup_join
from stenoloom.plans.durable import cut

# Titles as they are written, in capitals without the final dot.
TITLES = ("MR", "MRS", "MS", "DR", "PROF", "JUSTICE", "SHRI", "SMT", "HON'BLE", "SIR", "ADVOCATE")
# Entries that stand in a name field without being a name.
PLACEHOLDERS = ("UNKNOWN", "SPEAKER", "UNIDENTIFIED", "N/A", "NA", "NONE", "NULL", "NIL", "TBD", "TEST")

PARTS = ("title", "first_name", "middle_name", "surname")


def _words(name):
    return F.filter(F.split(name, r"(?U)\s+"), lambda w: w != "")


#: What makes a candidate's trust, in order; the first, the fourth and the fifth need the parts.
TRUST = ("ok", "fullness", "rev", "agreed", "title_ok", "n", "at", "speaker_name")


def candidates(spellings: DataFrame) -> DataFrame:
    """Spellings with their words, the words that may be parts, and the bound of their trust."""
    out = spellings.withColumn("words", F.transform(_words(F.upper("speaker_name")), lambda w: F.regexp_replace(w, r"[.,]+$", "")))
    out = out.withColumn("titled", F.coalesce(F.col("words").getItem(0).isin(*TITLES), F.lit(False))).withColumn(
        "full", F.filter(F.when(F.col("titled"), F.expr("slice(words, 2, size(words))")).otherwise(F.col("words")), lambda w: F.length(w) > 1))
    out = out.withColumn("fullness", F.size("full") + F.col("titled").cast("int"))
    best = {"ok": F.lit(True), "agreed": F.lit(len(PARTS) - 1), "title_ok": F.lit(1)}
    return out.withColumn("bound", F.struct(*[best.get(c, F.col(c)).alias(c) for c in TRUST]))


def tried(some: DataFrame, voted: DataFrame) -> DataFrame:
    """Candidates with their trust, worked out with the parts voted in their groups."""
    parts = voted.select(F.concat_ws("\x01", "g0", "g").alias("k"), *PARTS)
    rows = lookup_join(cut(some.withColumn("k", F.concat_ws("\x01", "g0", "g"))), parts, "k")
    held = F.array_compact(F.array("first_name", "middle_name", "surname"))
    part_words = _words(F.concat_ws(" ", "first_name", "middle_name", "surname"))
    size = F.size("full")

    def contradicted(part: str, at) -> F.Column:
        """Whether the voted part is not written out and one of the words ``at`` its place is of no voted part."""
        return F.coalesce((F.size(F.array_except(_words(F.col(part)), "full")) > 0) & (F.size(F.array_except(at, part_words)) > 0), F.lit(False))

    wrong = contradicted("surname", F.slice("full", F.greatest(size, F.lit(1)), F.lit(1))) | contradicted(
        "first_name", F.slice("full", F.lit(1), F.when(size >= 2, 1).otherwise(0))) | contradicted(
        "middle_name", F.slice("full", F.lit(2), F.greatest(size - 2, F.lit(0))))
    agreed = F.size(F.array_intersect("full", held))
    known = {"ok": ((F.size(held) == 0) | (agreed > 0)) & ~wrong, "agreed": agreed,
             "title_ok": F.coalesce(F.expr("int(titled and words[0] = regexp_replace(title, '[.]+$', ''))"), F.lit(0))}
    return rows.select("g", "g0", "speaker_name", "words", "full", F.struct(*[known.get(c, F.col(c)).alias(c) for c in TRUST]).alias("trust"))


def search(found: DataFrame, voted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the best candidate of each group, the candidates tried after the first) by branch and bound.

    ``found`` has to be a table, as it is read twice.  What is not tried was cut off: its bound is
    not above the trust of the candidate tried first.
    """
    key = ["g", "g0"]
    cols = [c for c in found.columns if c not in key]
    first = found.groupBy(*key).agg(F.max_by(F.struct(*cols), "bound").alias("x")).select(*key, "x.*")
    best = cut(tried(first, voted))
    keyed = lambda df: df.withColumn("k", F.concat_ws("\x01", "g0", "g"))
    rest = cut(lookup_join(keyed(found), keyed(best).select("k", F.col("trust").alias("_best")), "k").where(F.col("bound") > F.col("_best")).join(
        best.select(*key, "speaker_name"), [*key, "speaker_name"], "left_anti").drop("k", "_best"))
    both = best.unionByName(tried(rest, voted))
    return both.groupBy(*key).agg(F.max_by(F.struct("speaker_name", "words", "full"), "trust").alias("x")).select(*key, "x.*"), rest


def golden_records(records: DataFrame, max_words: int = 50_000_000) -> DataFrame:
    """One record per ``grp``: the surviving name bundle and the surviving count bundle.

    Out come grp, speaker_name, title, first_name, middle_name, surname, total_words,
    file_count, shortest_segment, longest_segment, n_records (distinct ones).

    The name bundle is (speaker_name and the parts), under the dependency speaker_name -> parts.
    Candidates are the spellings of the group's records, each with the parts it implies; one is
    feasible when it writes out one of the parts voted in its group (field by field, reviewed
    records first) and contradicts none: a voted first name, middle name or surname that it lacks
    must not have another word in its place.  The trust of a candidate is, in this order: feasible,
    words written out (title included), reviewed, voted parts written out, title as voted, number of
    records, latest time, and the text later in order.  The search is branch and bound: the bound of a
    candidate is its trust as if it were feasible and agreed in all, which needs no look at the
    parts; of each group the candidate of the greatest bound is tried first, and only those whose
    bound is above its trust are tried at all (see :func:`search`).  A group without any feasible
    spelling takes the fullest undamaged one, and null when there is none.

    Each part is the best voted value among those that the chosen name writes out; where it writes
    out none, the best voted of all that does not contradict the name, else null.  Parts may come
    from several records, as each record has gaps.

    The count bundle (total_words with the figures of the same record) is taken whole from the
    record with the latest usable count: positive and at most ``max_words``; a count without
    time is older than any other, among equal times the larger count is taken.

    Repeated rows count once, a null grp is a group of its own, columns beyond those named are
    not read, an empty table gives no rows.  All reductions are associative aggregates with
    map-side combination; no group is ever gathered in one place.
    """
    cols = ["grp", "speaker_name", *PARTS, "total_words", "file_count", "shortest_segment", "longest_segment", "reviewed", "updated_at"]
    rows = records.select("record_id", *cols).distinct().select(
        F.coalesce("grp", F.lit("")).alias("g"), F.col("grp").isNull().alias("g0"), *cols[1:])
    key = ["g", "g0"]

    clean = F.upper(F.trim("speaker_name"))
    damaged = (
        ~clean.rlike(r"^[\p{L}\p{M}.,'’ -]+$") | clean.contains("..") | ~clean.rlike(r"\p{L}")
        | F.split(F.regexp_replace(clean, r"\.", ""), " ").getItem(0).isin(*PLACEHOLDERS)
    )
    spellings = rows.where("speaker_name is not null").where(~damaged).groupBy(*key, "speaker_name").agg(
        F.max(F.coalesce("reviewed", F.lit(0))).alias("rev"), F.count("*").alias("n"), F.max("updated_at").alias("at"))
    voted = rows.select(*key, F.coalesce("reviewed", F.lit(0)).alias("rev"), F.explode(F.array(*[
        F.struct(F.lit(p).alias("part"), F.upper(F.trim(F.col(p))).alias("value")) for p in PARTS])).alias("x"),
    ).where("x.value <> ''").groupBy(*key, "x.part", "x.value").agg(F.struct(F.max("rev"), F.count("*")).alias("votes"))
    values = cut(voted)
    voted = values.groupBy(*key).agg(*[
        F.max(F.when(F.col("part") == p, F.struct("votes", "value"))).getField("value").alias(p) for p in PARTS])

    top = cut(search(cut(candidates(spellings)), voted)[0])

    # of the values of a part those written out in the chosen name come first, those against it not at all
    named = lookup_join(values.withColumn("k", F.concat_ws("\x01", "g0", "g")), top.select(F.concat_ws("\x01", "g0", "g").alias("k"), "words", "full"), "k")
    value_words = _words(F.regexp_replace("value", r"[.,]+$", ""))
    own = F.coalesce(F.size(F.array_except(value_words, "words")) == 0, F.lit(False))
    size = F.size("full")
    held = F.when(F.col("part") == "surname", F.slice("full", F.greatest(size, F.lit(1)), F.lit(1))).when(
        F.col("part") == "first_name", F.slice("full", F.lit(1), F.when(size >= 2, 1).otherwise(0))).otherwise(F.array().cast("array<string>"))
    against = F.coalesce(~own & (F.size(held) > 0), F.lit(False))
    kept = named.where(~against).withColumn("own", own).groupBy(*key).agg(*[
        F.max(F.when(F.col("part") == p, F.struct("own", "votes", "value"))).getField("value").alias(p) for p in PARTS])

    usable = (F.col("total_words") > 0) & (F.col("total_words") <= max_words)
    counts = rows.groupBy(*key).agg(
        F.count("*").alias("n_records"),
        F.max(F.when(usable, F.struct("updated_at", "total_words", "file_count", "shortest_segment", "longest_segment"))).alias("c"))
    out = counts.join(top.select(*key, "speaker_name"), key, "left").join(kept, key, "left")
    return out.select(
        F.when(~F.col("g0"), F.col("g")).alias("grp"), "speaker_name",
        *[F.col(p) for p in PARTS], F.col("c.total_words").alias("total_words"), F.col("c.file_count").alias("file_count"),
        F.col("c.shortest_segment").alias("shortest_segment"), F.col("c.longest_segment").alias("longest_segment"), "n_records")
