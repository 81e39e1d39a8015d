"""Speaker identities: aliases, clusters of spellings, ranked ids and speaker statistics."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from stenoloom.functions.names import consonant_key, parse_name, speaker_type, titles_of
from stenoloom.operators.order import with_rank
from stenoloom.operators.skew import lookup_join
from stenoloom.plans.durable import cut, drop
from stenoloom.sources.lexicon import read_aliases

#: Likeness of consonant keys from which two surnames, two first names are one; least length of a key.
SURNAME_RATIO, FIRST_RATIO, KEY_LENGTH = 0.80, 0.75, 3


def with_alias(rows: DataFrame, name: str, aliases: dict[str, str] | DataFrame | None = None) -> DataFrame:
    """``name`` replaced by its alias where there is one: in a short word list, which is broadcast,
    or in a table (raw, use) of any size, of whose several aliases of a name the smallest counts."""
    table = read_aliases() if aliases is None else aliases
    if isinstance(table, DataFrame):
        dim = table.where("raw is not null and use is not null").groupBy(F.col("raw").alias(name)).agg(F.min("use").alias("_alias"))
        return lookup_join(rows, dim, name).withColumn(name, F.coalesce("_alias", name)).select(*rows.columns)
    if not table:
        return rows
    pairs = rows.sparkSession.createDataFrame(sorted(table.items()), "_raw string, _use string")
    return rows.join(F.broadcast(pairs.withColumnRenamed("_use", "_alias")), F.col(name) == F.col("_raw"), "left").withColumn(name, F.coalesce("_alias", name)).drop("_raw", "_alias")


def resolve(rows: DataFrame, name: str, mapping: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """``spk_id`` of each name by ``mapping`` (name, spk_id): that of its alias, else its own, else
    the alias or name itself and mapped = false.

    Names are looked up once each and not once a row, and their ids come back to the rows by a
    join that holds when one name has most of them.  Of several ids of a name the smallest counts.
    """
    m = mapping.where("name is not null and spk_id is not null").groupBy("name").agg(F.min("spk_id").alias("_id"))
    names = with_alias(rows.select(F.col(name).alias("_raw_name")).where("_raw_name is not null").distinct().withColumn("_use", F.col("_raw_name")), "_use", aliases)
    found = names.join(m.withColumnsRenamed({"name": "_use", "_id": "_a"}), "_use", "left").join(m.withColumnsRenamed({"name": "_raw_name", "_id": "_b"}), "_raw_name", "left")
    found = found.select(F.col("_raw_name").alias(name), F.coalesce("_a", "_b").alias("_id"), "_use")
    joined = lookup_join(rows, found, name)
    return joined.withColumn("mapped", F.col("_id").isNotNull()).withColumn("spk_id", F.coalesce("_id", "_use")).select(*[c for c in rows.columns if c != "spk_id"], "mapped", "spk_id")


def names_of(turn_rows: DataFrame) -> DataFrame:
    """(name, words, name_ord): distinct speakers with words; name_ord is the place of their first turn."""
    w = F.size(F.filter(F.split("body", r"(?U)\s+"), lambda t: t != ""))
    seen = turn_rows.withColumn("w", w.cast("bigint")).where("w > 0").groupBy(F.col("raw_name").alias("name")).agg(
        F.sum("w").alias("words"), F.min(F.struct("file_idx", "turn_idx")).alias("at"))
    return with_rank(seen, F.col("at"), name="name_ord").select("name", "words", "name_ord")


def parsed_names(names: DataFrame) -> DataFrame:
    p = names.withColumn("p", parse_name(F.col("name")))
    kind = F.when(F.col("p.surname").isNull(), "role").when(F.col("p.first").isNull(), "wildcard").otherwise("regular")
    return p.select("*", kind.alias("kind"), F.col("p.first").alias("first"), F.col("p.surname").alias("surname"),
                    consonant_key(F.col("p.first")).alias("first_key"), consonant_key(F.col("p.surname")).alias("surname_key")).drop("p")


@F.pandas_udf(DoubleType())
def key_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Order-sensitive likeness of two keys (twice the matched characters by all characters)."""
    return pd.Series([SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


#: Letters of a key from seldom to often; what comes first makes the smaller blocks.
_SELDOM = "XJYWFGBDHMLKTSNR"


def _blocks(key: Column) -> Column:
    """Values of which two keys share one when they are equal or alike by SURNAME_RATIO.

    Alike keys of lengths a and b have at least (a + b) * SURNAME_RATIO / 2 letters in common, so of
    a letters (each with its number among equal ones) at least two thirds.  With the letters of both in
    one order, the first a - 2a/3 + 2 of either then have two in common: these pairs are the values.
    """
    ranked = F.translate(key, _SELDOM, "".join(chr(33 + k) for k in range(len(_SELDOM))))
    size = F.length(key)
    letters = F.transform(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), lambda i: F.concat(
        F.substring(ranked, i, F.lit(1)), (i - F.length(F.replace(F.substring(ranked, F.lit(1), i), F.substring(ranked, i, F.lit(1)), F.lit("")))).cast("string")))
    common = F.ceil(size * (SURNAME_RATIO / (2 - SURNAME_RATIO)) - 1e-9).cast("int")
    head = F.slice(F.array_sort(letters), F.lit(1), F.greatest(size - common + 2, F.lit(2)))
    pairs = F.flatten(F.transform(head, lambda x: F.transform(F.filter(head, lambda y: x < y), lambda y: F.concat(x, F.lit("&"), y))))
    return F.concat(F.array(F.concat(F.lit("="), key)), F.when(size >= KEY_LENGTH, pairs).otherwise(F.array().cast("array<string>")))


def candidate_pairs(parsed: DataFrame) -> DataFrame:
    """Ordered pairs of named persons that may be one: both given names and both surnames begin
    with the same letter, and the keys of the surnames are equal or share enough letters (see
    :func:`_blocks`), which every further rule implies; so the join loses none."""
    cols = ("name", "name_ord", "first", "surname", "first_key", "surname_key")
    side = lambda s: parsed.where("kind = 'regular'").select(
        *[F.col(c).alias(f"{c}_{s}") for c in cols], F.substring("surname", 1, 1).alias("s1"), F.substring("first", 1, 1).alias("f1"), F.explode(_blocks(F.col("surname_key"))).alias("block"))
    return side("a").join(side("b"), ["s1", "f1", "block"]).where("name_ord_a < name_ord_b").drop("s1", "f1", "block").distinct()


def matching_pairs(parsed: DataFrame) -> DataFrame:
    """(name_a, name_ord_a, name_b, name_ord_b) of pairs whose surnames and first names match; likeness of keys is worked
    out only where nothing cheaper decides."""
    def side(part: str):
        a, b, ka, kb = (F.col(f"{part}{x}") for x in ("_a", "_b", "_key_a", "_key_b"))
        long = (F.length(ka) >= KEY_LENGTH) & (F.length(kb) >= KEY_LENGTH)
        if part == "surname":
            return (a == b) | (ka == kb), long
        short = ((F.length(a) <= 2) & b.startswith(a)) | ((F.length(b) <= 2) & a.startswith(b))
        return (a == b) | short | ((ka != "") & (ka == kb)), long

    (s_sure, s_may), (f_sure, f_may) = side("surname"), side("first")
    near = candidate_pairs(parsed).withColumn("s", s_sure).withColumn("f", f_sure).where((F.col("s") | s_may) & (F.col("f") | f_may))
    sure = near.where("s and f")
    rest = near.where("not (s and f)").withColumn("sr", key_ratio("surname_key_a", "surname_key_b")).withColumn("fr", key_ratio("first_key_a", "first_key_b"))
    rest = rest.where((F.col("s") | (F.col("sr") >= SURNAME_RATIO)) & (F.col("f") | (F.col("fr") >= FIRST_RATIO)))
    cols = ("name_a", "name_ord_a", "name_b", "name_ord_b")
    return sure.select(*cols).unionByName(rest.select(*cols))


def clusters(names: DataFrame) -> DataFrame:
    """(name, words, name_ord, kind, group_ord, hits): groups of spellings of one person.

    ``names`` has name, words, name_ord.  Groups are the connected components of matching pairs
    (smallest label over neighbours and then over labels, until nothing moves); a surname alone
    joins the one group it matches, in order of appearance, and a group joined so may be matched
    through it by later ones; roles and unresolved surnames stay by themselves.  ``group_ord`` is
    the first name_ord of the group, ``hits`` the groups a surname alone matched.
    """
    parsed = cut(parsed_names(names))
    named, alone = parsed.where("kind <> 'role'"), parsed.where("kind = 'wildcard'")
    # two graphs go through one search: names that match, and in odd numbers also surnames alone with
    # what they match, of which only each connected set is looked at in order
    links = matching_pairs(parsed).select("name_ord_a", "name_ord_b", F.lit(0).alias("alone")).unionByName(
        _surname_meetings(alone, named).withColumn("alone", F.lit(1)))
    a, b = F.col("name_ord_a") * 2, F.col("name_ord_b") * 2
    both_ways = lambda x, y: (F.struct(x.alias("a"), y.alias("b")), F.struct(y.alias("a"), x.alias("b")))
    odd = both_ways(a + 1, b + 1)
    edges = cut(links.select(F.explode(F.when(F.col("alone") == 1, F.array(*odd)).otherwise(F.array(*odd, *both_ways(a, b)))).alias("e")).select("e.a", "e.b").distinct())
    nodes = named.select(F.explode(F.when(F.col("kind") == "regular", F.array(F.col("name_ord") * 2, F.col("name_ord") * 2 + 1)).otherwise(F.array(F.col("name_ord") * 2 + 1))).alias("a"))
    label = cut(_components(nodes, edges).select(F.floor(F.col("a") / 2).alias("name_ord"), (F.col("a") % 2).alias("odd"), F.floor(F.col("label") / 2).alias("label")).groupBy("name_ord").agg(
        F.max(F.when(F.col("odd") == 0, F.col("label"))).alias("g"), F.max(F.when(F.col("odd") == 1, F.col("label"))).alias("set")))
    grouped = parsed.join(label, "name_ord", "left")
    sets = label.join(alone.select("name_ord"), "name_ord").select("set").distinct()
    joined = grouped.where("kind <> 'role'").join(sets, "set", "left_semi").select("name_ord", "kind", "surname", "surname_key", "g", "set").groupBy("set").applyInPandas(
        _attach, "name_ord bigint, group_ord bigint, hits int")
    return grouped.join(joined, "name_ord", "left").select(
        "name", "words", "name_ord", "kind", F.coalesce("group_ord", "g", "name_ord").alias("group_ord"), F.coalesce("hits", F.lit(0)).alias("hits"))


def _components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(a, label): the smallest node that each node (a) is linked to by ``edges`` (a, b in both directions)."""
    label = cut(nodes.select("a", F.col("a").alias("label")))
    while True:
        near = edges.join(label.withColumnsRenamed({"a": "b", "label": "gb"}), "b").groupBy("a").agg(F.min("gb").alias("gb"))
        step = label.join(near, "a", "left").select("a", F.least("label", F.coalesce("gb", "label")).alias("label"), F.col("label").alias("old"))
        jump = step.select(F.col("a").alias("label"), F.col("label").alias("gg"))
        seen = Observation()
        new = cut(step.join(jump, "label", "left").select("a", F.least("label", F.coalesce("gg", "label")).alias("label"), "old").observe(
            seen, F.max((F.col("label") != F.col("old")).cast("int")).alias("moved")))
        drop(label)
        path = new._cut_path
        label = new.select("a", "label")
        label._cut_path = path
        if not seen.get["moved"]:
            return label


def _surname_meetings(alone: DataFrame, named: DataFrame) -> DataFrame:
    """(name_ord_a, name_ord_b): surnames alone and the names whose surname matches."""
    side = lambda df, s: df.select(*[F.col(c).alias(f"{c}_{s}") for c in ("name_ord", "surname", "surname_key")],
                                   F.substring("surname", 1, 1).alias("s1"), F.explode(_blocks(F.col("surname_key"))).alias("block"))
    pairs = side(alone, "a").join(side(named, "b"), ["s1", "block"]).where("name_ord_a <> name_ord_b").drop("s1", "block").distinct()
    sure = (F.col("surname_a") == F.col("surname_b")) | (F.col("surname_key_a") == F.col("surname_key_b"))
    may = (F.length("surname_key_a") >= KEY_LENGTH) & (F.length("surname_key_b") >= KEY_LENGTH)
    cols = ("name_ord_a", "name_ord_b")
    rest = pairs.where(~sure & may).withColumn("r", key_ratio("surname_key_a", "surname_key_b")).where(F.col("r") >= SURNAME_RATIO)
    return pairs.where(sure).select(*cols).unionByName(rest.select(*cols))


def _attach(rows: pd.DataFrame) -> pd.DataFrame:
    """Attach surnames alone, in order, to the only group they match; (name_ord, group_ord, hits)."""
    rows = rows.sort_values("name_ord")
    groups: dict[int, list[tuple[str, str]]] = {}
    for r in rows[rows.kind == "regular"].itertuples():
        groups.setdefault(int(r.g), []).append((r.surname, r.surname_key))
    out = []
    for r in rows.itertuples():
        g, hits = (int(r.g) if r.kind == "regular" else int(r.name_ord)), 0
        if r.kind == "wildcard":
            found = [k for k, held in groups.items() if any(_surnames(r.surname, r.surname_key, s, key) for s, key in held)]
            hits = len(found)
            if hits == 1:
                g = found[0]
                groups[g].append((r.surname, r.surname_key))
        out.append((r.name_ord, g, hits))
    return pd.DataFrame(out, columns=["name_ord", "group_ord", "hits"])


def _surnames(a: str, ka: str, b: str, kb: str) -> bool:
    if a == b or a[0] == b[0] and ka == kb:
        return True
    return a[0] == b[0] and min(len(ka), len(kb)) >= KEY_LENGTH and SequenceMatcher(None, ka, kb).ratio() >= SURNAME_RATIO


def speaker_ids(clustered: DataFrame) -> DataFrame:
    """(name, canonical, spk_id, words, group_words): the canonical spelling of a group is its most
    spoken one (of equals the earlier); canonicals are numbered by words (of equals the earlier),
    spk_1NNN for named speakers and spk_0NNN for roles."""
    top = clustered.groupBy("group_ord").agg(
        F.max_by("name", F.struct("words", -F.col("name_ord"))).alias("canonical"), F.sum("words").alias("group_words"), F.min("name_ord").alias("first_ord"))
    ranked = with_rank(top, F.desc("group_words"), F.asc("first_ord"), name="seq")
    kind = F.when(speaker_type(F.col("canonical")) == "Role", "0").otherwise("1")
    ranked = ranked.withColumn("spk_id", F.format_string("spk_%s%03d", kind, "seq"))
    return clustered.join(ranked, "group_ord").select("name", "canonical", "spk_id", "words", "group_words")


def speaker_sheet(turn_rows: DataFrame, ids: DataFrame, name: str = "raw_name") -> DataFrame:
    """(spk_id, canonical, title, first_name, middle_names, surname, speaker_type, words, files,
    file_list, shortest, longest): the statistics of each canonical speaker."""
    w = F.size(F.filter(F.split("body", r"(?U)\s+"), lambda t: t != ""))
    rows = turn_rows.withColumn("w", w.cast("bigint")).where("w > 0").join(ids.select(F.col("name").alias(name), "canonical", "spk_id"), name)
    per = rows.groupBy("spk_id", "canonical").agg(
        F.sum("w").alias("words"), F.count_distinct("file_idx").alias("files"),
        F.array_join(F.sort_array(F.collect_set("file_idx")), ", ").alias("file_list"), F.min("w").alias("shortest"), F.max("w").alias("longest"))
    p = parse_name(F.col("canonical"))
    return per.select(
        "spk_id", "canonical", titles_of(F.col("canonical")).alias("title"), F.coalesce(p["first"], F.lit("")).alias("first_name"),
        F.array_join(p["middles"], " ").alias("middle_names"), F.coalesce(p["surname"], F.col("canonical")).alias("surname"),
        speaker_type(F.col("canonical")).alias("speaker_type"), "words", "files", "file_list", "shortest", "longest")


def file_speaker_words(turn_rows: DataFrame, ids: DataFrame, name: str = "raw_name") -> DataFrame:
    """(file_idx, speakers, words MAP<spk_id, words>): the matrix of files and speakers, a map in
    place of one column per speaker so that any number of speakers fits; absent ones are left out."""
    w = F.size(F.filter(F.split("body", r"(?U)\s+"), lambda t: t != ""))
    per = turn_rows.withColumn("w", w.cast("bigint")).where("w > 0").join(ids.select(F.col("name").alias(name), "spk_id"), name).groupBy("file_idx", "spk_id").agg(F.sum("w").alias("w"))
    return per.groupBy("file_idx").agg(F.count("*").alias("speakers"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("spk_id", "w")))).alias("words"))


def matrix_columns(per_file: DataFrame, speakers: list[str]) -> DataFrame:
    """The matrix with a column for each of the given speakers, null where they say nothing."""
    return per_file.select("file_idx", "speakers", *[F.element_at("words", F.lit(s)).alias(s) for s in speakers])


def dedup_review(clustered: DataFrame, ids: DataFrame) -> DataFrame:
    """(section, canonical, name, words, spk_id, note): groups and single names (A), surnames
    alone that stayed unresolved (B), roles (C)."""
    size = clustered.groupBy("group_ord").agg(F.count("*").alias("members"))
    rows = clustered.join(size, "group_ord").join(ids.select("name", "canonical", "spk_id"), "name")
    section = F.when(F.col("kind") == "role", "C").when((F.col("kind") == "wildcard") & (F.col("hits") != 1), "B").otherwise("A")
    note = F.when(section == "C", "role").when(section == "B", F.format_string("%d groups", "hits")).when(F.col("members") > 1, "group").otherwise("single")
    return rows.select(section.alias("section"), "canonical", "name", "words", "spk_id", note.alias("note"))
