"""The operators of the subpackage on small tables: brute force, exact round trips, odd rows."""

import random

import pytest
from pyspark.sql import functions as F

from stenoloom.llm.bpe_lexicon import Transducer, encode, merge, read_ranks
from stenoloom.llm.components import connected_groups
from stenoloom.llm.golden_record import golden_records
from stenoloom.llm.language_id import language_code, stretches, train, training_rows, wrong_labels
from stenoloom.llm.leakage import leaks, longest_passage, passage_words
from stenoloom.llm.name_variants import Speller, name_groups, name_pairs, parse
from stenoloom.llm.page_repair import Repairer, line_form, page_findings, page_number, page_paragraphs
from stenoloom.llm.sentences import Splitter, count_events, learn, sentence_ends
from stenoloom.llm.speaker_turns import Cast, join_captions, overlap, pauses, speaker_turns, split_label, spoken
from stenoloom.llm.term_frequency import term_bitmaps, term_statistics

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
CLASH = "part int, idx bigint, kind string"  # extra columns under names used inside


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# 1 speaker turns

PEOPLE = [("s1", "MR. RAVEN KELSO", "RAVEN", None, "KELSO", "Named"), ("s2", "MS. NORA MEERA TALVINATH", "NORA", "MEERA", "TALVINATH", "Named"), ("s3", "COURT MASTER", None, None, None, "Role")]
SCHEMA = f"file_idx int, page_idx int, line_no int, line string, {CLASH}"


def _cast(spark):
    return spark.createDataFrame(PEOPLE, "spk_id string, speaker_name string, first_name string, middle_name string, surname string, speaker_type string")


def _script(spark, text, file=1, per_page=3):
    return [(file, k // per_page + 1, k % per_page + 1, x, 0, 0, "z") for k, x in enumerate(text)]


def test_turns(spark):
    text = ["nobody speaks", "[00:01:02] MR. KELSO: Good um, day", "page 4: see", "12", "THE COURT MASTER:", "[COUGHS] *door", "slams*", ">> R. KELSO (CONTD.): again", None, "  ",
            "TALVINAHT, NORA – yes", "Mr. Kelso put it thus: no", "MS N TALVINATH: more", "kelso:- uhm...", "Kelso: end"]
    data = _script(spark, text) * 2 + _script(spark, ["MS. TALVINATH: x"], 2) + [(None, 1, 1, "KELSO: y", 0, 0, ""), (3, 1, 1, None, 0, 0, "")]
    got = rows(speaker_turns(spark.createDataFrame(data, SCHEMA).repartition(5), _cast(spark)).select("file_idx", "page_idx", "line_no", "spk_id", "text"))
    assert got == [(1, 1, 2, "s1", "Good day page 4: see again"), (1, 4, 2, "s2", "yes Mr. Kelso put it thus: no more"), (1, 5, 3, "s1", "end"), (2, 1, 1, "s2", "x")]
    assert speaker_turns(spark.createDataFrame([], SCHEMA), _cast(spark)).count() == 0


def test_turns_do_not_depend_on_partitions(spark):
    rnd = random.Random(3)
    text = [rnd.choice(["KELSO: a", "MS. TALVINATH:", "b c", "COURT MASTER: d", "um", "7"]) for _ in range(600)]
    df = spark.createDataFrame(_script(spark, text), SCHEMA)
    want = None
    for n in ("1", "3", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = rows(speaker_turns(df, _cast(spark)))
        want = want or got
        assert got == want
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_labels_and_captions():
    cast = Cast(PEOPLE)
    assert split_label("<00:12> MS. N. TALVINATTH : so", cast) == ("s2", " so")
    assert split_label("SECTION 3: so", cast) is None and split_label("MR. OTHER PERSON: so", cast) is None
    assert spoken("Um, [NO AUDIO] yes err... {noise} 00:01:02 no") == "yes no"
    assert join_captions(["we say that the", "say that the case fails", "case fails"]) == "we say that the say that the case fails case fails"
    assert join_captions(["a b c d e", "b c d e f"]) == "a b c d e f"
    long = [f"w{k}" for k in range(60)]
    assert join_captions([" ".join(long[:55]), " ".join(long[5:])]).split() == long  # no bound on the overlap
    rnd = random.Random(1)
    for _ in range(300):
        x, y = ([rnd.choice("ab") for _ in range(rnd.randrange(9))] for _ in range(2))
        assert overlap(x, y) == max(k for k in range(min(len(x), len(y)) + 1) if x[len(x) - k :] == y[:k])


def test_layout_of_one_file(spark):
    # the header of one file is layout there whatever else the collection holds; elsewhere it is speech
    one = [x for k in range(8) for x in ("Halvin Matter Record", f"KELSO: yes {k}", "TALVINATH:")]
    other = ["KELSO:", "Halvin Matter Record", "and so"]
    data = _script(spark, one) + _script(spark, other, 2) + [(f, p, k, f"word {f} {p} {k}", 0, 0, "z") for f in range(10, 60) for p in range(1, 4) for k in range(1, 9)]
    got = rows(speaker_turns(spark.createDataFrame(data, SCHEMA), _cast(spark)).where("file_idx < 10"))
    assert got == [(1, 1, 2, "s1", " ".join(f"yes {k}" for k in range(8))), (2, 1, 1, "s1", "Halvin Matter Record and so")]


def test_pauses(spark):
    text = [f"[00:0{k // 6}:{10 * (k % 6):02d}] KELSO: a" for k in range(20)] + ["[00:30:00] b", "[00:30:10] c", "d"]
    back = [f"[00:{50 - k}:00] KELSO: a" for k in range(20)]
    df = spark.createDataFrame(_script(spark, text) + _script(spark, back, 2), SCHEMA)
    assert rows(pauses(df)) == [(1, 7, 3, 1610)]  # 00:03:10 to 00:30:00; file 2 has no time axis
    got = rows(speaker_turns(df, _cast(spark), split_at_pauses=True).select("file_idx", "page_idx", "line_no", "spk_id", "text"))
    assert got == [(1, 1, 1, "s1", " ".join("a" * 20)), (1, 7, 3, "s1", "b c d"), (2, 1, 1, "s1", " ".join("a" * 20))]
    assert pauses(df.limit(0)).count() == 0


# 2 golden records

REC = ("record_id bigint, grp string, speaker_name string, title string, first_name string, middle_name string, surname string, total_words bigint, file_count int, "
       "shortest_segment int, longest_segment int, reviewed int, updated_at timestamp, k string, bound int")


def test_golden_records(spark):
    t = lambda d: f"2024-01-0{d} 00:00:00"
    data = [
        (1, "g", "MR. IVAN LEO KELSO", "MR.", "IVAN", None, "KELSO", 5, 1, 1, 9, 0, t(1)), (2, "g", "MR. IVAN LEO KELOS", None, "IVAN", "LEO", None, 7, 1, 1, 9, 0, t(3)),
        (3, "g", "MR. IVAN LEO KELSO", None, None, None, "KELSO", 999999999, 1, 1, 9, 1, t(4)), (4, "g", "TEST RECORD PLEASE IGNORE THIS ONE", None, None, None, None, -1, 1, 1, 9, 1, t(5)),
        (5, "h", None, None, None, None, None, 3, 1, 1, 9, None, None), (6, "h", "???", None, None, None, None, 0, 1, 1, 9, 0, t(2)), (7, None, "MS. NORA RAO", "MS.", None, None, None, None, 1, 1, 9, 0, t(1))]
    df = spark.createDataFrame([(*r[:12], None, "x", 1) for r in data], REC).withColumn(
        "updated_at", F.element_at(F.create_map(*[F.lit(x) for r in data if r[12] for x in (r[0], r[12])]), F.col("record_id")).try_cast("timestamp"))
    got = rows(golden_records(df.unionByName(df)).select("grp", "speaker_name", "total_words", "middle_name", "n_records"))
    assert got == [("g", "MR. IVAN LEO KELSO", 7, "LEO", 4), ("h", None, 3, None, 2), (None, "MS. NORA RAO", None, None, 1)]
    assert golden_records(df.limit(0)).count() == 0


def test_name_and_parts_agree(spark):
    r = lambda k, g, name, first, middle, last, rev: (k, g, name, None, first, middle, last, 5, 1, 1, 9, rev, None, "x", 1)
    data = [r(1, "a", "DR. IVAN LEO KELSO", None, "LEO", "KELSO", 0), r(2, "a", "DR. IVAN LEO KELSO", "IVAN", None, "KELSO", 0), r(3, "a", "DR. OSKAR LEO KELSO", None, None, "KELSO", 1), r(4, "a", "DR. IVAN KELSO", "IVAN", None, None, 0),
            r(5, "b", "NORA MEERA RAO", "NORA", "MEERA", None, 0), r(6, "b", "NORA MEERA RAO", "NORA", None, "RAO", 0), r(7, "b", "NORA RAO", "NORAH", None, "RAO", 1)]
    got = rows(golden_records(spark.createDataFrame(data, REC)).select("grp", "speaker_name", "first_name", "middle_name", "surname"))
    assert got == [("a", "DR. IVAN LEO KELSO", "IVAN", "LEO", "KELSO"), ("b", "NORA MEERA RAO", "NORA", "MEERA", "RAO")]


def test_search_prunes(spark):
    from stenoloom.llm.golden_record import candidates, search

    # the fullest spelling contradicts the voted surname; of the rest only what could beat the first is tried
    spell = spark.createDataFrame(
        [("a", False, x, 0, n, None) for x, n in (("MR. IVAN LEO BRAN KELVIN", 9), ("MR. IVAN KELSO", 1), ("IVAN KELSO", 5), ("KELSO", 7))] + [("b", False, x, 0, n, None) for x, n in (("MS. NORA RAO", 1), ("NORA RAO", 9), ("RAO", 3))],
        "g string, g0 boolean, speaker_name string, rev int, n bigint, at timestamp")
    voted = spark.createDataFrame([("a", False, None, "IVAN", None, "KELSO"), ("b", False, "MS.", "NORA", None, "RAO")], "g string, g0 boolean, title string, first_name string, middle_name string, surname string")
    best, rest = search(candidates(spell), voted)
    assert {(r.g, r.speaker_name) for r in best.collect()} == {("a", "MR. IVAN KELSO"), ("b", "MS. NORA RAO")}
    assert {r.g for r in rest.collect()} == {"a"}
    r = lambda k, name, first, last, rev: (k, "g", name, None, first, None, last, 5, 1, 1, 9, rev, None, "x", 1)
    got = golden_records(spark.createDataFrame([r(1, None, "IVAN", "KELSO", 1), r(2, "MR. IVAN LEO BRAN KELVIN", None, None, 0)], REC)).first()
    assert (got.speaker_name, got.first_name, got.surname) == ("MR. IVAN LEO BRAN KELVIN", "IVAN", None)  # no record that no source holds


# 3 term frequency

TF = "file_idx int, category string, token string, frequency bigint, loaded_at string, block int, bits int"


def test_terms(spark):
    data = [(1, "Word", "The,", 2, "b", 0, 0), (1, "Word", "The,", 9, "a", 0, 0), (70, "Word", "the", 1, None, 0, 0), (70, "Word", None, 5, "a", 0, 0), (2, "Word", "...", 5, "a", 0, 0),
            (2, "SPLT", " 1A\t", 4, "a", 0, 0), (3, "SPLT", "1A", 0, "a", 0, 0), (None, "Word", "x", 3, "a", 0, 0), (4, "Word", "", 3, "a", 0, 0), (5, "Word", "it's", None, "z", 0, 0), (5, "Word", "it's", 3, "a", 0, 0)]
    df = spark.createDataFrame(data * 2, TF)
    assert rows(term_statistics(df)) == [("SPLT", "1A", 4, 1, "rare"), ("Word", "the", 3, 2, None)]
    assert rows(term_bitmaps(df).where("token = 'the'").select("block", "bits", "total")) == [(0, 2, 2), (1, 64, 1)]
    assert term_statistics(df.limit(0)).count() == 0


# 4 name variants

def test_name_variants(spark):
    given = ["IVAN", "NORA", "RAVEN", "MARGARET"]
    data, k = [], 0
    for tag in ("a", "b", "c", "d", "e"):
        stem = {"a": "KELS", "b": "BORV", "c": "TALM", "d": "DRAN", "e": "GORH"}[tag]
        data += [(50 + ord(tag), tag, f"{stem}ILAN RIVER TRUST")]
        for i, g in enumerate(given):
            for n in (f"MR. {g} {stem}{'OTUV'[i]}WICK", f"{g} {stem}{'OTUV'[i]}WICK"):
                k += 1
                data.append((k, tag, n))
    extra = ["MR. I. KELSOWICK", "KELSOWICK, IVAN", "IVANKELSOWICK", "IVAN KELSO WICK", "IVN KELSOWICK", "Ivan Kelsowcik", "MAGGIE KELSVWICK", "COUNSEL 1", "COUNSEL 2", "  counsel 1 ",
             "THE KELTAN RIVER TRUST", "RIVER TRUST OF KELTAN", "K.R.T.", None, "", "?!"]
    data += [(100 + i, "a", n) for i, n in enumerate(extra)] + [(100, "a", extra[0]), (None, "a", "X Y"), (200, None, "IVAN KELSOWICK")]
    df = spark.createDataFrame(data, "name_id bigint, tag string, raw_name string").withColumn("form", F.lit(1)).withColumn("entity", F.lit("e"))
    got = {}
    for r in name_groups(df).collect():
        got.setdefault((r.tag, r.entity), set()).add(r.name_id)
    sets = {frozenset(v) for v in got.values()}
    assert frozenset({1, 2, 100, 101, 102, 103, 104, 105}) in sets and frozenset({7, 8, 106}) in sets
    assert frozenset({107, 109}) in sets and frozenset({108}) in sets and frozenset({110, 111, 112}) in sets and frozenset({200}) in sets
    pairs = {tuple(r) for r in name_pairs(df).collect()}
    assert pairs == {tuple(r) for r in name_pairs(df, part=2).collect()}  # entities in parts
    assert (107, 109) in pairs and all(a < b for a, b in pairs) and len(pairs) == sum(len(s) * (len(s) - 1) // 2 for s in sets)
    assert name_pairs(df.limit(0)).count() == 0
    assert parse("PETITIONER'S COUNSEL 3", Speller({}))[0] == "R" and parse("  ", Speller({})) is None


def test_given_names_outside_the_prior(spark):
    same = [["JADWIGA KELSOWICK", "MS. JADWIGA KELSOWICK", "Jadwiga Kelsowick", "JADWGA KELSOWICK", "JADIWGA KELSOWICK", "JADWIGA KELSOWCK", "JADWGA KELSOWCK", "JAD WIGA KELSOWICK", "JADWIGAKELSOWICK"],
            ["ZBIGNIEW BORVAMERE", "MR ZBIGNIEW BORVAMERE", "ZBIGNEIW BORVAMERE"], ["TEODORA BORVAMERE", "MS TEODORA BORVAMERE"], ["THEODORE BORVAMERE", "MR THEODORE BORVAMERE"]]
    data = [(10 * i + k, "a", x) for i, names in enumerate(same) for k, x in enumerate(names)] + [(90, "b", "JADWIGA TALMOTRA"), (91, "b", "JADWIGA KELSOWICK")]
    df = spark.createDataFrame(data, "name_id bigint, tag string, raw_name string")
    got = {}
    for r in name_groups(df).collect():
        got.setdefault(r.entity, set()).add(r.name_id)
    assert {frozenset(v) for v in got.values()} == {frozenset(10 * i + k for k in range(len(x))) for i, x in enumerate(same)} | {frozenset({90}), frozenset({91})}


# 5 components

@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rnd = random.Random(seed)
    data = [(rnd.randrange(60), rnd.randrange(60), rnd.choice([1, 1, 0, None])) for _ in range(70)] + [(k, k + 1, 1) for k in range(100, 140)] + [(500, k, 1) for k in range(501, 540)] + [(None, 7, 1), (900, None, 1), (901, 901, 1)]
    parent = {x: x for r in data for x in r[:2] if x is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b, m in data:
        if m == 1 and a is not None and b is not None:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    df = spark.createDataFrame(data * 2, "a bigint, b bigint, m int").withColumn("p", F.lit(1)).withColumn("v", F.lit(2))
    assert {tuple(r) for r in connected_groups(df, "a", "b", F.col("m") == 1).collect()} == {(x, find(x)) for x in parent}
    assert connected_groups(df.limit(0), "a", "b").count() == 0


# 6 scanned pages

WORDS = ["evidence", "the", "of", "counter-affidavit", "was", "filed", "before", "bench", "and", "record", "tribunal", "heard"]


def test_pages(spark):
    page = lambda n, body: f"VERBATlM RECORD    Page {n}\n{body}\n- {n} -"
    data = [(10 + k, 1, k, page(k, b)) for k, b in enumerate([
        "the evi-\ndence of the bench was hcard", "the counter-affi­\ndavit was filed\n\nbef0re the tribunal.", "and the record", "was filed"], 1)]
    data = [(*r, "x") for r in data * 2 + [(90, 2, 1, None), (91, 2, 2, ""), (92, 2, 3, " \n "), (93, None, None, "the of")]]
    df = spark.createDataFrame(data, "page_id bigint, file_idx int, page_idx int, t string, forms string")
    words = spark.createDataFrame([(w,) for w in WORDS] + [(None,)], "word string")
    got = rows(page_findings(df, words, "t"))
    assert [r for r in got if r[2] != "furniture"] == [(11, 2, "hyphen", "evidence"), (11, 3, "char", "heard"), (12, 2, "hyphen", "counter-affidavit"), (12, 5, "char", "before")]
    assert {(r[0], r[1]) for r in got if r[2] == "furniture"} == {(11, 1), (11, 4), (12, 1), (12, 6), (13, 1), (13, 3), (14, 1), (14, 3)}
    assert rows(page_paragraphs(df, words, "t"))[:3] == [(11, 1, "the evidence of the bench was heard"), (12, 1, "the counter-affidavit was filed"), (12, 2, "before the tribunal.")]
    assert page_findings(df.limit(0), words, "t").count() == 0


def test_corpus_words_and_forms_of_blocks(spark):
    body = ["the of Talmo-\ntra and", "was Talmotra of", "the Kelso-\nborv was", "heard Kelso-Borv and kelso-borv of", "the Gorh-\nWick was", "bench the of"]
    # a footer that ends like running text, numbers in two series, and a service's line once in each of two more files
    rnd = random.Random(9)
    new = lambda: " ".join("".join(rnd.choice("aoprstvwxyz") for _ in range(12)) for _ in range(3))
    data = [(k, 1, k, f"{new()}\n{x}\n{new()}\nrecord of the Kelmora Tribunal;\n{k if k < 4 else k + 20}") for k, x in enumerate(body, 1)]
    data += [(100 + 10 * f + k, f, k, f"Voxmere Typists\nthe of {f} {k}\nand was") for f in (5, 6, 7) for k in (1, 2)] + [(200, 8, 1, "Voxmere Typists\nthe of\nand was"), (300, None, 1, "Voxmere Typists\nthe of")]
    df = spark.createDataFrame(data, "page_id bigint, file_idx int, page_idx int, t string").withColumn("counts", F.lit(1)).withColumn("own", F.lit(1))
    got = rows(page_findings(df, spark.createDataFrame([(w,) for w in WORDS], "word string"), "t"))
    assert [(r[0], r[3]) for r in got if r[2] == "hyphen"] == [(1, "talmotra"), (3, "kelso-borv"), (5, "gorh-wick")]
    assert {(r[0], r[1]) for r in got if r[2] == "furniture" and r[0] < 10} == {(k, n) for k, x in enumerate(body, 1) for n in (4 + x.count("\n"), 5 + x.count("\n"))}
    assert {r[0] for r in got if r[2] == "furniture" and r[0] > 10} == {r[0] for r in data if 10 < r[0] < 300}


def test_page_parts():
    assert page_number("[1OO2]") == (1002, True) and page_number("in 1990.") is None and page_number("7")[0] == 7
    assert line_form("Rc: Halvin C0mmission   12") == line_form("RE: HALVIN COMMISSION")
    mend = Repairer(WORDS)
    assert [mend.right(w, False) for w in ("evidcnce", "0f", "an", "10b", "bench", "tribiinal", "fi1ed")] == ["evidence", "of", None, None, None, "tribunal", "filed"]


# 7 sentences

TURNS = ["Dr. Rao came at 5.30 p.m. He left. Dr. Sen stayed at p. 4 of it.", "Then he left us at one p.m. We go on as before and it is so\n", "We met Dr. Pal. He said, \"Is it so? No,\" and sat. “It is over.” We go on.", "No mark here\n\nNew part e.g. this one! Really?!"] * 8


def test_sentences(spark):
    data = [(k, t, "en") for k, t in enumerate(TURNS)] + [(90, None, "en"), (91, " \n", None), (92, "证据……无效。他说：“对吗？不信。”然后坐下。「終わりです。」次。", "zh"), (93, "क्या है? हाँ। ठीक ।", "hi"), (94, "...", None)]
    df = spark.createDataFrame(data, "turn_id bigint, t string, lang string").withColumn("end_pos", F.lit(0))
    far = Splitter({"en": {"S": {"the": (50.0, 1.0)}, "A": {"dr": (9.0, 0.0)}}})
    assert len(far.ends("He saw Dr." + " " * 500 + "Rao. " + "He left.", "en")) == 2 and len(far.ends("He saw " + "x" * 300 + ". the end", "en")) == 2
    got = {}
    for r in sentence_ends(df, "turn_id", "t", "lang").collect():
        got.setdefault(r.turn_id, []).append(r.end_pos)
    parts = {k: [data[k][1][a:z].strip() for a, z in zip([0, *sorted(v)], sorted(v))] for k, v in got.items() if k < 90}
    assert parts[0] == ["Dr. Rao came at 5.30 p.m.", "He left.", "Dr. Sen stayed at p. 4 of it."]
    assert parts[2] == ["We met Dr. Pal.", "He said, \"Is it so? No,\" and sat.", "“It is over.”", "We go on."]
    assert parts[3] == ["No mark here", "New part e.g. this one!", "Really?!"]
    assert sorted(got[92]) == [7, 23, 31, 33] and sorted(got[93]) == [8, 13, 19] and not {90, 91, 94} & set(got)
    assert sentence_ends(df.limit(0), "turn_id", "t", "lang").count() == 0
    long = "It is so. " * 20000
    assert len(Splitter(learn(df, "t", "lang")).ends(long, None)) == 20000


def test_starters_and_collocations(spark):
    names = ["Rao", "Sen", "Pal", "Das", "Kelso", "Borv", "Talm", "Dran"]
    data = [f"The day was long! The man saw the house and Dr. {a} saw the man? He sat with J. {b} as he had to. It was so. Then {a} left us at the house. All was well" for a in names for b in names]
    data += [f"We read Sen v. The Crown of {a} and the rest" for a in names] * 2 + [f"We read Sen v. {a} and the rest" for a in names] * 6 + [f"It fell on 8. Brumaire in the year {a}! In Brumaire the days in Brumaire and in Brumaire are cold" for a in names]
    odd = ["We chose plan B. The man left.", "He is a good Dr. The man left.", "We met J. A. Rao. He left.", "We met Dr. Kelso. He left.", "It was Pal v. The Crown. He left.", "We met J. Talm. He left.", "It is 7. Brumaire.", "It has 7. The man left."]
    df = spark.createDataFrame([(k, t, "en") for k, t in enumerate(data + odd)], "k int, t string, lang string")
    split = Splitter(learn(df, "t", "lang"))
    assert [len(split.ends(t, "en")) for t in odd] == [2, 2, 2, 2, 2, 2, 1, 2]
    assert {"v the", "## brumaire"} <= set(split.model["en"]["D"]) and not {"dr the", "## the"} & set(split.model["en"]["D"])


def test_language_of_long_texts(spark):
    model = {"en": {"A": {"dr": (9.0, 0.0)}, "F": {w: (0.1, 0.0) for w in ("the", "was", "it", "so")}}, "fr": {"F": {w: (0.1, 0.0) for w in ("la", "cour", "est")}}}
    opening, rest = "La cour est la cour. " * 250, "It was so the Dr. Rao it was. " * 600
    assert len(opening) > 4000 and Splitter(model).of("", opening + rest) is model["en"]
    assert len(Splitter(model).ends(opening + rest, None)) == 250 + 600
    text = "HIGH COURT OF RECORD. " * 30 + "क्या यह ठीक है। " * 300
    df = spark.createDataFrame([(text, None), (opening, "fr")], "t string, lang string")
    assert len(text[: text.index("क")]) > 400 and {r.lang for r in count_events(df, "t", "lang").select("lang").distinct().collect()} == {"und-Deva", "fr"}


# 8 encoding

def test_encoding(spark):
    tiktoken = pytest.importorskip("tiktoken")
    from stenoloom.llm.bpe_lexicon import SPLIT

    ranks = read_ranks(RANKS)
    want = tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    texts = ["Kelhawickpur said: we'll see!  \n\n x", "", None, "<|endoftext|> 证据 है 🙂", "a" * 5000, " ", "Kelhawickpur said"] * 3
    df = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)] + [(None, "x", 1)], "doc_id bigint, text string, ids int")
    for size in (0, 5, 1000):
        got = {r.doc_id: r.ids for r in encode(df, "doc_id", "text", RANKS, size).collect()}
        assert got == {k: want(t or "") for k, t in enumerate(texts)} | {None: want("x")}
    assert encode(df.limit(0), "doc_id", "text", RANKS).count() == 0


def test_transducer(tmp_path):
    rnd = random.Random(5)
    words = sorted({bytes(rnd.choice(b"abcde") for _ in range(rnd.randrange(1, 7))) for _ in range(900)} | {b""})
    t = Transducer.compile(words, [[k] for k in range(len(words))])
    assert len(t.count) < sum(map(len, words)) / 2  # suffixes are shared
    (tmp_path / "t").write_bytes(t.dump())
    t = Transducer.map(str(tmp_path / "t"))
    asked = words + [b"zz", b"abcdeabcde", b"q"]
    assert t.numbers(asked).tolist() == [*range(len(words)), -1, -1, -1]
    assert merge(b"abab", {b"a": 0, b"b": 1, b"ab": 2, b"abab": 3}) == [3] and merge(b"aba", {b"a": 0, b"b": 1, b"ab": 2}) == [2, 0]


# 9 leakage

def test_leaks(spark):
    rnd = random.Random(7)
    vocabulary = [f"w{k}" for k in range(400)]
    items = {k: [rnd.choice(vocabulary) for _ in range(40)] for k in range(12)}
    noise = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    docs, want = [], set()
    for k, w in items.items():
        changed = [x if i % 9 else "uhm" for i, x in enumerate(w)]
        for share, text in ((1, w), (1, [x.upper() + "," for x in w]), (1, changed), (1, w[8:30]), (0, w[:15]), (0, w[::2])):
            docs.append((len(docs), " ".join(noise(50) + text + noise(50))))
            if share:
                want.add((len(docs) - 1, k))
    data = docs * 2 + [(900, None), (901, ""), (902, "one two"), (None, " ".join(items[0]))]
    d = spark.createDataFrame(data, "doc_id bigint, text string").withColumn("h", F.lit(0)).withColumn("n", F.lit(0))
    i = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()] + [(50, None), (51, ""), (52, "a b")], "item_id bigint, text string")
    for block in (5, 100):
        assert {tuple(r) for r in leaks(d, "doc_id", "text", i, "item_id", "text", block=block).collect()} == want
    assert leaks(d.limit(0), "doc_id", "text", i, "item_id", "text").count() == 0 and leaks(d, "doc_id", "text", i.limit(0), "item_id", "text").count() == 0


def test_connected_passages(spark):
    rnd = random.Random(11)
    new = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    phrase = "please take the {} first and then come to the {} why was the {} kept out of the {}".split()
    docs, items, want = [], {}, set()
    for k, m in enumerate([40, 100, 200] * 3):
        w = items[k] = new(m)
        q = m // 4
        third = [x if i % 3 != 2 else f"x{i}" for i, x in enumerate(w)]
        put_in = [y for i, x in enumerate(w) for y in ((x, f"x{i}") if i % 3 == 2 else (x,))]
        left_out = [x for i, x in enumerate(w) if i % 4 != 3]
        marks = [y for i, x in enumerate(w) for y in ((x, "[00:01:02,500]", "(door slams)", "um,") if i % 5 == 4 else (x,))]
        pieces, swapped, turned = w[:q] + new(q) + w[q : 2 * q], w[: q] + new(4) + w[q + 4 : 2 * q + 4], w[q : 2 * q] + w[:q]
        apart_in_item = w[:q] + w[2 * q : 3 * q]
        for leaked, text in ((1, third), (1, put_in), (1, left_out), (1, marks), (1, w[q : 3 * q]), (0, w[q : 3 * q - 2]), (0, pieces), (0, swapped), (0, turned), (0, apart_in_item)):
            docs.append((len(docs), " ".join(new(rnd.randrange(60)) + text + new(rnd.randrange(60)))))
            if leaked:
                want.add((len(docs) - 1, k))
    items[20] = [x.format(f"n{i}") for i, x in enumerate(phrase)] + new(len(phrase))  # the turns of phrase alone are no half
    docs += [(1000 + i, " ".join(new(5) + [x.format(rnd.random()) for x in phrase] + new(5))) for i in range(50)]
    items |= {30: ["mens", "rea"], 31: ["estoppel"], 32: ["res", "ipsa", "loquitur", "est"]}  # short ones stand whole
    docs += [(2000, "the Mens-Rea is"), (2001, "rea mens"), (2002, "ESTOPPEL"), (2003, "res ipsa loquitur"), (2004, "so: res, ipsa loquitur est")]
    want |= {(2000, 30), (2002, 31), (2004, 32)}
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("_item", F.lit(0))
    i = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id bigint, text string")
    for block in (100, 10**6):
        assert {tuple(r) for r in leaks(d, "doc_id", "text", i, "item_id", "text", block=block).collect()} == want
    # brute force: every item against every text, without seeds, prefix or bounds
    brute = {(k, x) for k, t in docs for x, w in items.items() if len(w) > 4 and longest_passage(passage_words(" ".join(w)), passage_words(t)) * 2 >= len(passage_words(" ".join(w)))}
    assert brute == {(k, x) for k, x in want if x < 30}


# 10 languages

TEXT = {"en": "the court heard the evidence and the witness was before the bench", "fr": "la cour a entendu le témoin et la preuve est devant le juge", "de": "das gericht hört den zeugen und die klage ist vor der kammer"}


def _doc(code, rnd, n=4):
    return ". ".join(" ".join(rnd.sample(TEXT[code].split(), 9)) for _ in range(n)) + "."


def test_languages(spark):
    rnd = random.Random(2)
    data = [(k * 3 + j, _doc(c, rnd), c) for k in range(40) for j, c in enumerate(TEXT)]
    odd = [(900, _doc("fr", rnd), "en"), (901, _doc("en", rnd) + " " + _doc("de", rnd), "en"), (902, _doc("de", rnd), None), (903, _doc("de", rnd), "und"), (904, _doc("en", rnd), "EN-gb"),
           (905, None, "en"), (906, "", None), (907, "12 !!", None), (908, _doc("en", rnd) + " mens rea.", "en"), (None, _doc("en", rnd), "xx")]
    df = spark.createDataFrame(data + odd, "doc_id bigint, text string, lang string").withColumn("seg_no", F.lit(0)).withColumn("label", F.lit(0)).withColumn("key", F.lit(0))
    got = {}
    for r in wrong_labels(df, "doc_id", "text", "lang").orderBy("seg_no").collect():
        got.setdefault(r.doc_id, []).append(r.lang)
    assert got == {900: ["fr"], 901: ["en", "de"], 902: ["de"], 903: ["de"], None: ["en"]}
    all_rows = stretches(df, "doc_id", "text", "lang")
    assert all(0 < r.confidence <= 1 for r in all_rows.collect()) and all_rows.where("doc_id < 900").count() == 120
    assert wrong_labels(df.limit(0), "doc_id", "text", "lang").count() == 0
    held = [(c, _doc(c, rnd)) for c in TEXT for _ in range(50)]
    from stenoloom.llm.language_id import Models

    models = Models(*train([(c, t) for _, t, c in data]))
    assert sum(models.best(t) == c for c, t in held) == len(held)  # held-out accuracy
    codes = spark.createDataFrame([("En",), ("en-001",), ("pt_BR",), ("xx",), ("unknown",), ("",), (None,)], "l string").select(language_code(F.col("l")).alias("c")).collect()
    assert [r.c for r in codes] == ["en", "en", "pt", None, None, None, None]


def test_every_language_has_a_sample(spark):
    # one text fills the table of "en" and is in its share; "pt" is in long texts only; copies do not crowd out "zh"
    data = [("the court heard the evidence", "en")] * 900 + [(TEXT["fr"] + f" {k}", "fr") for k in range(5)] + [("o tribunal ouviu a prova. " * 1000, "pt"), ("法院听取了证据", "zh")]
    got = training_rows(spark.createDataFrame(data, "t string, lang string"), "t", "lang", sample=20)
    assert {c: sum(x == c for x, _ in got) for c in ("en", "fr", "pt", "zh")} == {"en": 1, "fr": 5, "pt": 2, "zh": 1}
    assert all(len(t) <= 20_000 and t.strip().endswith(".") for c, t in got if c == "pt")
