"""Golden vectors of the cleaned and the spoken form, numbers, names and non-standard words."""

import pytest
from pyspark.sql import functions as F

from stenoloom.functions import names as nm
from stenoloom.functions import numbers as nb
from stenoloom.functions.clean import COMMON_ABBREVIATIONS, cleaned, for_review, pre_clean
from stenoloom.functions.nsw import classify, find
from stenoloom.functions.spoken import spoken_form
from stenoloom.sources.lexicon import abbreviation_set, read_abbreviations, read_aliases

GOLDEN = [
    ("A.K. Sen", "A K Sen", "a k sen"), ("7(2)", "7 ( 2 )", "seven two"), ("I ve said it s so", "I've said it's so", "i've said it's so"),
    ("sadr-e-riyasat", "sadr e riyasat", "sadr e riyasat"), ("non-obstante", "nonobstante", "nonobstante"), ("north-west", "north west", "north west"),
    ("370", "370", "three seventy"), ("300", "300", "three hundred"), ("1950", "1950", "nineteen fifty"), ("1000", "1000", "one thousand"),
    ("1100", "1100", "eleven hundred"), ("2023", "2023", "twenty twenty three"), ("105", "105", "one five"), ("5,000", "5,000", "five zero"),
    ("23729", "23729", "two three seven two nine"), ("page 1234", "page 1234", "page one two three four"), ("Art. 370", "Art . 370", "article three seventy"),
    ("in that para", "in that para", "in that paragraph"), ("para 5", "para 5", "para five"), ("32%", "32%", "thirty two percent"),
    ("12.5%", "12.5%", "twelve point five percent"), ("4:00", "4:00", "four o'clock"), ("10:30", "10:30", "ten thirty"),
    ("25/03/71", "25/03/71", "twenty five three seventy one"), ("Chapter VIII-A", "Chapter VIII A", "chapter eight a"), ("Part IX-A", "Part IXA", "part ixa"),
    ("1960s", "1960s", "nineteen sixties"), ("90s", "90s", "nineties"), ("45s", "45 s", "forty five s"), ("310km", "310 km", "three hundred and ten kilometre"),
    ("J&K", "J&K", "j and k"), ("A & B", "A & B", "a and b"), ("Dr. Singhvi", "Dr . Singhvi", "doctor singhvi"), ("I... I'm", "I . I'm", "i . i'm"),
    ("I.. I'm", "I , I'm", "i i'm"), ("[UNCLEAR] yes", "<noise> yes", "yes"), ("Please, my Lords.", "Please , my Lords .", "please my lords ."),
    ("007", "007", "seven"), ("21st", "21st", "twenty first"), ("section did", "section did", "section nine ninety nine"), ("", "", ""), (None, None, None),
]


def test_golden_forms(spark):
    df = spark.createDataFrame(GOLDEN, "t string, v1 string, v3 string").withColumn("a", cleaned(F.col("t")))
    for r in df.withColumn("b", spoken_form(F.col("a"))).collect():
        assert (r.a, r.b) == (r.v1, r.v3), r.t


def test_very_long_text(spark):
    text = "The 3 items at 5% " * 3000
    v1 = spark.createDataFrame([(text,)], "t string").withColumn("t", cleaned(F.col("t")))
    out = v1.select(spoken_form(F.col("t")).alias("x")).first().x
    assert out == ("the three items at five percent " * 3000).strip()


@pytest.mark.parametrize(("n", "words"), [
    (0, "zero"), (100, "one hundred"), (310, "three hundred and ten"), (1001, "one thousand and one"), (1234, "one thousand, two hundred and thirty four"),
    (1_000_000, "one million"), (1_001_000, "one million, one thousand"), (2_000_017, "two million and seventeen")])
def test_cardinal(spark, n, words):
    assert spark.range(1).select(nb.cardinal(F.lit(n)).alias("w")).first().w == words


def test_ordinals_and_romans(spark):
    want = {1: "first", 2: "second", 3: "third", 5: "fifth", 8: "eighth", 9: "ninth", 12: "twelfth", 20: "twentieth", 40: "fortieth", 100: "one hundredth", 101: "one hundred and first"}
    rows = spark.createDataFrame([(k,) for k in want], "n bigint").select("n", nb.ordinal(F.col("n")).alias("w")).collect()
    assert {r.n: r.w for r in rows} == want
    got = spark.createDataFrame([("IV",), ("xc",), ("DID",)], "s string").select(nb.roman(F.col("s")).alias("n")).collect()
    assert [r.n for r in got] == [4, 90, 999]


def test_names(spark):
    rows = [("MR. RAVEN KELSO",), ("JUSTICE D.Y. MARLOWE",), ("MR. SHARMA",), ("COURT MASTER",), ("ATTORNEY GENERAL",), ("MR. MR. MR. DR. DR. prof. KELSO",), ("MR. JUSTICE",), ("ATTORNEY GENERAL R. KELSO",), (None,)]
    p = nm.parse_name(F.col("n"))
    got = spark.createDataFrame(rows, "n string").select(
        nm.strip_titles(F.col("n")).alias("s"), p["first"].alias("f"), p["surname"].alias("l"), nm.speaker_type(F.col("n")).alias("k"), nm.titles_of(F.col("n")).alias("t")).collect()
    assert [(r.s, r.f, r.l, r.k, r.t) for r in got[:8]] == [
        ("RAVEN KELSO", "RAVEN", "KELSO", "Named", "MR"), ("D Y MARLOWE", "D", "MARLOWE", "Named", "JUSTICE"), ("SHARMA", None, "SHARMA", "Named", "MR"),
        ("COURT MASTER", None, None, "Role", ""), ("ATTORNEY GENERAL", "ATTORNEY", "GENERAL", "Named", ""),
        ("KELSO", None, "KELSO", "Named", "MR MR MR DR DR PROF"), ("JUSTICE", None, "JUSTICE", "Named", "MR"), ("R KELSO", "R", "KELSO", "Named", "ATTORNEY GENERAL")]
    keys = spark.createDataFrame([("CHANDRACHUD",), ("SINHA",), (None,)], "n string").select(nm.consonant_key(F.col("n")).alias("k")).collect()
    assert [r.k for r in keys] == ["KHNDRKHD", "SNH", ""]


def test_non_standard_words(spark):
    assert find("Rs. 5,000 at 50% on 12/05/2023, [NO AUDIO] 39B A.K. WP 7") == [
        ("Bracketed", "[NO AUDIO]"), ("Money", "Rs. 5,000"), ("Percentage", "50%"), ("Date", "12/05/2023"), ("LSEQ", "A.K."), ("SPLT", "39B"), ("Acronym", "WP"), ("Cardinal", "7")]
    assert find("") == [] and find("plain words") == []
    rows = [("50%", "Percentage"), ("Dr.", "Abbreviation"), ("hello", "Other"), ("39B", "SPLT"), ("Mr. Smith", "Abbreviation"), ("so the Sec.", "Abbreviation"), ("no 7 Dr.", "Cardinal"), ("", "Other"), ("...", "Other")]
    for r in spark.createDataFrame(rows, "s string, want string").withColumn("got", classify(F.col("s"), abbreviation_set())).collect():
        assert r.got == r.want


def test_lexicons_and_preparation(spark):
    table = read_abbreviations()
    assert len(table) == 20 and [len(a.short) for a in table] == sorted((len(a.short) for a in table), reverse=True)
    assert len(read_aliases()) == 7 and {"dr.", "dr"} <= abbreviation_set()
    one = spark.createDataFrame([("Yes... my Lords. Dr. A. Rao, why? 3.14",)], "t string")
    assert one.select(for_review(F.col("t"), abbreviation_set() | COMMON_ABBREVIATIONS).alias("x")).first().x == "Yes . my Lords . Dr. A. Rao why ? 3.14"  # of three dots one stays
    assert one.select(pre_clean(F.lit("‘a’  — b…²")).alias("x")).first().x == "a b"
