"""Turns, ranks, speakers, review, streaming, sources and sinks against small brute-force results."""

import difflib
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from stenoloom.functions.spoken import spoken_form
from stenoloom.operators import frequency as fq
from stenoloom.operators import speakers as sp
from stenoloom.operators import turns as tn
from stenoloom.operators.order import running_total, with_rank
from stenoloom.operators.parts import spoken_parts, spoken_texts
from stenoloom.operators.review import diffs, review_rows, review_sheet, review_summary
from stenoloom.operators.skew import lookup_join
from stenoloom.plans import jobs
from stenoloom.sources.transcripts import read_text_lines, summary_text, text_turns, write_turns, write_workbook
from stenoloom.streaming import line_statistics

LINES = "file_idx int, page_idx int, line_no int, line string, loaded_at timestamp, turn_idx string"
SCRIPT = ["lost words", "MR. KELSO: good morning", "  ", "12", "10:30 AM IST", "and thanks", "COURT MASTER:", "END OF DAY'S PROCEEDINGS", "MR. KELSO:", "x@y.zz", "bye"]


def _lines(spark, repeat=1):
    rows = [(1, k // 3 + 1, k % 3 + 1, x, None, "clash") for k, x in enumerate(SCRIPT)] * repeat
    return spark.createDataFrame([*rows, (2, 1, 1, None, None, None), (None, 1, 1, "A: b", None, None)], LINES)


def test_turns(spark):
    got = [tuple(r) for r in tn.turns(_lines(spark, 2)).orderBy("turn_idx").collect()]
    assert got == [(1, 1, "MR. KELSO", "good morning and thanks"), (1, 2, "COURT MASTER", ""), (1, 3, "MR. KELSO", "bye")]
    noise = {(r.kind, r.n) for r in tn.noise_counts(_lines(spark)).collect()}
    assert noise == {("line_number", 1), ("timestamp", 1), ("email", 1)}
    assert tn.turns(_lines(spark).limit(0)).count() == 0
    seg = {r.speaker: (r.words, r.shortest, r.longest) for r in tn.segment_range(tn.turns(_lines(spark))).collect()}
    assert seg == {"MR. KELSO": (5, 1, 4)}


def test_ranks_and_running_totals(spark):
    rnd = random.Random(1)
    rows = [(rnd.randrange(3), rnd.randrange(900), k, rnd.randrange(5)) for k in range(2000)]
    df = spark.createDataFrame(rows, "g int, p int, l int, v int").repartition(7)
    got = {(r.g, r.p, r.l): r.t for r in running_total(df, "g", "p", "l", F.col("v"), "t").collect()}
    for g in range(3):
        total = 0
        for _, p, k, v in sorted(r for r in rows if r[0] == g):
            total += v
            assert got[g, p, k] == total
    ranks = with_rank(df, F.desc("v"), F.asc("l")).orderBy("rank").select("rank", "v", "l").collect()
    assert [(r.v, r.l) for r in ranks] == [(v, k) for _, _, k, v in sorted(rows, key=lambda r: (-r[3], r[2]))]
    assert [r.rank for r in ranks] == list(range(1, 2001))


def test_lookup_join_with_heavy_key(spark):
    facts = spark.range(3000).select((F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))).alias("k"), "id").unionByName(
        spark.createDataFrame([(None, -1)], "k bigint, id bigint"))
    dim = spark.range(0, 2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    plain = {tuple(r) for r in facts.join(dim, "k", "left").collect()}
    assert {tuple(r) for r in lookup_join(facts, dim, "k", share=20, small=10).select("k", "id", "x").collect()} == plain


def test_frequencies(spark):
    t = spark.createDataFrame([("The the, end.",), (None,), ("",)], "t string")
    assert [tuple(r) for r in fq.counted(fq.stripped_words(t, "t"), "word").orderBy("rank").collect()] == [("the", 2, 1), ("end", 1, 2)]
    assert fq.counted(fq.characters(t, "t"), "ch", 3).count() == 9
    cats = {r.category: r.occurrences for r in fq.category_counts(fq.nsw_frequency(spark.createDataFrame([("50% of 7",)], "t string"), "t")).collect()}
    assert cats["Percentage"] == 1 and cats["Cardinal"] == 1 and cats["Email"] == 0 and len(cats) == 15


NAMES = [
    ("JUSTICE D.Y. MARLOWE", 50, 1), ("CHIEF JUSTICE DY MARLOWE", 60, 2), ("MR. RAVEN KELSO", 40, 3), ("RAVEN KELSO", 5, 4), ("MS. NORA TALVIN", 30, 5),
    ("MS. NORA TALVEN", 31, 6), ("MR. IVAN VOSTER", 20, 7), ("MR. IVAN WOSTER", 20, 8), ("MR. LEO RAO", 9, 9), ("MR. LEO RAI", 8, 10), ("MR. KELSO", 3, 11),
    ("MR. UNSEEN", 2, 12), ("COURT MASTER", 70, 13), ("ATTORNEY GENERAL", 1, 14)]


def test_speaker_clusters(spark):
    c = sp.clusters(spark.createDataFrame(NAMES, "name string, words bigint, name_ord bigint"))
    got = {}
    for r in c.collect():
        got.setdefault(r.group_ord, set()).add(r.name)
    assert {frozenset(v) for v in got.values()} == {
        frozenset(x) for x in [{"JUSTICE D.Y. MARLOWE", "CHIEF JUSTICE DY MARLOWE"}, {"MR. RAVEN KELSO", "RAVEN KELSO", "MR. KELSO"}, {"MS. NORA TALVIN", "MS. NORA TALVEN"},
                               {"MR. IVAN VOSTER"}, {"MR. IVAN WOSTER"}, {"MR. LEO RAO", "MR. LEO RAI"}, {"MR. UNSEEN"}, {"COURT MASTER"}, {"ATTORNEY GENERAL"}]}
    ids = {r.name: (r.canonical, r.spk_id) for r in sp.speaker_ids(c).collect()}
    assert ids["JUSTICE D.Y. MARLOWE"] == ("CHIEF JUSTICE DY MARLOWE", "spk_1001") and ids["COURT MASTER"][1] == "spk_0002"
    assert ids["MR. IVAN VOSTER"][1] < ids["MR. IVAN WOSTER"][1]


def test_clusters_by_brute_force(spark):
    rnd = random.Random(8)
    stems, firsts = ["KELSO", "KALSO", "KELSON", "TALVIN", "TALVEN", "TARVIN", "BORVAK", "RAO", "RAI", "KLS", "KELSTROVIN", "KELSTRVN", "TALVINATH"], ["RAVEN", "R", "ROVEN", "NORA", "NURA", "N", None]
    names = sorted({" ".join(x for x in (rnd.choice(["MR.", "DR.", ""]), rnd.choice(firsts), rnd.choice(stems)) if x) for _ in range(90)})
    rnd.shuffle(names)
    parsed = {r.name: r for r in sp.parsed_names(spark.createDataFrame([(n, 1, k) for k, n in enumerate(names, 1)], "name string, words bigint, name_ord bigint")).collect()}
    like = lambda a, b, t: len(a) >= 3 and len(b) >= 3 and difflib.SequenceMatcher(None, a, b).ratio() >= t

    def surname(x, y):
        return x.surname == y.surname or x.surname[0] == y.surname[0] and (x.surname_key == y.surname_key or like(x.surname_key, y.surname_key, 0.8))

    def first(x, y):
        a, b = x.first, y.first
        return a == b or a[0] == b[0] and (len(a) <= 2 and b.startswith(a) or len(b) <= 2 and a.startswith(b) or x.first_key != "" and x.first_key == y.first_key or like(x.first_key, y.first_key, 0.75))

    rows = sorted(parsed.values(), key=lambda r: r.name_ord)
    regular = [r for r in rows if r.kind == "regular"]
    group = {r.name_ord: r.name_ord for r in regular}
    for i, x in enumerate(regular):
        for y in regular[i + 1 :]:
            if surname(x, y) and first(x, y):
                old, new = max(group[x.name_ord], group[y.name_ord]), min(group[x.name_ord], group[y.name_ord])
                group = {k: new if g == old else g for k, g in group.items()}
    members = {}
    for r in regular:
        members.setdefault(group[r.name_ord], []).append(r)
    for r in rows:
        if r.kind == "wildcard":
            hit = [g for g, held in members.items() if any(surname(r, y) for y in held)]
            group[r.name_ord] = hit[0] if len(hit) == 1 else r.name_ord
            if len(hit) == 1:
                members[hit[0]].append(r)
    got = {r.name_ord: r.group_ord for r in sp.clusters(spark.createDataFrame([(n, 1, k) for k, n in enumerate(names, 1)], "name string, words bigint, name_ord bigint")).collect()}
    assert got == group and len(set(group.values())) < len(names)


def test_review(spark):
    w, s = "We paid 50% to Dr. Rao? yes".split(), "we paid fifty percent to doctor rao ? yes".split()
    df = spark.createDataFrame([(1, 1, " ".join(w), " ".join(s)), (1, 2, "", "")], "file_idx int, turn_idx int, written string, spoken string")
    rows = review_rows(df, ["file_idx", "turn_idx"])
    assert {(r.category, r.span, r.before, r.after) for r in rows.collect()} == {("Percentage", "50%", "We paid", "to Dr. Rao? yes"), ("Abbreviation", "Dr.", "We paid 50% to", "Rao? yes")}
    total = {r.category: r.changes for r in review_summary(rows).collect()}
    assert total["TOTAL"] == 2 and total["Email"] == 0 and len(total) == 17
    more = spark.createDataFrame([(3, 4, "MR. KELSO", "We met the Sec. Rao now", "we met rao now")], "file_idx int, turn_idx int, raw_name string, written string, spoken string")
    sheet = review_sheet(review_rows(more, ["file_idx", "turn_idx", "raw_name"]), "Abbreviation").collect()
    assert [tuple(r)[3:] for r in sheet] == [("the Sec.", "(empty)", "We met the Sec. Rao now", "we met rao now", "MR. KELSO T4")]


def test_diffs_by_brute_force(spark):
    rnd = random.Random(4)
    data = []
    for k in range(60):
        w = [rnd.choice(["a", "B", "c?!", "d", "??", "e!"]) for _ in range(rnd.randrange(30))]
        data.append((k, " ".join(w), " ".join(rnd.choice(["a", "b", "c", "?!", "d", "??", "e", "!"]) for _ in range(rnd.randrange(30)))))
    got = {}
    for r in diffs(spark.createDataFrame(data * 2, "k int, written string, spoken string"), ["k"]).collect():
        got.setdefault(r.k, []).append((r.i1, r.i2, r.j1, r.j2))
    for k, w, s in data:
        flat = [(piece, i) for i, t in enumerate(w.split()) for piece in ((t[:-len(t.lstrip("abcdeB")) or None], t.lstrip("abcdeB")) if t[0].isalpha() else (t[0], t[1:])) if piece]
        want = []
        for op, a, z, j1, j2 in difflib.SequenceMatcher(None, [p.lower() for p, _ in flat], s.split(), autojunk=False).get_opcodes():
            if op != "equal":
                i1 = flat[a][1] if a < len(flat) else len(w.split())
                i2 = flat[z - 1][1] + 1 if z > a else i1
                if i2 - i1 <= 12:
                    want.append((i1, i2, j1, j2))
        assert sorted(got.get(k, [])) == sorted(want * 2), (w, s)


def test_resolve_and_aliases(spark):
    rows = spark.createDataFrame([("A", 1)] * 30 + [("B", 2), ("C", 3), ("D", 4), (None, 5)], "raw_name string, _use int")
    ids = spark.createDataFrame([("X", "s1"), ("B", "s2"), ("C", "s3"), ("C", "s0"), (None, "s9")], "name string, spk_id string")
    got = {(r.raw_name, r.spk_id, r.mapped) for r in sp.resolve(rows.withColumnRenamed("_use", "words"), "raw_name", ids, {"A": "X", "B": "Y", "D": "Z"}).collect()}
    assert got == {("A", "s1", True), ("B", "s2", True), ("C", "s0", True), ("D", "Z", False), (None, None, False)}
    from stenoloom.sources.lexicon import read_aliases

    held = read_aliases()
    names = spark.createDataFrame([(k,) for k in held] + [("OTHER",)], "n string")
    assert {r.n for r in sp.with_alias(names, "n").collect()} == {*held.values(), "OTHER"}
    table = spark.createDataFrame([("A", "X"), ("A", "W"), ("B", None)], "raw string, use string")
    assert {r.raw_name for r in sp.with_alias(rows, "raw_name", table).collect()} == {"W", "B", "C", "D", None}


def test_shared_folder(spark):
    from types import SimpleNamespace

    from stenoloom.operators.order import spread
    from stenoloom.plans.durable import shared_dir

    far = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="far", master="spark://host:7077", getConf=lambda: {}, getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(far)
    tracker, before = spark.sparkContext.statusTracker(), shared_dir(spark)
    assert shared_dir(spark) == before and "/run-" in before
    df = spark.range(10, numPartitions=1)
    spark.sparkContext.setJobGroup("spread", "")
    wide = [spread(df), spread(df.distinct()), spread(spark.range(10, numPartitions=9))]
    assert not tracker.getJobIdsForGroup("spread")  # the plan is looked at, nothing is run
    assert [x.rdd.getNumPartitions() for x in wide] == [4, 4, 9]


def test_modes_and_files(spark, tmp_path):
    turns = jobs.extract(_lines(spark))["turns"]
    norm = jobs.normalise(turns, spark.createDataFrame([("MR. KELSO", "spk_1001")], "name string, spk_id string"))
    assert {(r.spk_id, r.body) for r in norm["v3"].collect()} == {("spk_1001", "good morning and thanks"), ("spk_1001", "bye")}
    assert jobs.align(turns, norm["v3"])["changes"].count() == 0
    assert {r["total"] for r in jobs.content_stats(turns)["overview"].collect()} == {1}
    assert jobs.dedup_names(turns)["speakers"].first().canonical == "MR. KELSO"
    write_turns(turns, str(tmp_path / "t"))
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/transcript_007.txt").write_text("MR. KELSO:\ngood morning\nand thanks\n\nCOURT MASTER:\n\n")
    lines = read_text_lines(spark, str(tmp_path / "raw"))
    assert [tuple(r) for r in text_turns(lines).orderBy("turn_idx").collect()] == [(7, 1, "MR. KELSO", "good morning and thanks"), (7, 2, "COURT MASTER", "")]
    assert text_turns(lines, keep_empty=False).count() == 1
    write_workbook(str(tmp_path / "x.xlsx"), {"Turns": turns.select("turn_idx", "body")})
    assert "good morning" in zipfile.ZipFile(tmp_path / "x.xlsx").read("xl/worksheets/sheet1.xml").decode()


def test_stream_equals_batch(spark, tmp_path):
    rows = _lines(spark).where("line is not null").withColumn("loaded_at", F.timestamp_seconds(F.lit(1.7e9) + F.col("line_no") * 50000))
    rows.write.parquet(str(tmp_path / "in"))
    batch = {tuple(r) for r in line_statistics(spark.read.parquet(str(tmp_path / "in"))).collect()}
    stream = line_statistics(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("lines_out").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert {tuple(r) for r in spark.table("lines_out").collect()} == batch and batch


def test_entry_without_llm():
    import __spark_entry__ as e

    assert len(e.queries()) > 40 and set(e.oracle_sql()) <= set(e.queries())


def test_spoken_items_speaks_each_part_once(spark, tmp_path):
    import __spark_entry__ as e

    odd = [0.0, 7.99, 100.0, 1900.5, 2000.0, 9999.99, 10000.0, 104949.5, 1234567.0, 1e15, 1e17, -5.0, None]
    days = ["1995-01-02 00:00:00", "1995-01-02 00:00:59", "1960-12-31 23:59:00", "2000-02-29 09:05:30", "1900-10-10 12:00:00", None]
    rows = [(p, n % 11 / 100 if n % 13 else None, n % 9999 if n % 17 else None, t) for n, (p, t) in enumerate([(p, t) for p in odd for t in days] * 2)] * 2
    items = spark.createDataFrame(rows, "l_extendedprice double, l_discount double, l_linenumber int, t string").withColumn("l_shipdate", F.col("t").cast("timestamp"))
    items.write.parquet(str(tmp_path / "lineitem.parquet"))
    out = e.queries()["spoken_items"](spark, str(tmp_path))
    # rows differ by the four values, as in the SQL, also where a value is null or a time has seconds
    found = [tuple(r) for r in out.collect()]
    assert len(found) == items.selectExpr("floor(l_extendedprice)", "round(l_discount * 100)", "l_linenumber", "l_shipdate").distinct().count()
    texts = [w for w, _ in found if w is not None]
    whole = {tuple(r) for r in spark.createDataFrame([(w,) for w in texts], "w string").select("w", spoken_form(F.col("w"))).collect()}
    assert {x for x in found if x[0]} == whole and all(s is None for w, s in found if w is None)
    assert len(set(texts)) > 80
    # what is said comes from a table of the parts: nothing is spoken text by text
    assert "regexp" not in out._jdf.queryExecution().optimizedPlan().toString().lower()


def test_spoken_texts_by_shuffle_and_of_nothing(spark):
    parts = {"a": lambda n: F.concat(F.lit("No "), n.cast("string"), F.lit(" and")), "b": lambda n: F.when(n == 0, "-").otherwise(F.concat(n.cast("string"), F.lit("%")))}
    rows = spark.createDataFrame([(n % 30, n % 7) for n in range(600)] + [(None, 1), (2, None)], "a bigint, b bigint")
    assert spoken_parts(rows, parts).groupBy("part").count().orderBy("part").collect() == [("a", 30), ("b", 7)]
    near, far = ([tuple(r) for r in spoken_texts(rows, rows, parts, small).collect()] for small in (100, 5))
    assert sorted(near, key=str) == sorted(far, key=str) and len(near) == 602 and near.count((None, None)) == 2
    assert set(near) >= {("No 21 and 3%", "no twenty one and three percent"), ("No 14 and -", "no fourteen and")}
    assert spoken_texts(rows.limit(0), rows.limit(0), parts).collect() == []


def test_summary_text(spark):
    fonts = spark.createDataFrame([([f"F{k:02d} (9pt)" for k in range(25)],)], "fonts array<string>")
    text = summary_text(jobs.summary(_lines(spark)), fonts)
    assert "raw speakers  2" in text and "files         1" in text and "email         1" in text and "total         3" in text and "... and 5 more" in text
    assert "words         " in summary_text(jobs.summary(_lines(spark).limit(0)))


def test_entry_query(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["word", "frequency", "rank"]
