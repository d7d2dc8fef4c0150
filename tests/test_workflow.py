"""Selection, ledgers, parts, crawls, chapters and images on small tables, against definitions written out in Python."""

from __future__ import annotations

import hashlib
import io
import random
import zipfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusloom.functions import detectors as D
from corpusloom.functions import text as T
from corpusloom.operators import gates, ledger, pages, selection, similarity, translate
from corpusloom.sources import epub, readers, web, writers


def test_forms(spark):
    rows = [("ﬁne &amp; “dandy”  now", "Ångström Straße"), (None, None), ("plain", "PLAIN")]
    got = spark.createDataFrame(rows, "a string, b string").select(T.composed(F.col("a")).alias("a"), T.bare(F.col("b")).alias("b"), T.words(F.col("a")).alias("w")).collect()
    assert [tuple(r) for r in got] == [('fine & "dandy" now', "angstrom strasse", ["fine", "dandy", "now"]), ("", None, []), ("plain", "plain", ["plain"])]


def copied(s, t, language):
    known = set(D.function_words(language))
    for k in range(5, min(18, len(s), len(t)) + 1):
        grams = {tuple(t[i : i + k]) for i in range(len(t) - k + 1)}
        if any(tuple(s[i : i + k]) in grams and sum(w in known for w in s[i : i + k]) >= 2 for i in range(len(s) - k + 1)):
            return True
    return False


def test_source_copy_is_its_definition(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(300):
        s = rng.choices("the of and x y z q cat dog".split(), k=rng.randint(0, 24))
        a = rng.randint(0, len(s))
        t = rng.choices("il la di x y z".split(), k=rng.randint(0, 5)) + s[a : a + rng.randint(0, 12)] + rng.choices("il la di".split(), k=rng.randint(0, 5))
        rows.append((s, t))
    # a shared phrase of nine tokens whose two function words are its ends: no shorter part of it has both
    rows.append(("the a1 b1 c1 d1 e1 f1 g1 of".split(), "the a1 b1 c1 d1 e1 f1 g1 of".split()))
    got = spark.createDataFrame(rows, "s array<string>, t array<string>").select(D.source_copy(F.col("s"), F.col("t"), "en").alias("c")).collect()
    want = [copied(s, t, "en") for s, t in rows]
    assert [r["c"] for r in got] == want and any(want) and not all(want)


@pytest.mark.parametrize(
    ("source", "target", "reasons"),
    [
        ("a b c", "x y z", []),
        ("a", "", ["missing_translation"]),
        ("a", None, ["missing_translation"]),
        ("a b c d", "no no no x", ["strong_source_unmatched_repetition"]),
        ("no no no x", "no no no x", []),
        ("a", "la casa di pietra la casa di pietra", ["exact_duplicate_half", "strong_source_unmatched_repetition"]),
        ("we saw the end of the road", "we saw the end of the road", ["source_language_residue", "source_language_copy"]),
        ("uno due tre quattro cinque sei sette otto", "uno", ["severe_length_anomaly"]),
        ("a story", "un film", ["modern_intrusion"]),
        ("x", "!!!!!!", ["decoder_loop"]),
    ],
)
def test_candidate_reasons(spark, source, target, reasons):
    rows = spark.createDataFrame([(source, target)], "source string, translation string")
    assert selection.with_candidate_reasons(rows, "en").first()["reasons"] == reasons
    assert selection.candidates(rows, "en").count() == bool(reasons)


def test_repair_flags(spark):
    same = "this text is as it was before"
    rows = [(same, same, "paragraph"), (same, same, "heading"), ("x" * 100, "y" * 20, "paragraph"), ("x" * 100, "y" * 20, "heading"), ("a", " ", None), ("a", "Ж", None)]
    table = spark.createDataFrame(rows, "source string, translation string, kind string")
    flags = [r["f"] for r in table.select(selection.repair_flags(F.col("source"), F.col("translation"), F.col("kind"), "en").alias("f")).collect()]
    assert flags == [["unchanged_source_language"], [], ["length_or_repetition"], [], ["empty"], []]
    russian = [r["f"] for r in table.select(selection.repair_flags(F.col("source"), F.col("translation"), F.col("kind"), "ru").alias("f")).collect()]
    assert russian[0] == [] and russian[5] == ["source_script_spillover"]


@pytest.mark.parametrize(
    ("a", "b", "again"),
    [
        ("the old house", "the old house", True),
        ("he came back home late", "came back home late", True),  # ends the other, 14 characters or more
        ("so it goes now", "it goes now", True),  # three words in order
        ("it goes", "so then it goes", False),  # two words, and short
        ("one two three", "one x two y three", True),
        ("one two three", "three two one", False),
        ("abcdefghij", "abcdefghxy", True),  # 0.80 of up to four words
        ("abcdefghij", "abcdefgxyz", False),
        ("aa bb cc dd ee ff gg hh", "aa bb cc dd ee ff gg xx", True),  # over 0.88 of more words
        ("aa bb cc dd ee ff gg hh", "aa bb cc dd ee xx yy zz", False),
        ("", "", False),
        ("", "word", False),
    ],
)
def test_says_again(a, b, again):
    assert similarity.says_again(a, b) is again


def test_parts_are_the_fold(spark):
    rng = random.Random(3)
    rows = [(f"s{min(3, rng.randint(0, 9))}", i, rng.choice([0, 1, 5, 20, 90, 200])) for i in range(1500)] + [(None, 5000 + i, 30) for i in range(20)]
    table = spark.createDataFrame(rows, "source string, doc_id long, size long").repartition(5)
    got = {(r["source"], r["doc_id"]): r["part"] for r in gates.parts(table, "source", "doc_id", "size", 100).collect()}
    want, held, part = {}, {}, {}
    for source, doc_id, size in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        if held.get(source, 0) > 0 and held[source] + size > 100:
            part[source], held[source] = part[source] + 1, 0
        part.setdefault(source, 1)
        held[source] = held.get(source, 0) + size
        want[source, doc_id] = part[source]
    assert got == want and max(want.values()) > 50
    assert gates.parts(table.limit(0), "source", "doc_id", "size", 100).count() == 0
    assert gates.part_sizes(gates.parts(table, "source", "doc_id", "size", 100), "source", "size").agg(F.sum("files")).first()[0] == len(rows)


def test_order_without_a_group(spark):
    titles = ["w/Part 10", "w/Part 2", "w/Epilog", "w/xiv", "w/Zweite", "w/a"] * 3
    table = spark.createDataFrame([(t, i) for i, t in enumerate(titles)], "title string, n long").repartition(4)
    whole = {r["n"]: r["place"] for r in pages.in_title_order(table, ties=("n",)).collect()}
    one = {r["n"]: r["place"] for r in pages.in_title_order(table.withColumn("g", F.lit(1)), group="g", ties=("n",)).collect()}
    assert whole == one and sorted(whole.values()) == list(range(1, 19))


def test_crawl(spark):
    titles = ["r", "r/b", "r/a", "r/a/1", "r/a/2", "r/a/2/x", "r/a/2/x/y", "r/a/2/x/y/z", "q"]
    links = [("r", "r/b", 0), ("r", "r/a", 1), ("r/a", "r/a/2", 0), ("r", "r/a/1", 5), ("r/a/2", "r/a/2/x", 0), ("r/a/2/x", "r/a/2/x/y", 0), ("r/a/2/x/y", "r/a/2/x/y/z", 0), ("r", "r/gone", 7), ("r", "q", 8)]
    tables = [spark.createDataFrame([(t,) for t in titles], "title string"), spark.createDataFrame(links, "title string, target string, position int"), spark.createDataFrame([("r",), ("q",)], "root string")]
    rows = pages.crawled(*tables).orderBy("root", "place").collect()
    # a page's own links come before those of the root; what lies deeper than four isn't opened
    assert [(r["root"], r["title"], r["depth"]) for r in rows] == [("q", "q", 0), ("r", "r", 0), ("r", "r/b", 1), ("r", "r/a", 1), ("r", "r/a/2", 2), ("r", "r/a/2/x", 3), ("r", "r/a/2/x/y", 4), ("r", "r/a/1", 2)]
    assert [r["title"] for r in pages.crawled(*tables, most_pages=3).filter("root = 'r'").orderBy("place").collect()] == ["r", "r/b", "r/a"]


HTML = """<html><body><p>before</p><div class="chapter"><h2>I</h2><hr><p style="x" class="k">One <a href="#1" title="t">two</a> &amp; three</p><h3>Sub</h3><p><img src="images/pic-1.jpg"></p><p> </p></div>
<div class="chapter other"><h3>Chapter 2</h3><p>First.</p><p>Second.<br>line</p><div><img src="b.png"/></div><p>Third.</p></div><div class="chapter"><p>no heading</p></div></body></html>"""


def test_chapters_and_anchors(spark):
    docs = spark.createDataFrame([("u", HTML)], "url string, html string")
    good = spark.createDataFrame([("u", hashlib.sha256(HTML.encode()).hexdigest())], "url string, sha256 string")
    rows = pages.html_chapters(docs, good).orderBy("chapter", "ordinal").collect()
    assert [(r["chapter"], r["number"], r["ordinal"], r["role"], r["source"]) for r in rows] == [(1, "I", 0, "body", "One two & three"), (1, "I", 1, "heading", "Sub")]
    assert rows[0]["source_html"] == '<p class="k">One <a href="#1">two</a> &amp; three</p>'
    assert rows[0]["source_sha256"] == hashlib.sha256(rows[0]["source_html"].encode()).hexdigest()
    with pytest.raises(PySparkException, match="SOURCE_CHANGED"):
        pages.html_chapters(docs, good.withColumn("sha256", F.lit("0"))).collect()
    anchors = [(r["chapter"], r["asset"], r["anchor"], round(r["fraction"], 3)) for r in pages.image_anchors(docs).collect()]
    assert anchors == [(1, "pic-1", "One two & three", 0.333), (2, "b", "Second.line", 0.667)]


def test_epub_images(spark):
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (200).to_bytes(4) + (300).to_bytes(4) + b"x" * 2000
    small = png[:16] + (100).to_bytes(4) + png[20:]
    package = '<package xmlns="o"><manifest>' + "".join(f'<item href="{h}" media-type="{m}" properties="{p}"/>' for h, m, p in [("a.png", "image/png", ""), ("Cover.png", "image/png", ""), ("c.png", "image/png", "cover-image"), ("s.png", "image/png", ""), ("t.png", "image/png", ""), ("x.html", "text/html", ""), ("../b.PNG", "image/png", ""), ("gone.png", "image/png", "")]) + "</manifest></package>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("META-INF/container.xml", '<c xmlns="n"><rootfiles><rootfile full-path="O/p.opf"/></rootfiles></c>')
        z.writestr("O/p.opf", package)
        for name, data in [("O/a.png", png), ("O/Cover.png", png), ("O/c.png", png), ("O/s.png", small), ("O/t.png", png[:600]), ("b.PNG", png)]:
            z.writestr(name, data)
    plain = io.BytesIO()
    with zipfile.ZipFile(plain, "w") as z:
        z.writestr("a", "b")
    files = spark.createDataFrame([("one", bytearray(out.getvalue())), ("two", bytearray(plain.getvalue()))], "asset string, content binary")
    rows = epub.images(files).orderBy("place").collect()
    assert [(r["asset"], r["name"], r["member"], r["width"], r["height"]) for r in rows] == [("one", "historical-001.png", "O/a.png", 200, 300), ("one", "historical-002.png", "b.PNG", 200, 300)]
    assert rows[0]["sha256"] == hashlib.sha256(png).hexdigest()


def test_corrections_and_overrides(spark, tmp_path):
    (tmp_path / "over.json").write_text('{"overrides": [{"rank": 3, "unit_id": "u1", "source_sha256": "h", "translation": "t"}, {"rank": 4, "unit_id": "u1"}]}')
    assert [(r["rank"], r["unit_id"]) for r in readers.overrides(spark, f"{tmp_path}/over.json").collect()] == [(3, "u1"), (4, "u1")]
    assert readers.overrides(spark, f"{tmp_path}/over.json", 3).first()["translation"] == "t"
    for n, (rank, unit) in enumerate([(7, "a"), (7, "a"), (7, "b")]):
        rows = spark.createDataFrame([(rank, unit, "h", f"t{n}", "s")], "rank int, unit_id string, source_sha256 string, translation string, translation_sha256 string")
        writers.correction_files(rows, f"{tmp_path}/in/{n}", f"corrections-{n}")
    found = readers.corrections(spark, f"{tmp_path}/in")
    assert found.count() == 3
    assert {(r["unit_id"], r["translation"]) for r in ledger.last_corrections(found).collect()} == {("a", "t1"), ("b", "t2")}
    assert {(r["unit_id"], r["clash"], len(r["files"])) for r in ledger.merged_corrections(found).collect()} == {("a", True, 2), ("b", False, 1)}


def test_shards_of_ledgers(spark, tmp_path):
    line = '{"unit_id": "%s", "source": "s", "translation": "%s", "source_sha256": "h", "translation_sha256": "%s"}\n'
    (tmp_path / "x").mkdir()
    (tmp_path / "x/043_shard_0000_alignment.jsonl").write_text(line % ("a", "t", "1") + line % ("b", "t", "1"))
    (tmp_path / "043_shard_0001_alignment.jsonl").write_text(line % ("b", "u", "2") + line % ("a", "t", "1"))
    (tmp_path / "043_alignment.jsonl").write_text(line % ("a", "other", "9"))
    rows, clashes = readers.shard_alignments(spark, str(tmp_path))
    assert sorted((r["unit_id"], r["translation"]) for r in rows.collect()) == [("a", "t"), ("b", "t"), ("b", "u")]
    assert [(r["rank"], r["unit_id"]) for r in clashes.collect()] == [(43, "b")]
    bundles, expected = spark.createDataFrame([("p", 3), ("q", 4)], "path string, rank int"), spark.createDataFrame([("p", 3), ("q", 5)], "path string, rank int")
    assert [tuple(r) for r in readers.rank_violations(bundles, expected).collect()] == [("q", 4)]


def test_jobs_and_retries(spark):
    configs = spark.createDataFrame([(1, "A B", "c1"), (2, "C", "c2"), (3, "D", "c3")], "rank int, slug string, path string")
    plans = spark.createDataFrame([(1, 2, "p2"), (1, 9, "p3"), (3, 1, "p")], "rank int, shard_count int, path string")
    bundles = spark.createDataFrame([(1, "b2"), (1, "b1"), (2, "b")], "rank int, path string")
    assert [tuple(r) for r in ledger.prepared_jobs(configs, plans, bundles).orderBy("shard").collect()] == [("001", "c1", "a-b", "b1", 0, "0000"), ("001", "c1", "a-b", "b1", 1, "0001")]
    assert {tuple(r) for r in ledger.unprepared(configs, plans, bundles).collect()} == {(2, "no_plan"), (3, "no_bundle")}
    old = spark.createDataFrame([("u", "RECOVERED", "1"), ("v", "FAILED", None), ("w", "FAILED", None), ("x", "FAILED", None)], "url string, status string, sha256 string")
    new = spark.createDataFrame([("u", "FAILED", None), ("v", "RECOVERED", "2"), ("w", "FAILED", None)], "url string, status string, sha256 string")
    assert {tuple(r) for r in ledger.retried(old, new).collect()} == {("u", "RECOVERED", "1"), ("v", "RECOVERED", "2"), ("w", "FAILED", None), ("x", "FAILED", None)}


def test_first_blocks_go_from_the_first_page_only(spark):
    rows = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["d", "e"])], "place int, blocks array<string>")
    assert [r["blocks"] for r in pages.without_first_blocks(rows, 2).orderBy("place").collect()] == [["c"], ["d", "e"]]
    assert pages.without_first_blocks(rows, 9).orderBy("place").first()["blocks"] == []


def test_no_folder_of_its_own_on_a_cluster(monkeypatch):
    from corpusloom.operators import lineage

    class Context:
        master = "local-cluster[2,1,1024]"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        lineage.shared_folder(Session())


def test_recovery_with_a_fallback(spark):
    rows = [("http://x/1", None), ("http://x/missing", "http://x/2"), ("http://x/missing", None), (None, None)]
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "rank int, url string, other string")
    got = web.recovered(table, "tests.stub_fetch:recovery", fallback="other", tries=1).orderBy("rank").collect()
    assert [(r["status"], r["found_at"], r["error"] is None) for r in got] == [("RECOVERED", "http://x/1", True), ("RECOVERED", "http://x/2", False), ("FAILED", None, False), ("FAILED", None, True)]
    assert got[0]["sha256"] == hashlib.sha256(b"page http://x/1").hexdigest()


def test_listing_until_a_short_page(spark):
    spark.dataSource.register(web.Listing)
    rows = spark.read.format("corpusloom_listing").option("url", "p{page}").option("fetch", "tests.stub_fetch:short_last").option("until_shorter_than", 3).load()
    assert sorted((r["page"], r["place"], r["item"]) for r in rows.collect()) == [(1, 0, "10"), (1, 1, "11"), (1, 2, "12"), (2, 0, "20"), (2, 1, "21"), (2, 2, "22"), (3, 0, "30")]


def test_batches_and_limits(spark):
    assert list(translate.batches(["a", "b", "c"], 2)) == [["a", "b"], ["c"]]
    assert list(translate.batches(["aaaa", "é", "bbb", "cccccccc"], 9, 5)) == [["aaaa"], ["é", "bbb"], ["cccccccc"]]
    limits = spark.createDataFrame([(1,), (60,), (500,)], "n int").select(translate.decode_limit(F.col("n")).alias("m"))
    assert [r["m"] for r in limits.collect()] == [96, 120, 384]
    units = spark.createDataFrame([(1, "One. Two. " * 20, "Uno."), (2, "Short", "Corto")], "id int, source string, translation string")
    got = translate.repaired_risky(units, ["id"], [translate.by_runtime("tests.stub_fetch:upper")]).orderBy("id").collect()
    assert [(r["repaired"], r["translation"][:9]) for r in got] == [(True, "ONE. TWO."), (False, "Corto")]


def test_archives_of_parts(spark):
    files = spark.createDataFrame([("A b", i, f"f{i}.txt", bytearray(b"x" * 40)) for i in range(5)], "source string, n int, name string, content binary").withColumn("size", F.length("content"))
    numbers = gates.parts(files, "source", "n", "size", 100).select("source", "n", "part")
    rows = gates.archives(files.join(numbers, ["source", "n"]), "source").orderBy("part").collect()
    assert [(r["asset"], r["files"]) for r in rows] == [("a-b-part-01.zip", 2), ("a-b-part-02.zip", 2), ("a-b-part-03.zip", 1)]
    with zipfile.ZipFile(io.BytesIO(bytes(rows[1]["content"]))) as z:
        assert z.namelist() == ["f2.txt", "f3.txt"] and z.read("f2.txt") == b"x" * 40
    assert rows[0]["sha256"] == hashlib.sha256(bytes(rows[0]["content"])).hexdigest()
    short = spark.range(1).select(gates.truncated_map(F.create_map(F.lit("b"), F.lit(1), F.lit("a"), F.lit(2), F.lit("c"), F.lit(3)), 2).alias("m")).first()["m"]
    assert short == {"a": 2, "b": 1}


def test_page_counts(spark):
    rows = spark.createDataFrame([(1, ["ab", "c"]), (2, [])], "place int, blocks array<string>")
    assert [(r["n_blocks"], r["n_chars"]) for r in pages.page_counts(rows).orderBy("place").collect()] == [(2, 3), (0, 0)]
