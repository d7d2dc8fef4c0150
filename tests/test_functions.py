"""Cases on both sides of the thresholds, by plain Python restatements where there are many."""

from __future__ import annotations

import difflib

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import detectors as D
from corpusloom.functions import packing as P
from corpusloom.functions import text as T
from corpusloom.operators import gates, ledger, pages, similarity


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first()["x"]


def over(spark, column, rows, schema="source string, translation string"):
    return [r["x"] for r in spark.createDataFrame(rows, schema).select(column.alias("x")).collect()]


S, T_ = F.col("source"), F.col("translation")


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Mr. Fox ran. He said “Go!” Then J. Smith left.", ["Mr. Fox ran.", "He said “Go!”", "Then J. Smith left."]),
        ("See e.g. The end", ["See e.g.", "The end"]),
        ("U.S. The law", ["U.S. The law"]),
        ("No. Never", ["No. Never"]),
        ("Ждал он. Потом ушёл.", ["Ждал он.", "Потом ушёл."]),
        ("  ", []),
        ("Wait… What?", ["Wait…", "What?"]),
        ("Dr.. Who", ["Dr..", "Who"]),
    ],
)
def test_sentences(spark, text, expected):
    assert one(spark, T.sentences(F.col("t")), t=text) == expected


def test_normal_forms(spark):
    assert one(spark, T.normalized(F.col("t")), t="Straße, σοφος ΣΟΦΟΣ!") == "strasse σοφοσ σοφοσ"
    assert one(spark, T.tokens(F.col("t")), t="L’uomo d'oro — Ёж 12") == ["l'uomo", "d'oro", "ёж", "12"]
    assert one(spark, T.padded(F.col("t"), 3), t=12345) == "12345"
    assert one(spark, T.unit_id(F.lit(3), F.lit(7)), t="") == "c03-u0007"
    assert one(spark, T.slug(F.col("t")), t=" A b, C!") == "a-b-c"
    assert one(spark, T.spaced(F.col("t")), t="Ecco.Poi  via") == "Ecco. Poi via"
    assert one(spark, T.quoted(F.col("t")), t="a b/é") == "a%20b/%C3%A9"
    assert [one(spark, T.roman_value(F.col("t")), t=x) for x in ("xiv", "MCMXC", "iq")] == [14, 1990, None]
    assert one(spark, T.paragraph_html(F.lit("paragraph"), F.col("t")), t="a<b\nc") == "<p>a&lt;b<br/>c</p>"


def test_risks(spark):
    rows = [("x" * 89, "y"), ("x" * 100, "y" * 61), ("x" * 100, "y" * 62), ("x" * 100, "y" * 176), (None, None)]
    assert over(spark, D.omission(S, T_), rows) == [False, True, False, False, False]
    assert over(spark, D.repetition(S, T_), rows) == [False, False, False, True, False]
    long = "This sentence is surely longer than that."
    assert over(spark, D.adjacent_repeat(T_), [("", f"{long} {long}"), ("", "Short one. Short one."), ("", "")]) == [True, False, False]
    half = "the quick brown fox jumps over the lazy dog again and again"
    assert over(spark, D.halves_repeat(T_), [("", half + half), ("", half)]) == [True, False]


def test_hard_flags(spark):
    rows = [("x" * 90, "y" * 26), ("x" * 90, "y" * 27), ("x" * 90, ""), ("a", "Привет")]
    assert over(spark, D.hard_flags_repair(S, T_, "ru"), rows) == [["severe_length_anomaly"], [], ["empty", "severe_length_anomaly"], ["source_script_spillover"]]
    rows = [("a" * 20, "b" * 3), ("a" * 20, "1234567" + "b" * 3), ("a" * 20, "b" * 49), ("a" * 19, "b" * 99), ("", "no no no"), ("", "ma ba dada dada dada dada dada")]
    assert over(spark, D.hard_flags_targeted(S, T_), rows) == [["severe_underlength"], ["long_digit_run"], ["severe_overlength"], [], [], ["decoder_repetition"]]


def test_token_detectors(spark):
    t = T.tokens(F.col("translation"))
    s = T.tokens(F.col("source"))
    assert over(spark, D.duplicate_half(s, t), [("a b", "c d c d"), ("a b a b", "c d c d"), ("", "c c")]) == [True, False, False]
    assert over(spark, D.source_residue(T_, t, "en"), [("", "the of and with"), ("", "the of and di"), ("", "Ж")]) == [True, False, True]
    assert over(spark, D.decoder_loop(T_), [("", "!!!!!!"), ("", "!!!!!"), ("", "lalalala"), ("", "so so so so"), ("", "so so so")]) == [True, False, True, True, False]
    assert over(spark, D.modern_intrusion(S, T_), [("", "un film"), ("a film", "un film"), ("", "filmato")]) == [True, False, False]
    assert over(spark, D.post_failures(S, T_, "en"), [("one two three four five six seven eight", "uno"), ("a", "")]) == [["severe_length_anomaly"], ["empty_target"]]


def test_packing(spark):
    text = "Alpha beta gamma; delta epsilon, zeta eta theta. Iota kappa."
    for column in (P.bounded_segments(F.col("t"), 12), P.source_segments(F.col("t"), 12), P.source_segments_by_word(F.col("t"), 12), P.split_long_block(F.col("t"), 20), P.atomic_segments(F.col("t"), 12, 10)):
        parts = one(spark, column, t=text)
        assert "".join(parts).replace(" ", "") == text.replace(" ", "")
    assert one(spark, P.source_segments(F.col("t"), 12), t="aa bb cccc dd. ee") == ["aa bb cccc", "dd. ee"]
    assert one(spark, P.bins(F.array(*[F.lit(x).cast("long") for x in (5, 5, 5, 12, 1)]), 10)) == [1, 1, 2, 3, 4]


def test_similarity(spark):
    a, b = "the quick brown fox jumps", "the quick brown fox jumped"
    got = over(spark, similarity.unchanged_similarity(S, T_, F.lit("paragraph")), [(a, b), ("short", "short")])
    assert got == [pytest.approx(difflib.SequenceMatcher(None, a, b).ratio()), 0.0]
    s1 = "this is a rather long sentence about nothing"
    assert over(spark, similarity.repeated_span(T_), [("", f"{s1.capitalize()}. {s1.capitalize()}s."), ("", s1)]) == [True, False]
    r = over(spark, similarity.repeated_adjacent(T.tokens(T_)), [("", "a b c a b c d"), ("", "no no no"), ("", "no no"), (None, None)])
    assert [(x["size"], x["count"], x["score"], x["phrase"]) for x in r] == [(3, 2, 6, "a b c"), (1, 3, 3, "no"), (0, 0, 0, None), (0, 0, 0, None)]
    assert over(spark, similarity.collapsed(S, T_), [("One.", "Uno. Uno."), ("One. Two.", "Uno. Uno.")]) == ["Uno.", "Uno. Uno."]


def test_char_grams(spark):
    assert similarity.word_grams("ab") == [" ab", "ab ", " ab "] and similarity.word_grams("c") == [" c "]
    table = spark.createDataFrame([(1, "x", "ab c\tAB"), (1, "y", None), (2, "x", "")], "g int, k string, t string")
    rows = similarity.gram_counts(table, ["g", "k"], "t").collect()
    assert sorted(map(tuple, rows)) == [(1, "x", " ab", 2), (1, "x", " ab ", 2), (1, "x", " c ", 1), (1, "x", "ab ", 2)]


def test_ledger(spark):
    units = spark.createDataFrame([(1, "a", "x", "h1", "t1"), (1, "b", "y", "h2", "t2")], "rank int, unit_id string, source string, source_sha256 string, translation string")
    fixes = spark.createDataFrame([(1, "a", "h1", "new"), (1, "b", "old", "no")], "rank int, unit_id string, source_sha256 string, translation string")
    once = ledger.overlaid(units, fixes)
    assert {(r.unit_id, r.translation, r.corrected) for r in once.collect()} == {("a", "new", True), ("b", "t2", False)}
    again = ledger.overlaid(once.drop("corrected"), fixes)
    assert sorted(again.collect()) == sorted(once.collect())
    assert {(r.unit_id, r.violation) for r in ledger.override_violations(units, fixes).collect()} == {("b", "source_changed")}
    groups = ledger.marker_groups(spark.createDataFrame([(1, i, m) for i, m in enumerate("xMxxMx")], "g int, i int, m string"), F.col("m") == "M", ["g"], [F.col("i")])
    assert [r.grp for r in groups.orderBy("i").collect()] == [1, 1, 1, 1, 2, 2]


def test_pages(spark):
    html = "<div class='mw-parser-output'><div class='noprint'><p>No</p></div><h2>XII.</h2><p>A <b>fine</b> day<sup class='reference'>1</sup>.</p><p>A <b>fine</b> day.</p><div class='poem'><p>One</p><p>Two</p></div></div><p>Out</p>"
    assert one(spark, pages.clean_blocks(F.col("t")), t=html) == ["A fine day .", "A fine day.", "One\nTwo"]
    titles = spark.createDataFrame([(x,) for x in ("W", "W/Part Zweite", "W/10", "W/iv", "W/notes", "W/10/a")], "title string")
    placed = [r.title for r in pages.in_title_order(titles.filter("title <> 'W/10/a'")).orderBy("place").collect()]
    assert placed == ["W/Part Zweite", "W/iv", "W/10", "W/notes", "W"]
    assert {r.title for r in pages.terminals(titles).collect()} == {"W/Part Zweite", "W/iv", "W/notes", "W/10/a"}
    assert {r.title for r in pages.children(titles, titles.filter("title = 'W'")).collect()} == {"W/Part Zweite", "W/iv", "W/notes", "W/10"}


def test_gates(spark):
    claims = spark.createDataFrame([("z", "a", "1"), ("z", "b", "2"), ("z", "c", "3")], "asset string, path string, sha256 string")
    members = spark.createDataFrame([("z", "a", "1"), ("z", "b", "9")], "asset string, path string, sha256 string")
    assert {(r.path, r.violation) for r in gates.evidence_violations(claims, members).collect()} == {("b", "changed"), ("c", "absent")}
    files = spark.createDataFrame([("x", i, s) for i, s in enumerate([6, 5, 4, 11])], "g string, i int, s long")
    assert [(r.i, r.part) for r in gates.parts(files, "g", "i", "s", 10).orderBy("i").collect()] == [(0, 1), (1, 2), (2, 2), (3, 3)]
