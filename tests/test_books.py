"""Books cut into blocks and chapters; translation with stand-ins for models."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import books as B
from corpusloom.operators import translate
from corpusloom.operators.lineage import kept
from corpusloom.sources.readers import between_marks


def one(spark, column, t):
    return spark.range(1).select(F.lit(t).alias("t")).select(column.alias("x")).first()["x"]


def test_blocks(spark):
    text = "One\ntwo\n\n   A verse\n   and more\n\n\n  \n\nlast "
    assert one(spark, B.blocks(F.col("t")), text) == ["One two", "A verse\nand more", "last"]


def test_chapters(spark):
    text = "Front\nPREFACE\nHello there\nCHAPTER I\none\nCHAPTER II\ntwo\nCHAPTER III\nthree"
    heading = r"^CHAPTER [IVX]+$"
    assert one(spark, B.chapters(F.col("t"), heading), text) == ["CHAPTER I\none\n", "CHAPTER II\ntwo\n", "CHAPTER III\nthree"]
    assert one(spark, B.chapters(F.col("t"), heading, last=2), text) == ["CHAPTER II\ntwo\n", "CHAPTER III\nthree"]
    assert one(spark, B.chapters(F.col("t"), heading), "CHAPTER I\nalone") is None
    assert one(spark, B.preface(F.col("t"), "PREFACE", heading), text) == "Hello there"
    assert one(spark, B.preface(F.col("t"), "INTRO", heading), text) is None


def test_section(spark):
    text = "aa START " + "x" * 40 + " END bb"
    assert one(spark, B.section(F.col("t"), "START", "END", least=10), text) == "x" * 40
    assert one(spark, B.section(F.col("t"), "START", "END", with_start=True, least=10), text).startswith("START x")
    assert one(spark, B.section(F.col("t"), "NONE", least=1), text) is None
    assert one(spark, B.section(F.col("t"), "START", "END", least=41), text) is None


def test_kinds(spark):
    rows = spark.createDataFrame([(0, 0, "Title"), (0, 3, "Title"), (0, 1, "x" * 140), (1, 1, "Title"), (0, 2, "a\nb")], "p int, e int, b string")
    assert [r[0] for r in rows.select(B.kind(F.col("p"), F.col("e"), F.col("b"))).collect()] == ["heading", "paragraph", "paragraph", "continuation", "paragraph"]
    assert one(spark, B.copied_heading(F.col("t")), "xiv.") and not one(spark, B.copied_heading(F.col("t")), "mix it")


def test_marks(spark):
    marked = "﻿front\n*** START OF THE PROJECT GUTENBERG EBOOK X ***\nbody\n*** END OF THIS PROJECT GUTENBERG EBOOK X ***\ntail"
    found = spark.createDataFrame([(marked,), ("no marks",)], "text string").select(*[c.alias(n) for n, c in between_marks().items()]).collect()
    assert [(r.marked, r.body) for r in found] == [(True, "body"), (False, None)]


def units(spark):
    text = "First sentence here. " * 60
    return spark.createDataFrame([(1, text.strip(), "paragraph", ""), (2, "Short one.", "paragraph", None), (3, "XII.", "heading", "")], "id int, source string, kind string, translation string")


def test_translated(spark):
    def upper(texts, parameters):
        return [t.upper() for t in texts]

    def mark(texts, parameters):
        return [f"<{t}>" for t in texts]

    rows = {r.id: r.translation for r in translate.translated(units(spark), ["id"], [upper, mark], batch=3).collect()}
    assert rows[2] == "<SHORT ONE.>" and rows[1].count("<") == 2
    assert rows[1].replace("<", "").replace(">", "") == ("FIRST SENTENCE HERE. " * 60).strip()
    assert {r.id for r in translate.pending(units(spark)).collect()} == {1, 2}


def test_translators_must_answer(spark):
    with pytest.raises(Exception, match="gave 0 texts"):
        translate.translated(units(spark), ["id"], [lambda texts, parameters: []]).collect()


def test_repair_goes_down_the_ladder_for_what_is_left(spark):
    long = "Every word of this sentence is said only once and then it ends quite soon. " * 2
    rows = spark.createDataFrame([(1, "A good day.", "paragraph", "Una bella giornata."), (2, long.strip(), "paragraph", "")], "id int, source string, kind string, translation string")

    def careful(texts, parameters):
        return [t.upper() if parameters.get("beams", 0) >= 5 else "" for t in texts]

    found = {r.id: r for r in translate.repaired(rows, ["id"], [careful], "en", ladder=translate.LADDER[:3]).collect()}
    assert (found[1].candidate, found[1].translation, found[1].clear) == (0, "Una bella giornata.", True)
    assert found[2].candidate == 4 and found[2].translation.startswith("EVERY WORD")


def test_acceptance(spark):
    s, b, a = (F.lit(x) for x in ("x" * 100, "y" * 70, "y" * 75))
    got = spark.range(1).select(translate.accepted(s, b, a).alias("p"), translate.accepted(s, b, F.lit("y" * 71)).alias("q"), translate.improves(s, F.lit("y" * 50), b).alias("r"), translate.runs_away(s, F.lit("y" * 17)).alias("t")).first()
    assert tuple(got) == (True, False, True, True)
    assert kept(spark.range(3)).count() == 3
