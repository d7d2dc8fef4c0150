"""Steps that several queries share are worked out once, whatever Spark makes of the plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import ledger, pages
from corpusloom.sources import books


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_flag_counts_work_flags_out_once(spark):
    rows = spark.createDataFrame([(1, "a,b"), (1, "a"), (2, None), (2, "")], "rank int, said string")
    counts = ledger.flag_counts(rows.withColumn("flags", F.filter(F.split("said", ","), lambda f: f != "")))
    assert {tuple(r) for r in counts.collect()} == {(1, "a", 2), (1, "b", 1)}
    # the flags aren't asked for a second time by a filter below the explode
    assert plan(counts).count("split(") == 1


def test_page_units_read_each_page_once(spark):
    pages_ = [(1, "a/One", "<p>" + "A sentence of some length. " * 9 + "</p>"), (2, "a/Two", "<p>Short.</p>"), (3, "a/Three", None), (4, "a/Four", "<p>" + "Word " * 50 + "</p>")]
    rows = spark.createDataFrame(pages_, "place int, title string, html string").withColumn("book", F.lit("b"))
    units = pages.page_units(rows.withColumn("blocks", pages.clean_blocks("html")), "book", "place")
    assert plan(units).count("clean_blocks(") == 1
    got = sorted((r["chapter"], r["ordinal"], r["kind"], r["source"]) for r in units.collect())
    assert [g[:3] for g in got] == [(1, 0, "heading"), *[(1, i, "paragraph") for i in range(1, 10)], (2, 0, "heading"), (2, 1, "paragraph")]
    assert [got[0][3], got[1][3], got[10][3]] == ["One", "A sentence of some length.", "Four"]


def test_markup_of_a_book_is_read_once(spark):
    rows = spark.createDataFrame([(1, "mimetype", 0, True, b"application/epub+zip"), (1, "OEBPS/a.xhtml", 1, False, b"<p>")], f"rank int, {books.MEMBER}")
    violations = books.book_violations(rows)
    # what follows reads what was kept, not the markup again
    assert "checked(" not in plan(violations)
