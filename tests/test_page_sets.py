"""The choice of pages: a root for each arm, the walk's order and limits, and pages that are cut inside."""

from __future__ import annotations

from corpusloom.operators import page_sets as P

#: root, expected; links of a page in their order; second-level sections of a page.
ROOTS = [("T", 3), ("C", 2), ("S", 2), ("F", 9), ("P", 2), ("P2", None), ("A b", 2), ("none", 4)]
LINKS = {
    "T": ["T/x", "T/x/2", "T/x/1", "T/y", "other", "TT/z"],
    "C": ["C/10", "C/9", "C/9/b", "C/notes", "C/Part Zweite"],
    "C/9": ["C/9/c", "C/9/b", "C/9/c"],
    "F": ["F/1", "F/2"],
    "F/1": ["F/1/1"],
    "F/1/1": ["F/1/1/1"],
    "F/1/1/1": ["F/1/1/1/1"],
    "F/1/1/1/1": ["F/1/1/1/1/1"],
    "A b": ["A_b/1", "A b/2"],
    "P": ["elsewhere"],
}
SECTIONS = {"S": ["one", None], "C/10": ["first", "second"], "F/2": ["a"], "P": ["x"], "T/x/1": ["a", "b", "c"]}


def tables(spark, links=LINKS, roots=ROOTS):
    rows = [(t, x, i) for t, xs in links.items() for i, x in enumerate(xs)]
    sections = [(t, i, 2, x) for t, xs in SECTIONS.items() for i, x in enumerate(xs, 1)] + [("S", 9, 3, "deeper"), ("P", 3, 1, "higher")]
    return (
        spark.createDataFrame(roots, "root string, expected int"),
        spark.createDataFrame(rows, "title string, target string, position int"),
        spark.createDataFrame(sections, "title string, index int, level int, line string"),
    )


def found(rows):
    out = {}
    for r in rows.orderBy("root", "place").collect():
        out.setdefault((r["root"], r["strategy"]), []).append(r["title"])
    return out


def test_each_arm(spark):
    got = P.page_sets(*tables(spark))
    assert found(got) == {
        # exactly as many terminals, in the order of the links; one of them stands for its three sections
        ("T", "terminals"): ["T/x/2", "T/x/1/a", "T/x/1/b", "T/x/1/c", "T/y"],
        # by number (c is a roman one) and leaf; a page of as many sections as parts stands for these
        ("C", "children"): ["C/Part Zweite", "C/9/c", "C/9/b", "C/10/first", "C/10/second", "C/notes"],
        ("S", "sections"): ["S/one", "S/2"],
        # four levels and no more
        ("F", "fewer children"): ["F/1/1/1/1", "F/2"],
        ("P", "page"): ["P"],
        ("P2", "page"): ["P2"],
        # blanks and underscores are alike
        ("A b", "terminals"): ["A_b/1", "A b/2"],
        ("none", "page"): ["none"],
    }
    counts = {r["root"]: (r["terminals"], r["children"], r["sections"]) for r in P.candidate_counts(*tables(spark))[0].collect()}
    assert counts["T"] == (3, 2, 0) and counts["C"] == (4, 4, 0) and counts["S"] == (0, 0, 2) and counts["F"] == (2, 2, 0)


def test_limit_of_pages(spark):
    """Parents count too, and come before their children."""
    got = found(P.page_sets(*tables(spark), most_pages=3))
    assert got["C", "children"] == ["C/Part Zweite", "C/9/c"]
    assert ("F", "fewer children") not in got
    assert found(P.page_sets(*tables(spark), most_depth=1))["C", "children"] == ["C/Part Zweite", "C/9", "C/10/first", "C/10/second", "C/notes"]


def test_empty_tables(spark):
    none = tables(spark, {}, [])
    assert P.page_sets(*none).collect() == []
    assert found(P.page_sets(tables(spark)[0], *none[1:])) == {(r, "sections" if r == "S" else "page"): (["S/one", "S/2"] if r == "S" else [r]) for r, _ in ROOTS}


def test_pages_that_are_cut_inside(spark):
    sets = P.page_sets(*tables(spark))
    play = "<p>Who</p><center>Действие первое</center><p>One</p><center>АКТ ВТОРОЕ</center><p>Two</p>"
    book = "<h2>I</h2><p>a</p><h2>II</h2><p>b</p>"
    pages = spark.createDataFrame([("P", play), ("none", play), ("C/notes", book), ("A_b/1", "<p>plain</p>"), ("P2", book)], "title string, html string")
    rows = {(r["root"], r["title"]): (r["part"], r["html"]) for r in P.with_divisions(sets, pages).collect()}
    assert rows["P", "P/Действие первое"] == (0, "<p>Who</p><p>One</p>") and rows["P", "P/АКТ ВТОРОЕ"] == (1, "<p>Two</p>")
    assert rows["C", "C/notes/I"] == (0, "<p>a</p>") and rows["C", "C/notes/II"] == (1, "<p>b</p>")
    # other numbers of parts than expected, one part, sections, pages that haven't landed
    assert rows["none", "none"] == (0, play) and rows["P2", "P2"] == (0, book) and rows["A b", "A_b/1"] == (0, "<p>plain</p>")
    assert rows["C", "C/10/first"] == (0, None) and rows["T", "T/y"] == (0, None)
