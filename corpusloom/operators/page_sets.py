"""Which pages make up a work: several sets of candidates for each root, compared with how many parts are expected.

For each root (root, expected) these sets are counted, and the first that fits is taken:

1. terminals: the linked pages below the root under which no other linked page stands, if they are exactly as many as expected;
2. children: the pages right under the root, if they are at least as many;
3. sections: the root's own second-level sections, if more than one part is expected and they are exactly as many;
4. fewer children: the children that there are;
5. page: the root alone.

Terminals and children are walked from: a page's children are the pages right under it that it, or its root, links to, in the order of
their numbers; at most MOST_DEPTH levels and MOST_PAGES pages a root, parents before children. The pages where the walk ends are the work's leaves;
one whose second-level sections are as many as expected stands for these. All roots are one plan: sets, counts, walks and choices are joins and
aggregates, and nothing is decided on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.division import divisions
from corpusloom.operators.lineage import kept
from corpusloom.operators.pages import ancestors, leaf_of, title_number

#: Levels that are walked, and pages of a root.
MOST_DEPTH, MOST_PAGES = 4, 240


def plain(title: Column) -> Column:
    """A title by which others are found to stand under it: blanks and underscores are alike."""
    return F.replace(title, F.lit(" "), F.lit("_"))


def parent(title: Column) -> Column:
    """The title right above; "" if there is none."""
    return F.regexp_extract(plain(title), "(?s)^(.*)/[^/]+$", 1)


def _rank(title: Column, by: Column, position: Column) -> Column:
    """A child's place among its siblings: numbered ones first, then by leaf, then as they are linked to, the page's own links first."""
    number = title_number(title)
    return F.struct(number.isNull().alias("unnumbered"), F.coalesce(number, F.lit(0)).cast("long").alias("number"), leaf_of(title).alias("leaf"), by.cast("int").alias("by"), position.cast("long").alias("at"), title.alias("title"))


def _kids(links: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parent, target, rank): what pages link to right under them; and (root, parent, target, rank): what roots link to, by what it stands under."""
    once = links.groupBy("title", "target").agg(F.min("position").alias("position")).withColumn("parent", parent(F.col("target"))).filter("parent <> ''")
    own = once.filter(F.col("parent") == plain(F.col("title"))).select("parent", "target", _rank(F.col("target"), F.lit(0), F.col("position")).alias("rank"))
    of_root = once.join(roots.select(F.col("root").alias("title")).distinct(), "title", "left_semi")
    return own, of_root.select(F.col("title").alias("root"), "parent", "target", _rank(F.col("target"), F.lit(1), F.col("position")).alias("rank"))


def candidate_counts(roots: DataFrame, links: DataFrame, sections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """roots (root, expected) with terminals, children, sections and the ``strategy`` taken; and the terminals (root, title, position).

    links (title, target, position), sections (title, index, level, line)."""
    mine = links.join(roots.select(F.col("root").alias("title")).distinct(), "title", "left_semi")
    below = mine.filter(F.startswith(plain(F.col("target")), F.concat(plain(F.col("title")), F.lit("/"))))
    below = kept(below.groupBy(F.col("title").alias("root"), F.col("target").alias("title")).agg(F.min("position").alias("position")))
    above = below.select("root", F.explode(ancestors(plain(F.col("title")))).alias("above")).distinct()
    terminals = below.withColumn("above", plain(F.col("title"))).join(above, ["root", "above"], "left_anti").drop("above")
    kids = below.filter(parent(F.col("title")) == plain(F.col("root")))
    count = lambda rows, name: rows.groupBy("root").agg(F.count("*").alias(name))
    level_two = sections.filter("level = 2").groupBy(F.col("title").alias("root")).agg(F.count("*").alias("sections"))
    found = roots.join(count(terminals, "terminals"), "root", "left").join(count(kids, "children"), "root", "left").join(level_two, "root", "left")
    found = found.na.fill(0, ["terminals", "children", "sections"])
    n, kids_, some = F.col("expected"), F.col("children"), F.col("children") > 0
    strategy = (
        F.when(F.col("terminals") == n, "terminals")
        .when(some & (kids_ >= n), "children")
        .when((n > 1) & (F.col("sections") == n), "sections")
        .when(some, "fewer children")
        .otherwise("page")
    )
    return found.withColumn("strategy", strategy), terminals


def walked(starts: DataFrame, own: DataFrame, of_root: DataFrame, most_depth: int = MOST_DEPTH, most_pages: int = MOST_PAGES) -> DataFrame:
    """(root, title, depth, path, leaf) of the pages that a walk from starts (root, title, rank) comes to; leaf: it opens no other page."""
    level = starts.select("root", "title", F.lit(1).alias("depth"), F.array("rank").alias("path"))
    found, opened = level, None
    for depth in range(1, most_depth):
        here = level.withColumn("parent", plain(F.col("title")))
        next_ = here.join(own, "parent").select("root", "parent", "target", "path", "rank")
        next_ = next_.unionByName(here.join(of_root, ["root", "parent"]).select("root", "parent", "target", "path", "rank"))
        # a child that both link to counts where the page itself has it
        first = next_.groupBy("root", "parent", "target").agg(F.min_by(F.struct("path", "rank"), F.struct(F.col("rank.by"), F.col("rank.at"))).alias("m"))
        level = kept(first.select("root", F.col("target").alias("title"), F.lit(depth + 1).alias("depth"), F.concat("m.path", F.array("m.rank")).alias("path"), "parent"))
        above = level.select("root", "parent").distinct()
        opened = above if opened is None else opened.unionByName(above)
        level = level.drop("parent")
        found = found.unionByName(level)
    # the last level isn't opened; row numbers up to a limit are cut off before rows of one root meet
    place = F.row_number().over(Window.partitionBy("root").orderBy("path"))
    visited = found.withColumn("visit", place).filter(F.col("visit") <= most_pages)
    marked = visited.withColumn("parent", plain(F.col("title")))
    if opened is None:
        return marked.withColumn("leaf", F.lit(True)).drop("parent")
    return marked.join(opened.distinct().withColumn("opened", F.lit(True)), ["root", "parent"], "left").withColumn("leaf", F.col("opened").isNull()).drop("parent", "opened")


def page_sets(roots: DataFrame, links: DataFrame, sections: DataFrame, most_depth: int = MOST_DEPTH, most_pages: int = MOST_PAGES) -> DataFrame:
    """(root, strategy, expected, place, page, section, title): the pages of each root, or the sections of them, in their order.

    section is null where a whole page is meant. roots (root, expected): one row each; a null number expects one part. Pages that nothing
    links to aren't found; an unknown root is a page alone."""
    roots = roots.select("root", F.coalesce("expected", F.lit(1)).cast("long").alias("expected"))
    known, terminals = candidate_counts(roots, links, sections)
    known = kept(known)
    own, of_root = (kept(k) for k in _kids(links, roots))
    chosen = known.select("root", "strategy", "expected")
    flat = F.struct(F.lit(True).alias("unnumbered"), F.lit(0).cast("long").alias("number"), F.lit("").alias("leaf"), F.lit(0).alias("by"), F.col("position").cast("long").alias("at"), F.col("title").alias("title"))
    of_terminals = terminals.join(chosen.filter("strategy = 'terminals'").select("root"), "root", "left_semi").select("root", "title", flat.alias("rank"))
    direct = of_root.filter(F.col("parent") == plain(F.col("root")))
    of_children = direct.join(chosen.filter("strategy in ('children', 'fewer children')").select("root"), "root", "left_semi").select("root", F.col("target").alias("title"), "rank")
    leaves = walked(of_terminals.unionByName(of_children), own, of_root, most_depth, most_pages).filter("leaf").select("root", "title", "path")
    alone = chosen.filter("strategy = 'page'").select("root", F.col("root").alias("title"), F.array(flat_of_root()).alias("path"))
    whole = leaves.unionByName(alone).join(chosen, "root")

    level_two = sections.filter("level = 2").select("title", "index", "line")
    counts = level_two.groupBy("title").agg(F.count("*").alias("n"))
    cut = whole.join(counts, "title", "left").withColumn("cut", F.coalesce(F.col("n") == F.col("expected"), F.lit(False)) & (F.col("strategy") != "page"))
    sectioned = cut.filter("cut").select("root", "strategy", "expected", "title", "path")
    of_root_sections = chosen.filter("strategy = 'sections'").select("root", "strategy", "expected", F.col("root").alias("title"), F.array(flat_of_root()).alias("path"))
    named = F.concat(F.col("title"), F.lit("/"), F.coalesce("line", F.col("index").cast("string")))
    parts = sectioned.unionByName(of_root_sections).join(level_two, "title").select("root", "strategy", "expected", "path", F.col("title").alias("page"), F.col("index").cast("long").alias("section"), named.alias("title"))
    pages_ = cut.filter(~F.col("cut")).select("root", "strategy", "expected", "path", F.col("title").alias("page"), F.lit(None).cast("long").alias("section"), "title")
    # at most MOST_PAGES pages of a root, each with at most as many sections as are expected
    place = F.row_number().over(Window.partitionBy("root").orderBy("path", "page", "section"))
    return parts.unionByName(pages_).withColumn("place", place.cast("long")).select("root", "strategy", "expected", "place", "page", "section", "title")


def flat_of_root() -> Column:
    return F.struct(F.lit(True).alias("unnumbered"), F.lit(0).cast("long").alias("number"), F.lit("").alias("leaf"), F.lit(0).alias("by"), F.lit(0).cast("long").alias("at"), F.col("root").alias("title"))


def with_divisions(sets: DataFrame, pages: DataFrame) -> DataFrame:
    """sets with ``part`` and ``html`` of their pages (title, html): whole pages that can be cut into as many parts as expected, at their acts or numerals, stand for these parts."""
    held = sets.join(pages.select(F.col("title").alias("page"), "html"), "page", "left")
    cut = held.withColumn("parts", F.when(F.col("section").isNull(), divisions(F.col("html"), F.col("expected"))))
    one = F.array(F.struct(F.lit(None).cast("string").alias("title"), F.col("html").alias("html")))
    rows = cut.select("root", "strategy", "expected", "place", "page", "section", "title", F.posexplode(F.when(F.size("parts") > 0, F.col("parts")).otherwise(one)).alias("part", "division"))
    full = F.when(F.col("division.title").isNotNull(), F.concat(F.col("title"), F.lit("/"), F.col("division.title"))).otherwise(F.col("title"))
    return rows.select("root", "strategy", "expected", "place", F.col("part").cast("long").alias("part"), "page", "section", full.alias("title"), F.col("division.html").alias("html"))
