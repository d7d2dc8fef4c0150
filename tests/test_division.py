"""Division of pages against a plain definition on random trees; balanced markup and linear time on any page."""

from __future__ import annotations

import random
import re
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import division

MARK = re.compile(r"act \d+\.?", re.I)


class Tree:
    def __init__(self, tag, attrs="", kids=()):
        self.tag, self.attrs, self.kids = tag, attrs, list(kids)

    def html(self):
        return f"<{self.tag}{self.attrs}>" + "".join(k if isinstance(k, str) else k.html() for k in self.kids) + f"</{self.tag}>"

    def texts(self):
        for k in self.kids:
            if isinstance(k, str):
                if k.strip():
                    yield k.strip()
            else:
                yield from k.texts()

    def walk(self, above=()):
        yield self, above
        for k in self.kids:
            if not isinstance(k, str):
                yield from k.walk((*above, self))


def random_tree(rng, depth=0, in_p=False):
    """Trees that stand as they are in HTML: nothing that ends a paragraph inside one."""
    tags = ["span", "i"] if in_p else ["div", "p", "h2", "h3", "center", "blockquote", "section", "span"]
    tag = rng.choice(tags)
    attrs = rng.choice(["", "", ' class="poem"', ' class="x poem"', ' class="mw-parser-output"', ' class="prp-pages-output"', ' title="a"']) if tag == "div" else ""
    kids = []
    for _ in range(rng.choice([0, 1, 2, 3]) if depth < 5 else 0):
        kids.append(rng.choice(["some words", " ", "act 1", "ACT  2.", "act 3", "x y"]) if rng.random() < 0.5 else random_tree(rng, depth + 1, in_p or tag == "p"))
    return Tree(tag, attrs, kids or [rng.choice(["act 4", "words", ""])])


def by_definition(root, expected):
    """Blocks one by one, each written out whole; what an outer block of the same part holds is left out."""
    nodes = list(root.walk())
    classes = lambda t: t.attrs[8:-1].split() if t.attrs.startswith(' class="') else []
    inside = None
    for name in division.CONTENT:
        inside = next((t for t, _ in nodes if name in classes(t)), None)
        if inside is not None:
            break
    titles, groups, of = [], [[]], {}
    for t, above in nodes:
        poem = t.tag == "div" and "poem" in classes(t)
        if not (t.tag in division.BLOCKS or poem) or (inside is not None and inside not in above):
            continue
        if t.tag == "p" and any(a.tag == "div" and "poem" in classes(a) for a in above):
            continue
        text = re.sub(r"\s+", " ", " ".join(t.texts())).strip()
        if MARK.fullmatch(text):
            titles.append(text)
            groups.append([])
            continue
        of[id(t)] = len(titles)
        outer = next((a for a in reversed(above) if id(a) in of), None)
        if outer is None or of[id(outer)] != len(titles):
            groups[-1].append(t.html())
    if expected <= 1 or len(titles) != expected:
        return []
    groups[1][:0] = groups[0]
    return [(t, "".join(g)) for t, g in zip(titles, groups[1:], strict=True)]


def test_division_is_its_definition_on_random_trees():
    rng = random.Random(5)
    divided = 0
    for _ in range(3000):
        tree = Tree("body", "", [random_tree(rng) for _ in range(rng.randint(0, 5))])
        page = division.parsed(tree.html())
        assert "".join(page.out) == tree.html()
        for expected in range(6):
            got = division.divided(page, expected, MARK)
            assert got == by_definition(tree, expected), tree.html()
            divided += bool(got)
    assert divided > 300


class Balance(HTMLParser):
    def __init__(self):
        super().__init__()
        self.open = []

    def handle_starttag(self, tag, attrs):
        if tag not in division.VOID_TAGS:
            self.open.append(tag)

    def handle_endtag(self, tag):
        assert self.open.pop() == tag


def test_parts_of_any_page_are_balanced():
    rng = random.Random(8)
    parts = ["<p>", "</p>", "<div>", "</div>", '<div class="poem">', "<blockquote>", "</blockquote>", "<b>", "</i>", "<br>", "<h2>act 1</h2>", "<center>act 2", "</x>", "<p>act 3</p>", "words &amp; <", "<li>", "<!--", "<a href='x", "<script>a<b</script>"]
    seen = 0
    for _ in range(2000):
        page = division.parsed("".join(rng.choice(parts) for _ in range(rng.randint(1, 30))))
        for expected in (2, 3, 4):
            for _, html in division.divided(page, expected, MARK):
                check = Balance()
                check.feed(html)
                check.close()
                assert not check.open
                seen += 1
    assert seen > 100


@pytest.mark.parametrize("part", ["<p>", "<div>", "<blockquote>", "</x>", "<div></x>", "<b><p>", "<p>act 1</p>", "<blockquote>act 1", '<div class="poem">', "<span>", "<br>", "x", "<ul><li>", "<center><h3></h3>", "<center>x<h2>act 1</h2>"])
def test_division_takes_linear_time(part):
    def seconds(n):
        html = part * (n // len(part))
        began = time.process_time()
        page = division.parsed(html)
        division.divided(page, 3, MARK)
        division.divided(page, 3, MARK, ("h2",), ("h2", "h3"))
        return time.process_time() - began

    seconds(1000)
    large = min(seconds(400_000) for _ in range(2))
    assert large < 0.5 or large < 3.2 * min(seconds(200_000) for _ in range(2))


def test_acts_and_numerals(spark):
    play = '<div class="mw-parser-output"><p>Persons</p><center>ДЕЙСТВИЕ  ПЕРВОЕ</center><p>One.</p><div class="poem"><p>Line</p></div><h3>Акт второе.</h3><p>Two.</div><p>outside</p>'
    book = "<h2>Preface</h2><h2>I.</h2><p>a</p><h2><span>II</span></h2><center>left out</center><p>b</p>"
    rows = [(1, play, 2), (2, play, 3), (3, book, 2), (4, book, 1), (5, None, 2), (6, "", None), (7, "<p>plain</p>", 2)]
    table = spark.createDataFrame(rows, "id int, html string, expected int")
    got = {r["id"]: [tuple(x) for x in r["d"]] for r in table.select("id", division.divisions(F.col("html"), F.col("expected")).alias("d")).collect()}
    assert got[1] == [("ДЕЙСТВИЕ ПЕРВОЕ", '<p>Persons</p><p>One.</p><div class="poem"><p>Line</p></div>'), ("Акт второе.", "<p>Two.</p>")]
    assert got[3] == [("I.", "<h2>Preface</h2><p>a</p>"), ("II", "<p>b</p>")]
    assert [got[i] for i in (2, 4, 5, 6, 7)] == [[]] * 5
    own = division.divisions(F.col("html"), F.col("expected"), (r"[ab]", "p"), (r"(?i)i+\.?", ""))
    assert [tuple(x) for x in table.filter("id = 3").select(own.alias("d")).first()["d"]][0] == ("a", "<h2>Preface</h2><h2>I.</h2><h2><span>II</span></h2><center>left out</center>")
