"""Division of one page into parts at marks or headings inside its markup, in one pass over it.

The blocks of a page (those of BLOCKS and poems) are taken in the order in which they begin. A block whose whole text is a mark begins a part, and the blocks
up to the next mark are its content; what stands before the first mark goes to the first part. A page whose parts aren't exactly
as many as expected isn't divided at all.

The page is written out once with every element closed, and a block is a stretch of that, so its markup is balanced whatever the page's was. A
block inside a block of the same part isn't repeated; one whose outer block belongs to an earlier part is, as it is only there.
"""

from __future__ import annotations

import re
from collections import Counter
from html import escape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements that are blocks, classes that hold a page's content, and what marks an act of a play or a chapter.
BLOCKS = ("center", "h2", "h3", "h4", "p", "blockquote")
CONTENT = ("prp-pages-output", "mw-parser-output")
ACTS = ("ДЕЙСТВИЕ", "АКТ")
ORDINALS = ("ПЕРВОЕ", "ВТОРОЕ", "ТРЕТЬЕ", "ЧЕТВЕРТОЕ", "ПЯТОЕ")
ACT = re.compile(rf"(?:{'|'.join(ACTS)})\s+(?:{'|'.join(ORDINALS)})\.?", re.I)
NUMERAL = re.compile(r"[IVXLCDM]+\.?", re.I)

VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements that end a paragraph when they begin.
ENDS_PARAGRAPH = frozenset("address article aside blockquote center details div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
#: Characters of a text that may be a mark. A longer one isn't looked at, so that blocks inside one another cost no more than the page.
MARK_CHARS = 1000


class _Block:
    __slots__ = ("content", "group", "in_poem", "inside", "outer", "pieces", "tag", "texts")

    def __init__(self, tag: str, inside: _Block | None, in_poem: bool, content: tuple[bool, ...], piece: int, text: int):
        self.tag, self.inside, self.in_poem, self.content = tag, inside, in_poem, content
        self.pieces, self.texts, self.group, self.outer = (piece, piece), (text, text), -1, None


class _Page(HTMLParser):
    """A page's markup with every element closed, its texts, and its blocks as stretches of both."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.texts: list[str] = []
        self.size = [0]
        self.blocks: list[_Block] = []
        self.open: list[tuple[str, _Block | None, bool, int]] = []  # tag, its block, a poem, which content it begins
        self.many: Counter[str] = Counter()
        self.poems = 0
        self.block: _Block | None = None
        #: Of each class of content: whether its first element is open, or was (None: none has come).
        self.content: list[bool | None] = [None] * len(CONTENT)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ENDS_PARAGRAPH and self.many["p"]:
            self.handle_endtag("p")
        classes = (dict(attrs).get("class") or "").split()
        begins = -1
        for i, name in enumerate(CONTENT):
            if name in classes and self.content[i] is None and tag not in VOID_TAGS:
                begins = i
                self.content[i] = True
        poem = tag == "div" and "poem" in classes
        block = None
        # the element that begins the content is what holds the blocks, not one of them
        if tag in BLOCKS or poem:
            within = tuple(x is True and i != begins for i, x in enumerate(self.content))
            block = _Block(tag, self.block, self.poems > 0, within, len(self.out), len(self.texts))
            self.blocks.append(block)
        self.out.append(f"<{tag}{''.join(f' {k}' if v is None else f' {k}="{escape(v)}"' for k, v in attrs)}>")
        if tag in VOID_TAGS:
            if block is not None:
                block.pieces = (block.pieces[0], len(self.out))
            return
        self.open.append((tag, block, poem, begins))
        self.many[tag] += 1
        self.poems += poem
        self.block = block or self.block

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        last = "" if self.many[tag] else tag
        while last != tag:
            last, block, poem, begins = self.open.pop()
            self.many[last] -= 1
            self.poems -= poem
            self.out.append(f"</{last}>")
            if begins >= 0:
                self.content[begins] = False
            if block is not None:
                block.pieces, block.texts = (block.pieces[0], len(self.out)), (block.texts[0], len(self.texts))
                self.block = block.inside

    def handle_data(self, data: str) -> None:
        raw = bool(self.many["script"] or self.many["style"])
        self.out.append(data if raw else escape(data, quote=False))
        if not raw and (said := data.strip()):
            self.texts.append(said)
            self.size.append(self.size[-1] + len(said) + 1)

    def close(self) -> None:
        super().close()
        while self.open:
            self.handle_endtag(self.open[-1][0])

    def text_of(self, block: _Block) -> str | None:
        a, b = block.texts
        return None if self.size[b] - self.size[a] > MARK_CHARS else re.sub(r"\s+", " ", " ".join(self.texts[a:b])).strip()


def parsed(html: str | None) -> _Page:
    page = _Page()
    page.feed(html or "")
    page.close()
    return page


def divided(page: _Page, expected: int, mark: re.Pattern[str], marks: tuple[str, ...] | None = None, blocks: tuple[str, ...] = BLOCKS) -> list[tuple[str, str]]:
    """The parts (title, html) of a page at blocks whose text is a mark; ``marks``: the only elements that may be marks; none if they aren't as many as expected."""
    if expected <= 1:
        return []
    held = next((i for i, x in enumerate(page.content) if x is not None), None)
    counted = [
        b for b in page.blocks if (held is None or b.content[held]) and not (b.tag == "p" and b.in_poem) and (b.tag in blocks or b.tag == "div")
    ]
    texts = {id(b): t for b in counted if (marks is None or b.tag in marks) and (t := page.text_of(b)) is not None and mark.fullmatch(t)}
    # counted before anything is put together: so many parts, each of the page's size at most
    if len(texts) != expected:
        return []
    for block in page.blocks:
        block.group = -1
    groups: list[list[str]] = [[]]
    part, at = 0, 0
    for block in page.blocks:
        # the nearest block around this one that is some part's content; what is around it was looked at before
        block.outer = block.inside if block.inside is None or block.inside.group >= 0 else block.inside.outer
        if at == len(counted) or block is not counted[at]:
            continue
        at += 1
        if id(block) in texts:
            part += 1
            groups.append([])
            continue
        block.group = part
        # an outer block's markup holds this one
        if block.outer is None or block.outer.group != part:
            groups[-1].append("".join(page.out[block.pieces[0] : block.pieces[1]]))
    groups[1][:0] = groups[0]
    return list(zip(texts.values(), ["".join(g) for g in groups[1:]], strict=True))


def by_acts(page: _Page, expected: int) -> list[tuple[str, str]]:
    """Parts of a play on one page, at lines that name an act."""
    return divided(page, expected, ACT)


def by_numerals(page: _Page, expected: int) -> list[tuple[str, str]]:
    """Parts of a book on one page, at second-level headings that are roman numerals."""
    return divided(page, expected, NUMERAL, ("h2",), tuple(b for b in BLOCKS if b != "center"))


def divisions(html: Column, expected: Column, *ways: tuple[str, str]) -> Column:
    """array<struct<title, html>>: the parts of a page, by acts, else by numerals; empty if it isn't divided into as many as expected.

    ways: (pattern, elements with blanks between, or none for any block) instead of these two, in the order in which they are tried."""

    @F.pandas_udf("array<struct<title:string,html:string>>")
    def run(pages: pd.Series, counts: pd.Series) -> pd.Series:
        tried = [(re.compile(p), tuple(e.split()) or None) for p, e in ways]
        out = []
        for page, n in zip(pages, counts, strict=True):
            found: list[tuple[str, str]] = []
            if page is not None:
                tree = parsed(page)
                found = next((x for mark, marks in tried if (x := divided(tree, int(n), mark, marks))), []) if tried else by_acts(tree, int(n)) or by_numerals(tree, int(n))
            out.append([{"title": t, "html": h} for t, h in found])
        return pd.Series(out)

    # pages of which no parts are expected aren't even sent
    return run(F.when(F.coalesce(expected, F.lit(0)) > 1, html), F.coalesce(expected, F.lit(0)))
