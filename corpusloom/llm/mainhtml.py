"""The main text of web pages, as the contiguous region of a page with the largest score.

A page is read as a row of items: blocks of words and tags. A block's words score by the log odds that they are main text; a tag
costs something. The odds come from what a block is in (names of elements, parts of classes, ids and roles), how much of it is linked,
its length, whether it ends like a sentence, and its words if it is short. Their weights are fitted by logistic regression on the
labelled pages of ``labelled``; what a tag costs, how much a block against the region may cost, and from which odds on a block inside
the region is left out are chosen on the same pages (``fitted``). One linear scan finds the contiguous run of items with the largest
sum. A region alone can't leave out an advert in the midst of an article, so blocks inside it that surely are no main text go.

Pages are read in one pass whose time grows as their length. Scripts, styles, comments and what is no text (buttons, drawings, frames)
are no words. White space inside a block becomes one space, character references are decoded, blocks are joined by a line feed.
Malformed markup is read as far as it goes: an end tag closes what it can; an element whose end is missing is taken for empty if it
would have hidden its content (``HIDDEN``), and so are an unclosed comment, script or style up to the next tag; a "<" that starts no
tag is text. Null and empty pages and pages without positive words have the empty text. Of equal sums, the first run is taken.
Repeated rows give repeated results; an empty table gives an empty table; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.labelled import pages as labelled_pages

_ATTRIBUTES = r"""(?:=\s*+(?:"[^"]*+"|'[^']*+')|[^>])*+"""
_TAG = re.compile(rf"<(/?)([a-zA-Z][^\s/>]*+)({_ATTRIBUTES})>")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_TAG_START = re.compile(r"<[a-zA-Z/!?]")
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_LABEL = re.compile(r'data-label="(\w+)"')
_PART = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[^\W\d_]+|©")
_STOP = re.compile(r"[.!?…:;。！？]['\"”’»)]*$")
#: Elements whose text no browser reads as markup, and elements whose content is no text to read.
RAW = ("script", "style", "title", "textarea")
HIDDEN = ("template", "svg", "iframe", "object", "noscript", "button", "select")
_END = {name: re.compile(rf"</{name}\s*+[^>]*+>", re.I) for name in RAW}
_NEXT = {name: re.compile(rf"<(/?){name}\b[^>]*+>", re.I) for name in HIDDEN}
#: Elements without an end, and those that stand inside a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: A block that is open ends with the start of another one.
ENDS_ITSELF = frozenset("p li dt dd tr td th option".split())
#: Words of blocks up to this length count; log odds count up to this limit, at which a word scores 1.
FEW_WORDS, MOST = 30, 3.0
#: What a block against the region costs at most inside an element that speaks for it.
INTERRUPTS = 0.25


def items(html: str) -> Iterator[tuple[str, str, str, str]]:
    """(kind, name, attributes, text) with kind text, start, end or skip, in one pass."""
    at, size, tag, closed = 0, len(html), _TAG, dict.fromkeys((*RAW, *HIDDEN, "!--"), True)
    while at < size:
        lt = html.find("<", at)
        if lt < 0:
            lt = size
        if lt > at:
            yield "text", "", "", html[at:lt]
        if lt == size:
            return
        at = lt
        if html.startswith(("<!", "<?"), lt):
            comment = html.startswith("<!--", lt)
            end = html.find("-->", lt + 2) if comment and closed["!--"] else -1
            # an unclosed comment ends with its own bracket; none that follows is closed, so no end is searched for again
            closed["!--"] &= not comment or end >= 0
            at = end + 3 if end >= 0 else (html.find(">", lt) + 1 or size)
            yield "skip", "!", "", ""
            continue
        m = tag.match(html, lt)
        if m is None and _TAG_START.match(html, lt) and tag is _TAG:
            # no bracket outside quotes from here to the end of the page, so quotes count no longer
            tag = _PLAIN_TAG
            m = tag.match(html, lt)
        if m is None:
            if html.find(">", lt) < 0:
                # nothing that follows is a tag
                yield "text", "", "", html[lt:]
                return
            yield "text", "", "", "<"
            at = lt + 1
            continue
        at, name = m.end(), m[2].lower()
        if m[1]:
            yield "end", name, "", ""
        elif name in RAW:
            end = _END[name].search(html, at) if closed[name] else None
            if end:
                at = end.end()
            else:
                closed[name] = False
                if name in ("script", "style"):
                    after = _TAG_START.search(html, at)
                    at = after.start() if after else size
            yield "skip", name, "", ""
        elif name in HIDDEN:
            end = _NEXT[name].search(html, at) if closed[name] else None
            if end is None:
                closed[name] = False
            elif end[1]:
                at = end.end()
            yield "skip", name, "", ""
        else:
            yield "start", name, m[3] or "", ""


def _own(name: str, attributes: str) -> tuple[str, ...]:
    """What an element is known by: its name, and the parts of its classes, id and role."""
    if name in ("html", "body") or "=" not in attributes:
        return (name,)
    parts = [f".{part}" for m in _NAMED.finditer(attributes) for part in _PART.findall((m[1] or m[2] or m[3] or "").lower())]
    return (name, *dict.fromkeys(parts))


#: What a block that no element is around is in.
OUTSIDE = (frozenset(), 0.0, "rest", 0.0)


class Block:
    """Text between two tags that end a line."""

    __slots__ = ("cost", "inside", "label", "linked", "text", "words")

    def __init__(self, text: str, words: int, linked: float, inside: tuple, cost: int):
        self.text, self.words, self.linked, self.inside, self.cost = text, words, linked, inside, cost
        self.label = inside[2]

    def marks(self) -> Iterator[tuple[str, float]]:
        """What the block is known by beside what it is in."""
        yield "linked", self.linked
        yield ("short" if self.words < 6 else "long" if self.words >= 25 else "middle"), 1.0
        if _STOP.search(self.text):
            yield "stop", 1.0
        if self.words <= FEW_WORDS:
            for word in set(_WORD.findall(self.text.lower())):
                yield f"'{word}", 1.0


def blocks(html: str, weights: dict[str, float]) -> list[Block]:
    """The blocks of a page; what each is in comes as (names, sum of their weights, label, largest such sum of an element that holds blocks)."""
    open_: list[tuple[str, tuple]] = []
    #: How many elements of a name are open, so that an end tag without one costs nothing.
    many: Counter[str] = Counter()
    found: list[Block] = []
    text: list[str] = []
    linked_chars, link, tags = 0, -1, 0

    def close() -> None:
        nonlocal linked_chars, tags
        if text:
            joined = _SPACE.sub(" ", unescape("".join(text))).strip()
            if joined:
                found.append(Block(joined, joined.count(" ") + 1, min(1.0, linked_chars / len(joined)), open_[-1][1] if open_ else OUTSIDE, tags))
                tags = 0
            text.clear()
        linked_chars = 0

    for kind, name, attributes, data in items(html):
        if kind == "text":
            text.append(data)
            if link >= 0:
                linked_chars += len(data)
            continue
        if kind == "skip":
            continue
        tags += 1
        if name in INLINE:
            if name == "br":
                text.append(" ")
            elif name == "a":
                link = len(open_) if kind == "start" else -1
            continue
        close()
        if name in VOID:
            continue
        if kind == "start":
            if open_ and open_[-1][0] in ENDS_ITSELF and (open_[-1][0] == name or open_[-1][0] == "p"):
                many[open_.pop()[0]] -= 1
            names, total, label, most = open_[-1][1] if open_ else OUTSIDE
            own = _own(name, attributes)
            new = [x for x in own if x not in names and x in weights]
            if new:
                names, total = names.union(new), total + sum(weights[x] for x in new)
            if attributes and (m := _LABEL.search(attributes)):
                label = m[1]
            if name not in ENDS_ITSELF:
                most = max(most, total)
            open_.append((name, (names, total, label, most)))
            many[name] += 1
        else:
            last = "" if many[name] else name
            while last != name:
                last = open_.pop()[0]
                many[last] -= 1
            if link > len(open_):
                link = -1
    close()
    return found


class Model:
    def __init__(self, weights: dict[str, float], bias: float, tag_cost: float, bridge: float, sure: float):
        self.weights, self.bias, self.tag_cost, self.bridge, self.sure = weights, bias, tag_cost, bridge, sure

    def odds(self, block: Block) -> float:
        weights = self.weights
        total = self.bias + block.inside[1]
        for what, value in block.marks():
            if what in weights:
                total += weights[what] * value
        return total

    def chosen(self, found: list[Block], odds: list[float]) -> list[Block]:
        """The best contiguous run: a running sum that starts anew where it falls below nothing."""
        best, best_run, now, start = 0.0, (0, 0), 0.0, 0
        for i, (block, each) in enumerate(zip(found, odds, strict=True)):
            now -= block.cost * self.tag_cost
            if now <= 0:
                now, start = 0.0, i
            # where an element around it speaks for main text, a block against it interrupts that, however long it is
            least = -INTERRUPTS if self.bias + block.inside[3] > 0 else -self.bridge
            now += max(least, block.words * max(-1.0, min(1.0, each / MOST)))
            if now > best:
                best, best_run = now, (start, i + 1)
        return [b for b, each in zip(found[slice(*best_run)], odds[slice(*best_run)], strict=True) if each > -self.sure]

    def extract(self, html: str | None) -> str:
        if not html:
            return ""
        found = blocks(html, self.weights)
        if all(b.inside is OUTSIDE for b in found) and not any(b.cost for b in found):
            # words without a tag are the region
            return "\n".join(b.text for b in found)
        return "\n".join(b.text for b in self.chosen(found, [self.odds(b) for b in found]))


#: What is chosen from: costs of a tag, limits of a block against the region, odds against a block inside it.
COSTS, BRIDGES, SURE = (0.02, 0.05, 0.1), (2.0, 4.0, 8.0), (0.5, 1.0, 1.5)
WORD_PULL = 10.0


@cache
def fitted() -> Model:
    """The model of the labelled pages: logistic regression by Newton steps, with a pull towards nothing."""
    every = dict.fromkeys({own for page in labelled_pages() for kind, name, attributes, _ in items(page) if kind == "start" for own in _own(name, attributes)}, 0.0)
    pages = [blocks(page, every) for page in labelled_pages()]
    seen = [[dict.fromkeys(b.inside[0], 1.0) | dict(b.marks()) for b in page] for page in pages]
    in_pages = Counter(what for page in seen for what in {w for marks in page for w in marks})
    names = sorted(what for what, n in in_pages.items() if n >= 4)
    at = {what: i + 1 for i, what in enumerate(names)}
    x = np.zeros((sum(map(len, seen)), len(names) + 1))
    x[:, 0] = 1
    for row, marks in zip(x, (m for page in seen for m in page), strict=True):
        for what, value in marks.items():
            if what in at:
                row[at[what]] = value
    y = np.array([b.label == "main" for page in pages for b in page], dtype=float)
    # the few words of these pages tell less than they seem to
    w, pull = np.zeros(x.shape[1]), np.array([1e-3, *(WORD_PULL if what.startswith("'") else 1.0 for what in names)])
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag(pull), x.T @ (y - p) - pull * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    weights = {what: float(w[i]) for what, i in at.items()}
    known = [(page, x_ @ w) for page, x_ in zip(pages, np.split(x, np.cumsum([len(p) for p in pages])[:-1]), strict=True)]

    def right(model: Model) -> float:
        """The mean over pages of twice the words found over words found and words to be found."""
        shares = []
        for page, odds in known:
            got, want = {id(b) for b in model.chosen(page, odds.tolist())}, {id(b) for b in page if b.label == "main"}
            count = {id(b): b.words for b in page}
            words = [sum(count[b] for b in some) for some in (got & want, got, want)]
            shares.append(2 * words[0] / max(1, words[1] + words[2]))
        return sum(shares) / len(shares)

    models = [Model(weights, float(w[0]), cost, bridge, sure) for cost in COSTS for bridge in BRIDGES for sure in SURE]
    return max(models, key=right)


def extract(html: str | None) -> str:
    """The main text of a page."""
    return fitted().extract(html)


def main_text(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    model = fitted()

    @F.pandas_udf("string")
    def run(html: pd.Series) -> pd.Series:
        return pd.Series([model.extract(h) for h in html], dtype=object)

    found = pages.select("page_id", "url", run(F.col("html")).alias("text"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
