"""Pages: blocks of their prose, their tree by title, their order by number."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from corpusloom.functions.packing import split_long_block
from corpusloom.functions.rows import of_each
from corpusloom.functions.text import normalized, roman_value, unit_id
from corpusloom.operators.lineage import kept

# What is no prose, and what a block is.
NOISE_TAGS = {"style", "script"}
NOISE_CLASSES = {"ws-noexport", "noprint", "header", "subpages", "mw-editsection", "printfooter", "catlinks", "PageNumber", "pagenum", "ws-pagenum"}
BLOCK_TAGS = {"h2", "h3", "h4", "p", "blockquote"}
ROOTS = ("prp-pages-output", "mw-parser-output")
RIGHTS_TEMPLATE = "Если произведение является переводом, или иным производным произведением"
NUMERAL_BLOCK = re.compile(r"(?i)[0-9ivxlcdm. –—-]+")
VOID_TAGS = set("area base br col embed hr img input link meta source track wbr".split())


class _Blocks(HTMLParser):
    """Collects text by block. A block inside another one gives its text to both."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, set[str], bool, list[str] | None]] = []  # tag, classes, noise, text of a block
        #: Open elements of a name and poems, so that no element looks through all those around it.
        self.many: Counter[str] = Counter()
        self.blocks: list[tuple[list[str], bool, int]] = []  # text, poem, how deep a root it is in

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID_TAGS:
            return
        classes = set((dict(attrs).get("class") or "").split())
        if tag == "p" and self.many["p"]:
            self.handle_endtag("p")
        noise = tag in NOISE_TAGS or bool(classes & NOISE_CLASSES) or (tag == "sup" and "reference" in classes) or bool(self.open and self.open[-1][2])
        poem = tag == "div" and "poem" in classes
        in_poem = self.many["div.poem"] > 0
        text: list[str] | None = None
        if not noise and ((tag in BLOCK_TAGS and not (tag == "p" and in_poem)) or poem):
            text = []
            depth = max((len(ROOTS) - i for i, c in enumerate(ROOTS) if self.many[f".{c}"]), default=0)
            self.blocks.append((text, "poem" in classes, depth))
        self.open.append((tag, classes, noise, text))
        self.many.update(self._names(tag, classes))

    @staticmethod
    def _names(tag: str, classes: set[str]) -> list[str]:
        """What an open element is counted as."""
        return [tag, *(["div.poem"] if tag == "div" and "poem" in classes else []), *(f".{c}" for c in ROOTS if c in classes)]

    def handle_endtag(self, tag: str) -> None:
        last = "" if self.many[tag] else tag
        while last != tag:
            last, classes, _, _ = self.open.pop()
            self.many.subtract(self._names(last, classes))

    def handle_data(self, data: str) -> None:
        if data.strip() and not (self.open and self.open[-1][2]):
            for _, _, _, text in self.open:
                if text is not None:
                    text.append(data.strip())


def _clean(html: str | None) -> list[str]:
    parser = _Blocks()
    parser.feed(html or "")
    parser.close()
    deepest = max((d for _, _, d in parser.blocks), default=0)
    out: dict[str, None] = {}
    for text, poem, depth in parser.blocks:
        joined = re.sub(r"[ \t ]+", " ", ("\n" if poem else " ").join(text))
        joined = re.sub(r"\n{3,}", "\n\n", joined).strip()
        if depth == deepest and len(joined) >= 2 and not NUMERAL_BLOCK.fullmatch(joined):
            out.setdefault(joined)
    return list(out)


@F.arrow_udf(ArrayType(StringType()))
def clean_blocks(html: pa.Array) -> pa.Array:
    """The blocks of a page's prose, each text once, without noise and bare numerals."""
    return of_each(_clean, pa.list_(pa.string()), html)


def page_units(pages: DataFrame, group: str, order: str, least: int = 180, end_marker: str | None = None) -> DataFrame:
    """Units of pages (group, order, title, blocks): a heading and the pieces of its blocks, pages under ``least`` characters left out.

    (group, chapter, ordinal, unit_id, kind, source)."""
    cleared = F.filter("blocks", lambda b: ~F.startswith(F.regexp_replace(b, r"\s+", " "), F.lit(RIGHTS_TEMPLATE)))
    leaf = F.replace(F.substring_index("title", "/", -1), F.lit("_"), F.lit(" "))
    takes_first = (F.lower(leaf) == "до") & (F.size("blocks") > 0)
    rest = F.when(takes_first, F.slice("blocks", 2, F.greatest(F.size("blocks") - 1, F.lit(0)))).otherwise(F.col("blocks"))
    headed = pages.withColumn("blocks", cleared).withColumn("heading", F.when(takes_first, F.try_element_at("blocks", F.lit(1))).otherwise(leaf)).withColumn("blocks", rest)
    repeats = (F.size("blocks") > 0) & (normalized(F.try_element_at("blocks", F.lit(1))) == normalized(F.col("heading")))
    found = headed.withColumn("blocks", F.when(repeats, F.slice("blocks", 2, F.greatest(F.size("blocks") - 1, F.lit(0)))).otherwise(F.col("blocks")))
    if end_marker:
        at = F.array_position(F.transform("blocks", lambda b: F.contains(F.regexp_replace(b, r"\s+", " "), F.lit(end_marker))), True)
        before = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        found = (
            found.withColumn("_at", at)
            .withColumn("_over", F.coalesce(F.max(F.col("_at") > 0).over(before), F.lit(False)))
            .filter(~F.col("_over"))
            .withColumn("blocks", F.when(F.col("_at") > 0, F.slice("blocks", F.lit(1), F.col("_at").cast("int"))).otherwise(F.col("blocks")))
        )
    chars = F.aggregate("blocks", F.lit(0), lambda s, b: s + F.length(b))
    # pages are numbered before the short ones go, as a filter below the window would work the blocks out a second time
    so_far = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    long = F.coalesce(F.col("_chars") >= least, F.lit(False))
    numbered = found.withColumn("_chars", chars).withColumn("blocks", F.when(long, F.col("blocks"))).withColumn("chapter", F.count_if(long).over(so_far).cast("int"))
    chapters = numbered.filter(long)
    pieces = F.flatten(F.transform("blocks", lambda b: split_long_block(b)))
    return (
        chapters.select(group, "chapter", F.posexplode(F.concat(F.array("heading"), pieces)).alias("ordinal", "source"))
        .withColumn("kind", F.when(F.col("ordinal") == 0, "heading").otherwise("paragraph"))
        .withColumn("unit_id", unit_id(F.col("chapter"), F.col("ordinal"), 3))
    )


def ancestors(title: Column) -> Column:
    """All proper prefixes of a title that end before a slash."""
    parts = F.split(title, "/")
    n = F.size(parts)
    return F.when(n > 1, F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))).otherwise(F.array().cast("array<string>"))


def children(titles: DataFrame, roots: DataFrame, title: str = "title") -> DataFrame:
    """(parent, title): titles that stand directly under one of the roots."""
    parent = F.regexp_extract(F.col(title), "^(.*)/[^/]+$", 1)
    return titles.select(title).distinct().withColumn("parent", parent).join(roots.select(F.col(title).alias("parent")).distinct(), "parent", "left_semi").filter(F.col("parent") != "")


def terminals(titles: DataFrame, title: str = "title") -> DataFrame:
    """Titles under which no other title stands: a join by prefix, as an equal join with the prefixes of all titles."""
    above = titles.select(F.explode(ancestors(F.col(title))).alias(title)).distinct()
    return titles.select(title).distinct().join(above, title, "left_anti")


# Words that number a part. The first one that a leaf holds counts.
ORDINAL_WORDS = [
    ("от автора", 0), ("первая", 1), ("первый", 1), ("первое", 1), ("вторая", 2), ("второй", 2), ("второе", 2), ("третья", 3), ("третий", 3), ("третье", 3),
    ("четвертая", 4), ("четвертое", 4), ("пятая", 5), ("шестая", 6), ("седьмая", 7), ("восьмая", 8), ("девятая", 9), ("десятая", 10), ("одиннадцатая", 11),
    ("двенадцатая", 12), ("эпилог", 90), ("erste", 1), ("zweite", 2), ("dritte", 3), ("vierte", 4), ("fünfte", 5), ("sechste", 6), ("siebente", 7), ("siebte", 7),
    ("achte", 8), ("neunte", 9), ("zehnte", 10), ("elfte", 11), ("zwölfte", 12), ("dreizehnte", 13), ("vierzehnte", 14), ("fünfzehnte", 15), ("sechzehnte", 16),
    ("siebzehnte", 17), ("achtzehnte", 18), ("α", 1), ("β", 2), ("γ", 3), ("δ", 4), ("ε", 5), ("στ", 6), ("ζ", 7), ("η", 8), ("θ", 9), ("ι", 10),
]


def leaf_of(title: Column) -> Column:
    """What stands after a title's last slash, by which it is sorted."""
    return F.replace(F.lower(F.substring_index(title, "/", -1)), F.lit("ё"), F.lit("е"))


def title_number(title: Column) -> Column:
    """The number in a title's leaf: by word, as a roman numeral, or its first digits; null if there is none."""
    leaf = leaf_of(title)
    word = F.coalesce(*[F.when(F.regexp_like(leaf, F.lit(rf"(?U)(?<!\w){w}(?!\w)")), F.lit(v)) for w, v in ORDINAL_WORDS])
    digits = F.regexp_extract(leaf, r"\d+", 0)
    return F.coalesce(word, roman_value(leaf), F.when(digits != "", digits.try_cast("bigint")))


def in_title_order(titles: DataFrame, title: str = "title", group: str | None = None, ties: tuple[str, ...] = ()) -> DataFrame:
    """titles with ``place``: numbered ones by number and leaf, then the others by leaf; ``ties`` decide between equal titles.

    The table is range-sorted, by group first if there is one, and numbered by the counts of its parts, so that no group is one task's."""
    keys = {"_number": title_number(F.col(title)), "_leaf": leaf_of(F.col(title)), "_title": F.col(title)} | {f"_tie{i}": F.col(c) for i, c in enumerate(ties)}
    by = [*([F.col(group).asc()] if group else []), F.col("_number").asc_nulls_last(), *[F.col(n).asc() for n in keys if n != "_number"]]
    width = int(titles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # what is sorted is kept, as the counts of its parts must be those of the rows that are numbered
    placed = kept(titles.withColumns(keys).repartitionByRange(width, *by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()).drop(*keys))
    counts = placed.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.count("*").alias("_n"))
    starts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    numbered = placed.withColumn("_part", F.shiftright("_at", 33)).join(F.broadcast(starts.drop("_n")), "_part")
    numbered = numbered.withColumn("place", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_at", "_part", "_before")
    if group is None:
        return numbered
    first = numbered.groupBy(F.col(group).alias("_group")).agg(F.min("place").alias("_first"))
    return numbered.join(first, F.col(group).eqNullSafe(F.col("_group"))).withColumn("place", F.col("place") - F.col("_first") + 1).drop("_group", "_first")


def crawled(titles: DataFrame, links: DataFrame, roots: DataFrame, most_depth: int = 4, most_pages: int = 240) -> DataFrame:
    """(root, title, depth, place): the landed pages that a crawl from each root visits, in its order.

    titles (title), links (title, target, position), roots (root). A page's children are the pages right under it that it, or its
    root, links to: first those that it links to itself, in order, then the root's others. Pages at most_depth aren't opened, and
    after most_pages pages of a root the crawl ends, parents before children, children in order."""
    known = links.join(titles.select(F.col("title").alias("target")).distinct(), "target", "left_semi")
    direct = F.regexp_extract("target", "^(.*)/[^/]+$", 1)
    level = roots.select("root", F.col("root").alias("title"), F.lit(0).alias("depth"), F.array(F.lit(0).cast("long")).alias("path"))
    found = level
    for depth in range(1, most_depth + 1):
        own = level.join(known.withColumn("_parent", direct).filter(F.col("_parent") == F.col("title")).drop("_parent"), "title")
        own = own.select("root", F.col("target").alias("title"), "path", F.struct(F.lit(0).alias("by"), F.col("position").cast("long").alias("at")).alias("rank"))
        of_root = known.select(F.col("title").alias("root"), "target", F.col("position").cast("long").alias("at"), direct.alias("title"))
        more = level.filter(F.col("title") != F.col("root")).join(of_root, ["root", "title"])
        more = more.select("root", F.col("target").alias("title"), "path", F.struct(F.lit(1).alias("by"), "at").alias("rank"))
        # each child once, where it comes first
        first = own.unionByName(more).groupBy("root", "title").agg(F.min(F.struct("path", "rank")).alias("m"))
        place = F.row_number().over(Window.partitionBy("root", "m.path").orderBy("m.rank", "title"))
        level = kept(first.select("root", "title", F.lit(depth).alias("depth"), F.concat("m.path", F.array(place.cast("long"))).alias("path")))
        found = found.unionByName(level)
    order = Window.partitionBy("root").orderBy("path")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most_pages).select("root", "title", "depth", "place")


def page_counts(pages: DataFrame) -> DataFrame:
    """pages with n_blocks and n_chars of their blocks."""
    chars = F.aggregate("blocks", F.lit(0).cast("long"), lambda n, b: n + F.length(b))
    return pages.withColumn("n_blocks", F.size("blocks")).withColumn("n_chars", chars)


def without_first_blocks(pages: DataFrame, n: int, order: str = "place") -> DataFrame:
    """pages whose first page (of place 1) has lost its first n blocks."""
    rest = F.slice("blocks", F.lit(n + 1), F.greatest(F.size("blocks") - n, F.lit(0)))
    return pages.withColumn("blocks", F.when(F.col(order) == 1, rest).otherwise(F.col("blocks")))


class _Chapters(HTMLParser):
    """The divisions of class chapter: their headings, the markup and text of what stands in them, and their images."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[str] = []
        self.many: Counter[str] = Counter()
        self.chapter_at: int | None = None
        self.chapters: list[dict] = []
        self.node: dict | None = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        given = dict(attrs)
        if tag == "div" and self.chapter_at is None and "chapter" in (given.get("class") or "").split():
            self.chapter_at = len(self.open)
            self.chapters.append({"nodes": [], "images": []})
        elif self.chapter_at is not None:
            if tag == "img":
                before = [n for n in self.chapters[-1]["nodes"] if n["tag"] == "p" and n is not self.node]
                self.chapters[-1]["images"].append((given.get("src") or "", len(before), "".join(before[-1]["text"]).strip() if before else ""))
            if self.node is None and len(self.open) == self.chapter_at + 1 and tag not in VOID_TAGS:
                self.node = {"tag": tag, "depth": len(self.open), "markup": [], "text": []}
                self.chapters[-1]["nodes"].append(self.node)
            if self.node is not None:
                # only what the text needs stays of the attributes
                kept_ = "".join(f' {k}="{escape(v or "")}"' for k, v in attrs if k in KEPT_ATTRIBUTES)
                self.node["markup"].append(f"<{tag}{kept_}>")
        if tag not in VOID_TAGS:
            self.open.append(tag)
            self.many[tag] += 1

    def handle_endtag(self, tag: str) -> None:
        if not self.many[tag]:
            return
        while self.open:
            last = self.open.pop()
            self.many[last] -= 1
            if self.node is not None:
                self.node["markup"].append(f"</{last}>")
                if len(self.open) == self.node["depth"]:
                    self.node = None
            if self.chapter_at is not None and len(self.open) == self.chapter_at:
                self.chapter_at = None
            if last == tag:
                return

    def handle_data(self, data: str) -> None:
        if self.node is not None:
            self.node["markup"].append(escape(data, quote=False))
            self.node["text"].append(data)


#: Attributes that a chapter's markup keeps.
KEPT_ATTRIBUTES = ("class", "id", "href")


def _chapters(html: str | None) -> list[dict]:
    parser = _Chapters()
    parser.feed(html or "")
    parser.close()
    return [c for c in parser.chapters if any(n["tag"] in ("h2", "h3") for n in c["nodes"])]


def html_chapters(documents: DataFrame, pinned: DataFrame) -> DataFrame:
    """Paragraphs of documents (url, html) by chapter: url, chapter, number (its heading), ordinal, role, source_html, source, source_sha256.

    A document whose hash isn't the pinned one (url, sha256) is an error, and so is one that isn't pinned."""
    changed = F.raise_error(F.concat(F.lit("SOURCE_CHANGED "), F.col("url")))
    own = F.sha2("html", 256)
    checked = documents.join(F.broadcast(pinned.select("url", F.col("sha256").alias("_pinned"))), "url", "left").select(
        "url", F.when(own.eqNullSafe(F.col("_pinned")), F.col("html")).otherwise(changed.cast("string")).alias("html")
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for url, html in zip(frame["url"], frame["html"], strict=True):
                for i, chapter in enumerate(_chapters(html)):
                    heads = [n for n in chapter["nodes"] if n["tag"] == "h2"]
                    if not heads:
                        continue
                    nodes = [n for n in chapter["nodes"] if n["tag"] not in ("h2", "hr") and "".join(n["text"]).strip()]
                    for k, n in enumerate(nodes):
                        row = {"url": url, "chapter": i + 1, "number": "".join(heads[0]["text"]).strip(), "ordinal": k, "role": "heading" if n["tag"] == "h3" else "body"}
                        yield pd.DataFrame([row | {"source_html": "".join(n["markup"]), "source": "".join(n["text"])}])

    found = checked.mapInPandas(run, "url string, chapter int, number string, ordinal int, role string, source_html string, source string")
    return found.withColumn("source_sha256", F.sha2("source_html", 256))


def image_anchors(documents: DataFrame) -> DataFrame:
    """Images of chapters: url, chapter, asset (the file's name without its ending), anchor (the text of the paragraph before), fraction
    (that paragraph's place among the chapter's paragraphs; 0 without one)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for url, html in zip(frame["url"], frame["html"], strict=True):
                for i, chapter in enumerate(_chapters(html)):
                    paragraphs = sum(n["tag"] == "p" for n in chapter["nodes"])
                    for src, before, anchor in chapter["images"]:
                        asset = re.sub(r"\.[^.]*$", "", src.rsplit("/", 1)[-1])
                        yield pd.DataFrame({"url": [url], "chapter": [i + 1], "asset": [asset], "anchor": [anchor], "fraction": [before / paragraphs if paragraphs else 0.0]})

    return documents.select("url", "html").mapInPandas(run, "url string, chapter int, asset string, anchor string, fraction double")


def sources_of(html: Column, attribute: str = "src") -> Column:
    """The values of an attribute in a page, in order."""
    return F.regexp_extract_all(html, F.lit(rf'{attribute}="([^"]*)"'), F.lit(1))
