"""Whole books as tables of members, their archives, and what is wrong with archives: markup page by page, links as joins."""

from __future__ import annotations

import io
import posixpath
import zipfile
from collections.abc import Iterator
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import detectors as D
from corpusloom.functions.rows import given_back, of_each
from corpusloom.functions.text import escaped, known, padded, paragraph_html
from corpusloom.operators.lineage import kept
from corpusloom.sources.epub import MIMETYPE, _CONTAINER, container_violations, identifier, page

XHTML, CSS = "application/xhtml+xml", "text/css"
STYLE = "html{font-size:100%}body{line-height:1.5;margin:5%}p{margin:.35em 0;text-indent:1.2em;text-align:justify}h1,h2{text-align:center;break-after:avoid}figure{text-align:center;break-inside:avoid}figure img{max-width:100%}"
MEMBER = "path string, position int, stored boolean, content binary"
MEMBER_TYPES = {"path": pa.string(), "position": pa.int32(), "stored": pa.bool_(), "content": pa.binary()}
#: Members, and bytes of them, that are handed back at once.
MEMBER_ROWS, MEMBER_BYTES = 4096, 8 << 20
#: The whole length ratio of translations and sources that a book may have.
LEAST_RATIO, MOST_RATIO = 0.55, 1.65


# ---------------------------------------------------------------- making


def chapter_pages(units: DataFrame, label: str = "Chapter") -> DataFrame:
    """(rank, place, id, title, body) of units (rank, chapter, ordinal, kind, translation, and image: the name of one that stands for the unit)."""
    has = "image" in units.columns
    image = F.col("image") if has else F.lit(None).cast("string")
    said = known(F.col("translation"))
    figure = F.concat(F.lit('<figure><img src="../images/'), escaped(image), F.lit('" alt="'), escaped(said), F.lit('"/><figcaption>'), escaped(said), F.lit("</figcaption></figure>"))
    listed = F.array_sort(F.collect_list(F.struct("ordinal", F.when(image.isNotNull(), figure).otherwise(paragraph_html(F.col("kind"), said)).alias("html"))))
    title = F.concat(F.lit(f"{label} "), F.col("chapter").cast("string"))
    body = F.concat(F.lit("<section><h1>"), title, F.lit("</h1>"), F.array_join(F.transform("units", lambda u: u["html"]), ""), F.lit("</section>"))
    chapters = units.groupBy("rank", "chapter").agg(listed.alias("units"))
    return chapters.select("rank", F.col("chapter").cast("int").alias("place"), F.concat(F.lit("chapter-"), padded(F.col("chapter"), 3)).alias("id"), title.alias("title"), body.alias("body"))


def apparatus_pages(books: DataFrame) -> DataFrame:
    """(rank, place, id, title, body) of what stands around the chapters, of books (rank, title, author, rights, citation, author_note, source_sha256); places before
    the chapters are negative, those after them come after any chapter."""
    p = lambda *x: F.concat(F.lit("<p>"), *x, F.lit("</p>"))
    e = lambda c: escaped(known(F.col(c)))
    uuid = identifier(F.concat_ws(":", "rank", "title", "author", "source_sha256"))
    after = 1 << 20
    made = F.array(
        *[
            F.struct(F.lit(place).alias("place"), F.lit(i).alias("id"), F.lit(title).alias("title"), F.concat(F.lit("<section><h1>"), head, F.lit("</h1>"), body, F.lit("</section>")).alias("body"))
            for place, i, title, head, body in [
                (-3, "title", "Title page", e("title"), p(e("author"))),
                (-2, "copyright", "Rights and source", F.lit("Rights and source"), F.concat(p(e("rights")), p(e("citation"), F.lit(" SHA-256: "), e("source_sha256")))),
                (-1, "author", "The author", e("author"), p(e("author_note"))),
                (after, "colophon", "Colophon", F.lit("Colophon"), p(F.lit("urn:uuid:"), uuid)),
            ]
        ]
    )
    return books.select("rank", F.explode(made).alias("p")).select("rank", "p.*")


def members(pages: DataFrame, books: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """(rank, path, position, stored, content): the members of each book's archive in their order, of pages (rank, place, id, title, body), books (rank, title,
    author, language, source_sha256) and images (rank, name, media_type, content). A page is a row from the beginning to the archive; of a book only the lists in its package
    and navigation are gathered, a line for each page."""
    rows = pages.select("rank", "place", "id", "title", F.concat(F.lit("text/"), F.col("id"), F.lit(".xhtml")).alias("href"), page(F.col("title"), F.col("body")).alias("text"))
    line = F.struct("place", "id", "href", escaped(F.col("title")).alias("title"))
    lists = rows.groupBy("rank").agg(F.array_sort(F.collect_list(line)).alias("pages"))
    about = books.select("rank", *[escaped(known(F.col(c))).alias(c) for c in ("title", "author", "language")], identifier(F.concat_ws(":", "rank", "title", "author", "source_sha256")).alias("uuid"))
    whole = about.join(lists, "rank")
    if images is not None:
        own = images.groupBy("rank").agg(F.array_sort(F.collect_list(F.struct("name", "media_type"))).alias("images"))
        whole = whole.join(own, "rank", "left")
    else:
        whole = whole.withColumn("images", F.lit(None).cast("array<struct<name:string,media_type:string>>"))
    text = lambda parts, of: F.array_join(F.transform(parts, of), "")
    item = lambda i, href, kind, more="": F.concat(F.lit('<item id="'), i, F.lit('" href="'), href, F.lit('" media-type="'), kind, F.lit(f'"{more}/>'))
    listed = F.concat(
        item(F.lit("nav"), F.lit("nav.xhtml"), F.lit(XHTML), ' properties="nav"'), item(F.lit("style"), F.lit("style.css"), F.lit(CSS)),
        text("pages", lambda x: item(x["id"], x["href"], F.lit(XHTML))),
        F.coalesce(F.array_join(F.transform("images", lambda x, i: item(F.concat(F.lit("image-"), i.cast("string")), F.concat(F.lit("images/"), escaped(x["name"])), x["media_type"])), ""), F.lit("")),
    )
    package = F.concat(
        F.lit('<?xml version="1.0" encoding="utf-8"?><package xmlns="http://www.idpf.org/2007/opf" version="3.0" unique-identifier="id"><metadata xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:identifier id="id">urn:uuid:'),
        F.col("uuid"), F.lit("</dc:identifier><dc:title>"), F.col("title"), F.lit("</dc:title><dc:creator>"), F.col("author"), F.lit("</dc:creator><dc:language>"), F.col("language"), F.lit("</dc:language></metadata><manifest>"),
        listed, F.lit("</manifest><spine>"), text("pages", lambda x: F.concat(F.lit('<itemref idref="'), x["id"], F.lit('"/>'))), F.lit("</spine></package>"),
    )
    toc = text("pages", lambda x: F.concat(F.lit('<li><a href="'), x["href"], F.lit('">'), x["title"], F.lit("</a></li>")))
    nav = page(F.lit("Contents"), F.concat(F.lit('<nav epub:type="toc"><ol>'), toc, F.lit("</ol></nav>")))
    fixed = [("mimetype", F.lit(MIMETYPE)), ("META-INF/container.xml", F.lit(_CONTAINER)), ("OEBPS/package.opf", package), ("OEBPS/nav.xhtml", nav), ("OEBPS/style.css", F.lit(STYLE))]
    head = whole.select("rank", F.explode(F.array(*[F.struct(F.lit(n).alias("path"), F.lit(i).alias("position"), F.lit(not i).alias("stored"), t.cast("binary").alias("content")) for i, (n, t) in enumerate(fixed)])).alias("m")).select("rank", "m.*")
    base, images_at = 1 << 10, 1 << 24
    texts = rows.select("rank", F.concat(F.lit("OEBPS/"), "href").alias("path"), (F.col("place") + base).alias("position"), F.lit(False).alias("stored"), F.col("text").cast("binary").alias("content"))
    found = head.unionByName(texts)
    if images is not None:
        found = found.unionByName(images.select("rank", F.concat(F.lit("OEBPS/images/"), "name").alias("path"), F.lit(images_at).alias("position"), F.lit(False).alias("stored"), "content"))
    return found


def archived(rows: DataFrame) -> DataFrame:
    """(rank, content): one archive of each book's members, in their order; the same members are the same bytes. A book is one file by its format."""

    def run(book: pa.Table) -> pa.Table:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            places = sorted(zip(book["position"].to_pylist(), book["path"].to_pylist(), range(len(book)), strict=True))
            for _, path, i in places:
                info = zipfile.ZipInfo(path, (2000, 1, 1, 0, 0, 0))
                info.compress_type = zipfile.ZIP_STORED if book["stored"][i].as_py() else zipfile.ZIP_DEFLATED
                z.writestr(info, book["content"][i].as_py())
        return pa.table({"rank": book["rank"].slice(0, 1), "content": pa.array([out.getvalue()], pa.binary())})

    return rows.select("rank", "path", "position", "stored", "content").groupBy("rank").applyInArrow(run, f"rank {rows.schema['rank'].dataType.simpleString()}, content binary")


# ---------------------------------------------------------------- checking


def opened(archives: DataFrame, key: str = "rank") -> DataFrame:
    """(key, path, position, stored, content) of archives (key, content): each member is a row, and all that follows is by member."""
    kind = archives.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners: list[int] = []
            found: dict[str, list] = {name: [] for name in MEMBER_TYPES}
            held = 0

            def out() -> pa.RecordBatch:
                own = batch.column(0).take(pa.array(owners, pa.int64()))  # noqa: B023
                return pa.RecordBatch.from_arrays([own, *[pa.array(found[n], t) for n, t in MEMBER_TYPES.items()]], names=[key, *MEMBER_TYPES])  # noqa: B023

            for at in range(len(batch)):
                with zipfile.ZipFile(io.BytesIO(batch.column(1)[at].as_py())) as z:
                    for i, info in enumerate(z.infolist()):
                        content = z.read(info)
                        owners.append(at)
                        for name, value in zip(MEMBER_TYPES, (info.filename, i, info.compress_type == zipfile.ZIP_STORED, content), strict=True):
                            found[name].append(value)
                        held += len(content)
                        if held > MEMBER_BYTES or len(owners) >= MEMBER_ROWS:
                            yield out()
                            owners, found, held = [], {name: [] for name in MEMBER_TYPES}, 0
            if owners:
                yield out()
        given_back()

    return archives.select(key, "content").mapInArrow(run, f"{key} {kind}, {MEMBER}")


def _read(content: bytes, path: str) -> tuple[str | None, list[tuple[str, str, str | None]]]:
    """The first error of a member's markup, and what it refers to: (kind, target, id), by one pass of a streaming parser."""
    found: list[tuple[str, str, str | None]] = []
    folder = posixpath.dirname(path)

    def start(tag: str, attrs: dict) -> None:
        name = tag.rsplit(":", 1)[-1]
        if path.endswith(".opf"):
            if name == "item":
                found.append(("item", posixpath.normpath(posixpath.join(folder, attrs.get("href", ""))), attrs.get("id")))
            elif name == "itemref":
                found.append(("itemref", attrs.get("idref", ""), None))
            return
        if name == "rootfile":
            found.append(("rootfile", posixpath.normpath(attrs.get("full-path", "")), None))
        for attribute in ("src", "href"):
            target = attrs.get(attribute, "")
            if target and "://" not in target and not target.startswith(("#", "mailto:", "data:")):
                found.append(("link", posixpath.normpath(posixpath.join(folder, target.split("#")[0])), None))

    parser = expat.ParserCreate()
    parser.StartElementHandler = start
    try:
        for i in range(0, len(content), 1 << 16):
            parser.Parse(content[i : i + (1 << 16)], False)
        parser.Parse(b"", True)
    except expat.ExpatError as e:
        return f"{expat.ErrorString(e.code)} at line {e.lineno}", found
    return None, found


def markup(rows: DataFrame, key: str = "rank") -> DataFrame:
    """(key, path, error, refs) of the members (key, path, content) that are markup: the first error, null if there is none, and what is referred to."""

    ref = pa.struct([("kind", pa.string()), ("target", pa.string()), ("id", pa.string())])
    kind = pa.struct([("error", pa.string()), ("refs", pa.list_(ref))])

    def read(content: bytes, path: str) -> dict:
        error, refs = _read(content, path)
        return {"error": error, "refs": [{"kind": k, "target": t, "id": i} for k, t, i in refs]}

    @F.arrow_udf("error string, refs array<struct<kind:string,target:string,id:string>>")
    def checked(content: pa.Array, path: pa.Array) -> pa.Array:
        return of_each(read, kind, content, path)

    return rows.filter(F.regexp_like("path", F.lit(r"\.(?:xhtml|opf|xml)$"))).select(key, "path", checked("content", "path").alias("c")).select(key, "path", "c.*")


def book_violations(rows: DataFrame, key: str = "rank") -> DataFrame:
    """(key, path, violation) of the members of books: containers, markup, and links between members as joins.

    * epub_mimetype_rule: the first member isn't mimetype, or it is compressed, or says something else; other container_violations under their names;
    * xml: a member's markup isn't well-formed;
    * missing: what a package lists, a container names or a page links to isn't there; unlisted: a page that no package lists;
    * no_item: a spine names what isn't listed; unreachable: a page of the spine that the navigation doesn't link to."""
    # each member's markup is read once for all that is asked of it
    marked = kept(markup(rows, key))
    container = container_violations(rows.withColumnRenamed(key, "asset").withColumn("safe", ~F.regexp_like("path", F.lit(r"(?:^/|\\|(?:^|/)\.\.?(?:/|$))")))).withColumnRenamed("asset", key)
    rule = F.when(F.startswith("violation", F.lit("not mimetype")), "epub_mimetype_rule").otherwise(F.col("violation"))
    out = container.select(key, F.lit("").alias("path"), rule.alias("violation")).distinct()
    out = out.unionByName(marked.filter("error is not null").select(key, "path", F.lit("xml").alias("violation")))
    refs = marked.select(key, "path", F.explode("refs").alias("r")).select(key, "path", "r.*")
    there = rows.select(key, F.col("path").alias("target")).distinct()
    out = out.unionByName(refs.filter("kind in ('item', 'rootfile', 'link')").join(there, [key, "target"], "left_anti").select(key, F.col("target").alias("path"), F.lit("missing").alias("violation")).distinct())
    items = refs.filter("kind = 'item'").select(key, "target", "id")
    pages = rows.filter(F.endswith("path", F.lit(".xhtml"))).select(key, "path")
    out = out.unionByName(pages.join(items.select(key, F.col("target").alias("path")), [key, "path"], "left_anti").select(key, "path", F.lit("unlisted").alias("violation")))
    spine = refs.filter("kind = 'itemref'").select(key, F.col("target").alias("id"))
    out = out.unionByName(spine.join(items, [key, "id"], "left_anti").select(key, F.col("id").alias("path"), F.lit("no_item").alias("violation")))
    linked = refs.filter("kind = 'link'").join(marked.filter(F.endswith("path", F.lit("nav.xhtml"))).select(key, "path"), [key, "path"], "left_semi").select(key, "target").distinct()
    return out.unionByName(spine.join(items, [key, "id"]).join(linked, [key, "target"], "left_anti").select(key, F.col("target").alias("path"), F.lit("unreachable").alias("violation")))


def book_qa(units: DataFrame, books: DataFrame, violations: DataFrame) -> DataFrame:
    """Per book (rank, expected_chapters): chapters, units, length_ratio, risks, failures (sorted names) and status."""
    s, t = F.col("source"), F.col("translation")
    formed, forms = D.prepared(units)
    counted = formed.select("rank", "chapter", F.length(known(s)).alias("s"), F.length(known(t)).alias("t"), D.empty(t).alias("empty"), ((F.col("kind") != "heading") & D.translation_risk(s, t, forms)).alias("risk"))
    sums = counted.groupBy("rank").agg(F.countDistinct("chapter").alias("chapters"), F.count("*").alias("units"), F.count_if("empty").alias("empty"), F.count_if("risk").alias("risks"), (F.sum("t") / F.greatest(F.lit(1), F.sum("s"))).alias("ratio"))
    wrong = violations.groupBy("rank").agg(F.collect_set(F.when(F.col("path") == "", F.col("violation")).otherwise(F.concat_ws(":", "violation", "path"))).alias("wrong"))
    found = books.select("rank", "expected_chapters").join(sums, "rank", "left").join(wrong, "rank", "left").na.fill(0, ["chapters", "units", "empty", "risks"])
    own = D.named(
        ("chapter_count", F.col("chapters") != F.col("expected_chapters")), ("empty_translations", F.col("empty") > 0), ("translation_length_ratio", ~F.coalesce(F.col("ratio").between(LEAST_RATIO, MOST_RATIO), F.lit(False)))
    )
    failures = F.array_sort(F.concat(own, F.coalesce("wrong", F.array().cast("array<string>"))))
    return found.select("rank", "chapters", "units", F.round("ratio", 6).alias("length_ratio"), "risks", failures.alias("failures"), F.when(F.size(failures) == 0, "PASS").otherwise("FAIL").alias("status"))
