"""Whole books: what is made of units is sound, and each thing that may be wrong with an archive is told."""

from __future__ import annotations

import io
import zipfile
from xml.etree import ElementTree

from pyspark.sql import functions as F

from corpusloom.sources import books as B


def made(spark):
    units = spark.createDataFrame(
        [(7, c, o, "heading" if o == 0 else "paragraph", f"source {c} {o} & more", f"text <{c}> {o} & more" if (c, o) != (2, 1) else "A map", "map.png" if (c, o) == (2, 1) else None) for c in (1, 2, 11) for o in range(3)],
        "rank int, chapter int, ordinal int, kind string, source string, translation string, image string",
    )
    about = spark.createDataFrame([(7, "A & B", "N. N.", "it", "all rights", "from <a> page", None, "ab12", 3)], "rank int, title string, author string, language string, rights string, citation string, author_note string, source_sha256 string, expected_chapters int")
    images = spark.createDataFrame([(7, "map.png", "image/png", bytearray(b"png"))], "rank int, name string, media_type string, content binary")
    pages = B.chapter_pages(units).unionByName(B.apparatus_pages(about))
    return units, about, B.members(pages, about, images)


def test_book_is_sound(spark):
    units, about, rows = made(spark)
    content = bytes(B.archived(rows).first()["content"])
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = z.namelist()
        assert names[0] == "mimetype" and z.getinfo("mimetype").compress_type == zipfile.ZIP_STORED
        assert names[5:] == [f"OEBPS/text/{p}.xhtml" for p in ("title", "copyright", "author", "chapter-001", "chapter-002", "chapter-011", "colophon")] + ["OEBPS/images/map.png"]
        package = ElementTree.fromstring(z.read("OEBPS/package.opf"))
        assert [i.get("idref") for i in package.iterfind(".//{*}itemref")] == ["title", "copyright", "author", "chapter-001", "chapter-002", "chapter-011", "colophon"]
        assert package.find(".//{*}title").text == "A & B"
        chapter = z.read("OEBPS/text/chapter-002.xhtml").decode()
        assert '<figure><img src="../images/map.png" alt="A map"/>' in chapter and "text &lt;2&gt; 0 &amp; more" in chapter
    opened = B.opened(B.archived(rows))
    assert opened.count() == rows.count() and B.book_violations(opened).collect() == []
    assert bytes(B.archived(rows.repartition(5)).first()["content"]) == content
    qa = B.book_qa(units, about, B.book_violations(opened)).first()
    assert (qa["chapters"], qa["units"], qa["failures"], qa["status"]) == (3, 9, [], "PASS")


def test_each_violation(spark):
    units, about, rows = made(spark)
    change = lambda path, **to: rows.withColumns({k: F.when(F.col("path") == path, v).otherwise(F.col(k)) for k, v in to.items()})
    text = lambda f: f(F.col("content").cast("string")).cast("binary")
    found = lambda r: {(x["path"], x["violation"]) for x in B.book_violations(B.opened(B.archived(r))).collect()}
    assert found(change("mimetype", stored=F.lit(False))) == {("", "epub_mimetype_rule")}
    assert found(change("mimetype", position=F.lit(99))) == {("", "epub_mimetype_rule")}
    assert found(change("mimetype", content=F.lit("text/plain").cast("binary"))) == {("", "epub_mimetype_rule")}
    assert found(change("OEBPS/text/title.xhtml", content=text(lambda t: F.concat(t, F.lit("<p>"))))) == {("OEBPS/text/title.xhtml", "xml")}
    gone = rows.filter("path <> 'OEBPS/images/map.png'")
    assert found(gone) == {("OEBPS/images/map.png", "missing")}
    assert found(change("OEBPS/package.opf", content=text(lambda t: F.regexp_replace(t, '<item id="author"[^>]*>', "")))) == {("OEBPS/text/author.xhtml", "unlisted"), ("author", "no_item")}
    assert found(change("OEBPS/nav.xhtml", content=text(lambda t: F.regexp_replace(t, '<li><a href="text/author.xhtml">[^<]*</a></li>', "")))) == {("OEBPS/text/author.xhtml", "unreachable")}
    assert ("", "not container_there") in found(rows.filter("path not like 'META%'"))
    less = units.withColumn("translation", F.when(F.col("ordinal") == 2, F.lit(" ")).otherwise(F.substring("translation", 1, 2)))
    qa = B.book_qa(less, about.withColumn("expected_chapters", F.lit(4)), B.book_violations(B.opened(B.archived(gone)))).first()
    assert qa["failures"] == ["chapter_count", "empty_translations", "missing:OEBPS/images/map.png", "translation_length_ratio"] and qa["status"] == "FAIL"
