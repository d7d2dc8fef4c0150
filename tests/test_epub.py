"""Books written as EPUB files and read again."""

from __future__ import annotations

import io
import uuid
import xml.etree.ElementTree as ET
import zipfile

from pyspark.sql import functions as F

from corpusloom.sources import epub, readers


def test_epub(spark, tmp_path):
    units = spark.createDataFrame(
        [(7, 1, 0, "heading", "I <one>"), (7, 1, 1, "paragraph", "a & b\nc"), (7, 2, 2, "paragraph", None), (8, 1, 0, "paragraph", "x")],
        "rank int, chapter int, ordinal int, kind string, translation string",
    )
    books = spark.createDataFrame([(7, "T & T", "A", "it"), (8, "U", "B", "it")], "rank int, title string, author string, language string")
    found = {r["rank"]: bytes(r["content"]) for r in epub.epubs(units, books).collect()}
    assert set(found) == {7, 8} and found == {r["rank"]: bytes(r["content"]) for r in epub.epubs(units, books).collect()}
    with zipfile.ZipFile(io.BytesIO(found[7])) as z:
        assert z.infolist()[0].filename == "mimetype" and z.infolist()[0].compress_type == zipfile.ZIP_STORED
        for name in z.namelist()[1:]:
            ET.fromstring(z.read(name))
        text = z.read("OEBPS/chapter-001.xhtml").decode()
    assert '<p class="subhead">I &lt;one&gt;</p><p>a &amp; b<br/>c</p>' in text
    (tmp_path / "7.epub").write_bytes(found[7])
    with zipfile.ZipFile(tmp_path / "bad.epub", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("mimetype", "application/epub+zip")
    wrong = epub.container_violations(readers.archive_members(spark, str(tmp_path))).collect()
    assert {tuple(r) for r in wrong} == {("bad.epub", "not mimetype_stored"), ("bad.epub", "not container_there")}


def test_identifier(spark):
    got = spark.range(1).select(epub.identifier(F.lit("x:é"))).first()[0]
    assert got == str(uuid.uuid5(uuid.NAMESPACE_URL, "x:é"))
