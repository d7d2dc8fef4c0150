"""Books as EPUB files: pages are built by Spark, a book's files are put into one archive by one small function."""

from __future__ import annotations

import io
import posixpath
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import escaped, known, padded, paragraph_html

MIMETYPE = "application/epub+zip"
_CONTAINER = (
    '<?xml version="1.0"?><container version="1.0" xmlns="urn:oasis:names:tc:opendocument:xmlns:container">'
    '<rootfiles><rootfile full-path="OEBPS/package.opf" media-type="application/oebps-package+xml"/></rootfiles></container>'
)
_XHTML = '<?xml version="1.0" encoding="utf-8"?><html xmlns="http://www.w3.org/1999/xhtml" xmlns:epub="http://www.idpf.org/2007/ops"><head><title>'


def page(title: Column, body: Column) -> Column:
    return F.concat(F.lit(_XHTML), escaped(title), F.lit("</title></head><body>"), body, F.lit("</body></html>"))


def identifier(name: Column, space: str = "6ba7b8119dad11d180b400c04fd430c8") -> Column:
    """A name-based UUID (version 5) of name in a name space, as text."""
    h = F.sha1(F.concat(F.unhex(F.lit(space)), F.encode(name, "utf-8")))
    # the version is 5, and the first two bits of the fourth group are 10
    variant = F.element_at(F.split(F.lit("8 9 a b"), " "), F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def pages(units: DataFrame) -> DataFrame:
    """(rank, chapter, title, file, xhtml) of units (rank, chapter, ordinal, kind, translation)."""
    listed = F.array_sort(F.collect_list(F.struct("ordinal", "kind", known(F.col("translation")).alias("text"))))
    chapters = units.groupBy("rank", "chapter").agg(listed.alias("units"))
    title = F.coalesce(F.try_element_at(F.filter("units", lambda u: u["kind"] == "heading"), F.lit(1))["text"], F.concat(F.lit("Chapter "), "chapter"))
    body = F.array_join(F.transform("units", lambda u: paragraph_html(u["kind"], u["text"])), "")
    return chapters.select("rank", "chapter", title.alias("title"), F.concat(F.lit("chapter-"), padded(F.col("chapter"), 3), F.lit(".xhtml")).alias("file"), page(title, body).alias("xhtml"))


def epubs(units: DataFrame, books: DataFrame) -> DataFrame:
    """(rank, content): an EPUB 3 file for each book (rank, title, author, language) with units. One book is one archive."""
    whole = pages(units).join(books.select("rank", F.col("title").alias("book"), "author", "language", identifier(F.concat_ws(":", "rank", "title", "author")).alias("uuid")), "rank")
    safe = whole.withColumns({c: escaped(F.col(c)) for c in ("title", "book", "author", "language")})

    def archive(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("chapter")
        book = frame.iloc[0]
        items = "".join(f'<item id="c{r.chapter}" href="{r.file}" media-type="application/xhtml+xml"/>' for r in frame.itertuples())
        spine = "".join(f'<itemref idref="c{r.chapter}"/>' for r in frame.itertuples())
        toc = "".join(f'<li><a href="{r.file}">{r.title}</a></li>' for r in frame.itertuples())
        package = (
            '<?xml version="1.0" encoding="utf-8"?><package xmlns="http://www.idpf.org/2007/opf" version="3.0" unique-identifier="id">'
            f'<metadata xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:identifier id="id">urn:uuid:{book.uuid}</dc:identifier><dc:title>{book.book}</dc:title>'
            f"<dc:creator>{book.author}</dc:creator><dc:language>{book.language}</dc:language></metadata>"
            f'<manifest><item id="nav" href="nav.xhtml" media-type="application/xhtml+xml" properties="nav"/>{items}</manifest><spine>{spine}</spine></package>'
        )
        nav = f'{_XHTML}{book.book}</title></head><body><nav epub:type="toc"><ol>{toc}</ol></nav></body></html>'
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            # a fixed date, so that the same book is the same bytes
            for name, text in [("mimetype", MIMETYPE), ("META-INF/container.xml", _CONTAINER), ("OEBPS/package.opf", package), ("OEBPS/nav.xhtml", nav), *((f"OEBPS/{r.file}", r.xhtml) for r in frame.itertuples())]:
                info = zipfile.ZipInfo(name, (2000, 1, 1, 0, 0, 0))
                info.compress_type = zipfile.ZIP_STORED if name == "mimetype" else zipfile.ZIP_DEFLATED
                z.writestr(info, text)
        return pd.DataFrame({"rank": [book["rank"]], "content": [out.getvalue()]})

    return safe.groupBy("rank").applyInPandas(archive, f"rank {books.schema['rank'].dataType.simpleString()}, content binary")


#: The least bytes, width and height of an image that is kept.
LEAST_BYTES, LEAST_SIDE = 1200, 180


def _sides(data: bytes) -> tuple[int, int] | None:
    """Width and height of a PNG, GIF or JPEG file by its header."""
    if data.startswith(b"\x89PNG\r\n\x1a\n") and len(data) >= 24:
        return int.from_bytes(data[16:20]), int.from_bytes(data[20:24])
    if data[:6] in (b"GIF87a", b"GIF89a") and len(data) >= 10:
        return int.from_bytes(data[6:8], "little"), int.from_bytes(data[8:10], "little")
    if data.startswith(b"\xff\xd8"):
        at = 2
        while at + 9 < len(data) and data[at] == 0xFF:
            kind = data[at + 1]
            if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                return int.from_bytes(data[at + 7 : at + 9]), int.from_bytes(data[at + 5 : at + 7])
            at += 2 + int.from_bytes(data[at + 2 : at + 4])
    return None


def images(files: DataFrame) -> DataFrame:
    """Images that EPUB files (asset, content) list, without covers and small ones: asset, place (from 1), name, media_type, member,
    width, height, content, sha256. An archive without a container or a package has none."""

    def listed(z: zipfile.ZipFile) -> Iterator[tuple[str, str, str]]:
        names = set(z.namelist())
        root = ElementTree.fromstring(z.read("META-INF/container.xml")).find(".//{*}rootfile")
        if root is None or root.get("full-path", "") not in names:
            return
        for item in ElementTree.fromstring(z.read(root.get("full-path"))).iterfind(".//{*}manifest/{*}item"):
            href = item.get("href", "")
            member = posixpath.normpath(posixpath.join(posixpath.dirname(root.get("full-path")), href))
            cover = "cover-image" in item.get("properties", "") or "cover" in href.casefold()
            if item.get("media-type", "").startswith("image/") and not cover and member in names:
                yield href, item.get("media-type"), member

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for asset, content in zip(frame["asset"], frame["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    if "META-INF/container.xml" not in z.namelist():
                        continue
                    place = 0
                    for href, media, member in listed(z):
                        data = z.read(member)
                        sides = _sides(data)
                        if len(data) < LEAST_BYTES or sides is None or min(sides) < LEAST_SIDE:
                            continue
                        place += 1
                        name = f"historical-{place:03d}{posixpath.splitext(href)[1].lower() or '.jpg'}"
                        yield pd.DataFrame({"asset": [asset], "place": [place], "name": [name], "media_type": [media], "member": [member], "width": [sides[0]], "height": [sides[1]], "content": [data]})

    found = files.select("asset", "content").mapInPandas(run, "asset string, place int, name string, media_type string, member string, width int, height int, content binary")
    return found.withColumn("sha256", F.sha2("content", 256))


def container_violations(members: DataFrame) -> DataFrame:
    """(asset, violation) of archives (asset, path, position, stored, content, safe) that are no sound EPUB containers."""
    first = F.col("position") == 0
    seen = members.groupBy("asset").agg(
        F.max(first & (F.col("path") == "mimetype")).alias("mimetype_first"),
        F.max(first & F.col("stored")).alias("mimetype_stored"),
        F.max(first & (F.col("content") == F.encode(F.lit(MIMETYPE), "utf-8"))).alias("mimetype_exact"),
        F.max(F.col("path") == "META-INF/container.xml").alias("container_there"),
        F.min("safe").alias("names_safe"),
        (F.count("*") == F.countDistinct("path")).alias("names_unique"),
    )
    checks = [c for c in seen.columns if c != "asset"]
    failed = F.array_compact(F.array(*[F.when(~F.col(c), F.lit(f"not {c}")) for c in checks]))
    return seen.select("asset", F.explode(failed).alias("violation"))
