"""Queries of book cutting, repair verdicts and landed evidence, each with its twin in DuckDB's SQL beside it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import books as B
from corpusloom.functions import text as T
from corpusloom.operators import gates, ledger, translate
from corpusloom.operators.lineage import kept
from corpusloom.plans import oracle as O
from corpusloom.plans.catalog import _table, pairs
from corpusloom.sources import books, readers

# ---------------------------------------------------------------- whether a repair is taken


def repair_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs and what might replace their translations: whether that is accepted, is better, or has run away, and what a model may give."""
    after = F.when(F.col("ordinal") % 3 == 0, F.concat("translation", F.lit(" "), "source")).when(F.col("ordinal") % 3 == 1, F.substring("translation", F.lit(1), F.floor(F.length("translation") / 2).cast("int"))).otherwise(F.repeat("translation", F.lit(3)))
    rows = pairs(spark, sf_dir).withColumn("after", after)
    s, before, a = F.col("source"), F.col("translation"), F.col("after")
    return rows.select(
        "rank", "ordinal", translate.accepted(s, before, a).alias("accepted"), translate.improves(s, before, a).alias("improves"), translate.runs_away(s, a).alias("runs_away"),
        translate.decode_limit(F.size(T.tokens(s))).cast("long").alias("most_tokens"),
    )


def _risk(s: str, t: str) -> str:
    return f"({O.omission(s, t)} OR {O.repetition(s, t)})"


def _cost(t: str) -> str:
    return f"(CASE WHEN {_risk('source', t)} THEN 2.0::DOUBLE ELSE 0 END + abs({O.ratio('source', t)} - 1.05::DOUBLE))"


REPAIR_VERDICTS = f"""WITH {O.PAIRS}, a AS (SELECT *, CASE ordinal % 3 WHEN 0 THEN translation || ' ' || source WHEN 1 THEN substring(translation, 1, length(translation) // 2) ELSE translation || translation || translation END AS after FROM bound)
SELECT rank, ordinal, NOT {O.empty('after')} AND ({_risk('source', 'translation')} OR length(coalesce(after, '')) >= 1.06::DOUBLE * length(coalesce(translation, ''))) AS accepted, {_cost('after')} < {_cost('translation')} AS improves,
length(after) > greatest(220, floor(2.4::DOUBLE * length(source))) OR length(after) < greatest(2, floor(0.18::DOUBLE * length(source))) AS runs_away,
least(384, greatest(96, 2 * len({O.tokens('source')})))::BIGINT AS most_tokens FROM a"""


# ---------------------------------------------------------------- books

_HEADING = "^CHAPTER [IVX]+$"


def book_cutting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as books of three chapters after a preface, cut into chapters, blocks, and a section between two marks."""
    text = F.concat(
        F.lit("Front\nPREFACE\n"), F.substring("text", 1, 120), F.lit("\nCHAPTER I\n"), F.replace("text", F.lit("\n"), F.lit("\n\n")), F.lit("\nCHAPTER II\n   indented one\n   and two\n\nlast\nCHAPTER III\n"), F.reverse("text"), F.lit("\nFINIS")
    )
    books = _table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 5 > 0, text).otherwise(F.concat(F.lit("CHAPTER I\n"), "text")).alias("t"))
    t, digest = F.col("t"), lambda parts: T.sha(F.array_join(parts, "\u0001"))
    return books.select(
        "doc_id",
        F.coalesce(F.size(B.chapters(t, _HEADING)), F.lit(0)).alias("chapters"),
        digest(F.coalesce(B.chapters(t, _HEADING, last=2), F.array().cast("array<string>"))).alias("last_two"),
        T.sha(F.coalesce(B.preface(t, "PREFACE", _HEADING), F.lit("none"))).alias("preface"),
        F.size(B.blocks(t)).alias("blocks"),
        digest(B.blocks(t)).alias("blocks_sha256"),
        T.sha(F.coalesce(B.section(t, "CHAPTER II", "FINIS", with_start=True, least=200), F.lit("none"))).alias("section"),
    )


_STRIP = O.stripped
_BLOCK = f"""CASE WHEN len(l) > 1 AND len(list_filter(l, lambda x: regexp_matches(x, '^\\s{{3,}}\\S'))) >= greatest(1, len(l) // 2) THEN array_to_string(f, chr(10)) ELSE array_to_string(f, ' ') END"""
BOOK_CUTTING = f"""WITH b AS (SELECT doc_id, CASE WHEN doc_id % 5 > 0 THEN 'Front' || chr(10) || 'PREFACE' || chr(10) || substring(text, 1, 120) || chr(10) || 'CHAPTER I' || chr(10) || replace(text, chr(10), chr(10) || chr(10)) || chr(10) || 'CHAPTER II' || chr(10) || '   indented one' || chr(10) || '   and two' || chr(10) || chr(10) || 'last' || chr(10) || 'CHAPTER III' || chr(10) || reverse(text) || chr(10) || 'FINIS' ELSE 'CHAPTER I' || chr(10) || text END AS t FROM documents),
cut AS (SELECT *, string_split(regexp_replace(t, '(?m)^CHAPTER [IVX]+$', chr(1) || '\\0', 'g'), chr(1)) AS p, list_transform(string_split_regex(t, '\\n\\s*\\n+'), lambda x: string_split(regexp_replace(x, '^\\n+|\\s+$', '', 'g'), chr(10))) AS raw FROM b),
lines AS (SELECT doc_id, unnest(raw) AS l, unnest(generate_series(1, len(raw))) AS i FROM cut), full_ AS (SELECT doc_id, i, l, list_filter(list_transform(l, lambda x: {_STRIP('x')}), lambda x: x <> '') AS f FROM lines),
blocks AS (SELECT doc_id, count(*) AS n, string_agg(x, chr(1) ORDER BY i) AS joined FROM (SELECT doc_id, i, {_BLOCK} AS x FROM full_) WHERE x <> '' GROUP BY doc_id),
part AS (SELECT doc_id, t, p[2:] AS p, p[1] AS front, substring(t, instr(t, 'CHAPTER II')) AS rest FROM cut),
sect AS (SELECT *, CASE WHEN instr(t, 'CHAPTER II') > 0 AND instr(rest, 'FINIS') > 0 THEN {_STRIP("substring(rest, 1, instr(rest, 'FINIS') - 1)")} END AS s FROM part)
SELECT doc_id, CASE WHEN len(p) >= 2 THEN len(p) ELSE 0 END::INT AS chapters, sha256(CASE WHEN len(p) >= 2 THEN array_to_string(p[-2:], chr(1)) ELSE '' END) AS last_two,
sha256(CASE WHEN instr(front, 'PREFACE') > 0 THEN {_STRIP("substring(front, instr(front, 'PREFACE') + 7)")} ELSE 'none' END) AS preface, coalesce(n, 0)::INT AS blocks, sha256(coalesce(joined, '')) AS blocks_sha256,
sha256(CASE WHEN length(s) >= 200 THEN s ELSE 'none' END) AS section FROM sect LEFT JOIN blocks USING (doc_id)"""


def marked_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents between the marks of a landed book, every third without the second one: what stands between them."""
    end = F.when(F.col("doc_id") % 3 > 0, F.lit("\n*** END OF THE PROJECT GUTENBERG EBOOK A BOOK ***\nafter it")).otherwise(F.lit(""))
    text = F.concat(F.lit("before it\n*** START OF THIS PROJECT GUTENBERG EBOOK A BOOK ***\n\n"), "text", end)
    rows = _table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
    return rows.withColumns(readers.between_marks()).select("doc_id", "marked", T.sha(F.coalesce("body", F.lit("none"))).alias("body_sha256"))


MARKED_BOOKS = "SELECT doc_id, doc_id % 3 > 0 AS marked, sha256(CASE WHEN doc_id % 3 > 0 THEN trim(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) ELSE 'none' END) AS body_sha256 FROM documents"


# ---------------------------------------------------------------- landed files and evidence


def landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as landed files and a manifest of them that is wrong here and there: what a verification finds."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("asset"), F.coalesce("text", F.lit("")).cast("binary").alias("content"))
    size, sha = F.length("content").cast("long"), F.sha2("content", 256)
    k = F.col("doc_id") % 11
    manifest = docs.select(
        F.when(k == 1, F.concat(F.lit("gone-"), "asset")).otherwise(F.col("asset")).alias("asset"), F.when(k == 2, size + 1).otherwise(size).alias("size"),
        F.when(k == 3, F.upper(sha)).when(k == 4, F.sha2(F.concat("content", F.lit("!").cast("binary")), 256)).otherwise(sha).alias("sha256"),
    )
    return readers.verified(docs.select("asset", "content"), manifest)


LANDED_FILES = """SELECT CASE WHEN doc_id % 11 = 1 THEN 'gone-' ELSE '' END || doc_id AS asset, CASE doc_id % 11 WHEN 1 THEN 'absent' WHEN 2 THEN 'size' WHEN 3 THEN 'malformed_hash' ELSE 'hash' END AS violation
FROM documents WHERE doc_id % 11 IN (1, 2, 4) OR (doc_id % 11 = 3 AND upper(sha256(coalesce(text, ''))) <> sha256(coalesce(text, '')))"""


def evidence_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims that documents are members of their source's archive, some of them under other hashes or names."""
    docs = _table(spark, sf_dir, "documents").select(F.coalesce("source", F.lit("none")).alias("asset"), "doc_id", F.concat(F.lit("p/"), F.col("doc_id").cast("string")).alias("path"), T.sha(T.known(F.col("text"))).alias("sha256"))
    k = F.col("doc_id") % 13
    claims = docs.select("asset", F.when(k == 5, F.concat("path", F.lit("x"))).otherwise(F.col("path")).alias("path"), F.when(k == 6, T.sha(F.concat("sha256", F.lit("?")))).otherwise(F.col("sha256")).alias("sha256"))
    return gates.evidence_violations(claims, docs.select("asset", "path", "sha256"))


EVIDENCE_CLAIMS = "SELECT coalesce(source, 'none') AS asset, 'p/' || doc_id || CASE WHEN doc_id % 13 = 5 THEN 'x' ELSE '' END AS path, CASE WHEN doc_id % 13 = 5 THEN 'absent' ELSE 'changed' END AS violation FROM documents WHERE doc_id % 13 IN (5, 6)"


def retried_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recovery ledger of all pages after a second attempt at those that weren't recovered."""
    rows = _table(spark, sf_dir, "pages").select("page_id", F.concat_ws("#", "url", F.col("page_id").cast("string")).alias("url"), T.sha(T.known(F.col("html"))).alias("sha"))
    k = F.col("page_id") % 4
    first = rows.select("url", F.when(k == 0, "FAILED").when(k == 1, "MISSING").otherwise("RECOVERED").alias("status"), F.when(k > 1, F.col("sha")).alias("sha256"))
    again = rows.select("url", F.when(F.col("page_id") % 3 == 0, "FAILED").otherwise("RECOVERED").alias("status"), F.when(F.col("page_id") % 3 > 0, T.sha(F.concat("sha", F.lit("2")))).alias("sha256"))
    return ledger.retried(first, again).select("url", "status", "sha256")


RETRIED_LEDGER = """WITH r AS (SELECT page_id, coalesce(url || '#', '') || page_id AS url, sha256(coalesce(html, '')) AS sha FROM pages)
SELECT url, CASE WHEN page_id % 4 > 1 OR page_id % 3 > 0 THEN 'RECOVERED' ELSE 'FAILED' END AS status, CASE WHEN page_id % 4 > 1 THEN sha WHEN page_id % 3 > 0 THEN sha256(sha || '2') END AS sha256 FROM r"""


# ---------------------------------------------------------------- whole books


def book_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as books of three turns a chapter, written as archives, most of them damaged in some way, opened again and judged."""
    units = pairs(spark, sf_dir).withColumns({"chapter": F.floor(F.col("ordinal") / 3).cast("int") + 1, "ordinal": F.col("ordinal").cast("int")})
    k = F.col("rank") % 7
    sums = units.groupBy("rank").agg(F.countDistinct("chapter").alias("n"))
    about = sums.select(
        "rank", F.concat(F.lit("Book <"), F.col("rank").cast("string"), F.lit(">")).alias("title"), F.lit("N. N.").alias("author"), F.lit("en").alias("language"), F.lit("none").alias("rights"), F.lit("a & b").alias("citation"),
        F.lit(None).cast("string").alias("author_note"), T.sha(F.col("rank").cast("string")).alias("source_sha256"), (F.col("n") + F.when(k == 4, 1).otherwise(0)).cast("int").alias("expected_chapters"),
    )
    rows = books.members(books.chapter_pages(units).unionByName(books.apparatus_pages(about)), about)
    broken = F.concat("content", F.lit("<p>").cast("binary"))
    rows = rows.withColumn("stored", F.col("stored") & (k != 1)).withColumn("content", F.when((k == 2) & F.endswith("path", F.lit("chapter-001.xhtml")), broken).otherwise(F.col("content")))
    rows = rows.filter((k != 3) | ~F.endswith("path", F.lit("colophon.xhtml")))
    # what is opened twice is written once
    opened = kept(books.opened(books.archived(rows)))
    found = books.book_qa(units, about, books.book_violations(opened))
    return found.select("rank", "chapters", "units", "length_ratio", "risks", F.array_join("failures", ",").alias("failures"), "status")


BOOK_ARCHIVES = f"""WITH {O.PAIRS}, g AS (SELECT rank, count(DISTINCT ordinal // 3) AS chapters, count(*) AS units, count(*) FILTER ({O.empty('translation')}) AS empty, count(*) FILTER (kind <> 'heading' AND {_risk('source', 'translation')}) AS risks,
sum(length(coalesce(translation, '')))::DOUBLE / greatest(1, sum(length(coalesce(source, '')))) AS ratio FROM bound GROUP BY rank),
f AS (SELECT *, list_filter([CASE WHEN rank % 7 = 4 THEN 'chapter_count' END, CASE WHEN empty > 0 THEN 'empty_translations' END, CASE WHEN NOT ratio BETWEEN 0.55::DOUBLE AND 1.65::DOUBLE THEN 'translation_length_ratio' END, CASE rank % 7 WHEN 1 THEN 'epub_mimetype_rule' WHEN 2 THEN 'xml:OEBPS/text/chapter-001.xhtml' WHEN 3 THEN 'missing:OEBPS/text/colophon.xhtml' END], lambda x: x IS NOT NULL) AS failures FROM g)
SELECT rank, chapters, units, round(ratio, 6) AS length_ratio, risks, array_to_string(list_sort(failures), ',') AS failures, CASE WHEN len(failures) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM f"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (repair_verdicts, book_cutting, marked_books, landed_files, evidence_claims, retried_ledger, book_archives)}
ORACLES: dict[str, str] = {
    "repair_verdicts": REPAIR_VERDICTS,
    "book_cutting": BOOK_CUTTING,
    "marked_books": MARKED_BOOKS,
    "landed_files": LANDED_FILES,
    "evidence_claims": EVIDENCE_CLAIMS,
    "retried_ledger": RETRIED_LEDGER,
    "book_archives": BOOK_ARCHIVES,
}
