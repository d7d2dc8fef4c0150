"""Readers: everything is landed first, and read by Spark."""

from __future__ import annotations

import gzip
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.ledger import conflicts
from corpusloom.sources.published import folders_of

# Fields of ledgers and configurations.
ALIGNMENT = "unit_id STRING, chapter INT, kind STRING, source STRING, translation STRING, source_sha256 STRING, translation_sha256 STRING"
CONFIG = (
    "rank INT, italian_title STRING, original_title STRING, author STRING, source_language STRING, source_language_label STRING, expected_chapters INT, "
    "genre STRING, slug STRING, author_note STRING, section_label STRING, pg_id INT, section_pattern STRING, include_source_heading BOOLEAN, "
    "take_last_matches INT, wikisource_lang STRING, wikisource_title STRING, single_section BOOLEAN, content_marker STRING, include_content_marker BOOLEAN, "
    "content_end_marker STRING, source_end_marker STRING, skip_first_chapter_blocks INT, translation_backend STRING, translator_model STRING"
)
UNITS = "ARRAY<ARRAY<STRUCT<unit_id: STRING, chapter: INT, kind: STRING, source: STRING>>>"


def configs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CONFIG).json(path, multiLine=True)


def alignments(spark: SparkSession, path: str) -> DataFrame:
    """Ledgers below path, by the rank in their file names (``043_alignment.jsonl``; ranks from 1000 on have more digits), with ``path``."""
    rows = spark.read.schema(ALIGNMENT).option("recursiveFileLookup", "true").option("pathGlobFilter", "*_alignment.jsonl").json(folders_of(path))
    name = F.col("_metadata.file_path")
    return rows.select(F.regexp_extract(name, r"(?:^|/)(\d{3,})_[^/]*alignment\.jsonl$", 1).try_cast("int").alias("rank"), name.alias("path"), "*").filter(F.col("rank").isNotNull())


def source_bundle(spark: SparkSession, path: str) -> DataFrame:
    """Units of frozen books: rank, chapter_no, ordinal (from 0 in the book), unit_id, kind, source."""
    books = spark.read.schema(f"rank INT, chapters {UNITS}").json(folders_of(path), multiLine=True)
    numbered = books.select("rank", F.posexplode(F.flatten("chapters")).alias("ordinal", "u"))
    return numbered.select("rank", "ordinal", "u.unit_id", "u.chapter", "u.kind", "u.source")


def corrections(spark: SparkSession, path: str) -> DataFrame:
    """Corrections of files ``corrections-*.json`` below path: file, rank, unit_id, source_sha256, translation, translation_sha256.

    Of units that stand in several files operators.ledger.last_corrections takes the last."""
    entry = "STRUCT<source_sha256: STRING, translation: STRING, translation_sha256: STRING>"
    files = spark.read.schema(f"corrections MAP<STRING, MAP<STRING, {entry}>>").option("recursiveFileLookup", "true").option("pathGlobFilter", "corrections-*.json").json(folders_of(path), multiLine=True)
    ranks = files.select(F.col("_metadata.file_path").alias("file"), F.explode("corrections").alias("rank", "units"))
    return ranks.select("file", F.col("rank").cast("int").alias("rank"), F.explode("units").alias("unit_id", "c")).select("file", "rank", "unit_id", "c.*")


def overrides(spark: SparkSession, path: str, rank: int | None = None) -> DataFrame:
    """Entries of an override file: rank, unit_id, source_sha256, translation; those of one rank if it is named."""
    entry = "STRUCT<rank: INT, unit_id: STRING, source_sha256: STRING, translation: STRING>"
    found = spark.read.schema(f"overrides ARRAY<{entry}>").json(path, multiLine=True).select(F.explode("overrides").alias("o")).select("o.*")
    return found if rank is None else found.filter(F.col("rank") == rank)


def shard_alignments(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Records of all shards' ledgers (``043_shard_0001_alignment.jsonl``) once for each translation, and the units that have several."""
    rows = alignments(spark, path).filter(F.regexp_like("path", F.lit(r"_shard_\d+_alignment\.jsonl$")))
    return rows.dropDuplicates(["rank", "unit_id", "source_sha256", "translation_sha256"]), conflicts(rows)


def rank_violations(bundles: DataFrame, expected: DataFrame) -> DataFrame:
    """(path, rank): bundles (path, rank) whose rank isn't the one that is expected of their path (path, rank)."""
    own = bundles.select("path", "rank").distinct()
    return own.join(expected.select("path", F.col("rank").alias("_rank")), "path").filter(~F.col("rank").eqNullSafe(F.col("_rank"))).select("path", "rank")


def gzipped_base64_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents that are gzipped and written in base64, one a file."""

    @F.pandas_udf("string")
    def unzip(blob: pd.Series) -> pd.Series:
        return blob.map(lambda b: None if b is None else gzip.decompress(bytes(b)).decode("utf-8"))

    files = spark.read.text(path, wholetext=True)
    return files.select(F.from_json(unzip(F.unbase64(F.regexp_replace("value", r"\s", ""))), schema).alias("document"))


def plain_texts(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files without their byte order mark, line ends as line feeds."""
    text = F.regexp_replace(F.regexp_replace("value", r"^\x{FEFF}", ""), r"\r\n?", "\n")
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), text.alias("text"))


def between_marks(text: str = "text") -> dict:
    """Columns ``body`` (between the start and the end mark of a landed book, null without both) and ``marked``."""
    # fixed values: the two marks
    start = r"(?im)^\*\*\* START OF (?:THE|THIS) PROJECT GUTENBERG EBOOK.*?\*\*\*[ \t]*$"
    end = r"(?im)^\*\*\* END OF (?:THE|THIS) PROJECT GUTENBERG EBOOK.*?\*\*\*[ \t]*$"
    after = F.regexp_replace(text, rf"(?s)\A.*?{start}", "\u0001")
    parts = F.split(F.regexp_replace(after, end, "\u0001"), "\u0001")
    marked = F.regexp_like(F.col(text), F.lit(start)) & (F.size(parts) >= 3)
    return {"marked": marked, "body": F.when(marked, F.trim(F.regexp_replace(F.element_at(parts, 2), r"^\s+|\s+$", "")))}


def archive_members(spark: SparkSession, path: str) -> DataFrame:
    """Entries of ZIP archives: asset, path, position, stored, content; ``safe`` says whether the name stays inside."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for asset, content in zip(frame["asset"], frame["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for i, info in enumerate(z.infolist()):
                        yield pd.DataFrame({"asset": [asset], "path": [info.filename], "position": [i], "stored": [info.compress_type == zipfile.ZIP_STORED], "content": [z.read(info)]})

    files = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", "[^/]+$", 0).alias("asset"), "content")
    members = files.mapInPandas(run, "asset string, path string, position int, stored boolean, content binary")
    unsafe = F.regexp_like("path", F.lit(r"(?:^/|\\|(?:^|/)\.\.?(?:/|$))"))
    return members.withColumn("safe", ~unsafe).withColumn("sha256", F.sha2("content", 256))


def verified(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """What is wrong with landed files (asset, content) by a manifest (asset, size, sha256): (asset, violation)."""
    found = files.select("asset", F.length("content").cast("long").alias("_size"), F.sha2("content", 256).alias("_sha"))
    checks = [
        (F.col("_sha").isNull(), "absent"),
        (~F.regexp_like("sha256", F.lit("^[0-9a-f]{64}$")), "malformed_hash"),
        (F.col("_size") != F.col("size"), "size"),
        (F.col("_sha") != F.col("sha256"), "hash"),
    ]
    why = F.coalesce(*[F.when(c, F.lit(n)) for c, n in checks])
    return manifest.join(found, "asset", "left").select("asset", why.alias("violation")).filter("violation is not null")
