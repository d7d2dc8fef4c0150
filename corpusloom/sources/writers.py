"""Writers: ledgers as JSON lines, bundles and reports as JSON, archives in parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import padded
from corpusloom.operators.ledger import bound
from corpusloom.sources.published import publish


def write_alignment(units: DataFrame, path: str) -> None:
    """Ledgers by rank as JSON lines, in order, hashes made anew."""
    rows = bound(units)
    rows.repartitionByRange("rank", "ordinal").sortWithinPartitions("rank", "ordinal").write.partitionBy("rank").json(path)


def write_alignment_files(units: DataFrame, path: str) -> None:
    """One ledger for each rank, under the name that readers.alignments knows it by (``043_alignment.jsonl``).

    A rank is one file by its format: its task writes the sorted lines under that name, and the manifest publishes all of them."""
    rows = bound(units)
    columns = [c for c in ("unit_id", "chapter", "kind", "source", "translation", "source_sha256", "translation_sha256") if c in rows.columns]
    name = F.concat(padded(F.col("rank"), 3), F.lit("_alignment.jsonl"))
    lines = rows.select(name.alias("name"), "ordinal", F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("line"))
    publish(lines, path, "name", "line", [F.col("ordinal")])


def correction_files(rows: DataFrame, path: str, name: str) -> None:
    """Corrections (rank, unit_id, ...) as one JSON file ``name``.json of units by rank.

    The document is one stream of lines, a unit each, in the order of ranks (as texts) and units; what opens and closes it and its ranks
    stands in the lines of the first and last units. So no rank, nor all of them, is ever one row."""
    fields = [c for c in rows.columns if c not in ("rank", "unit_id")]
    # of a unit that stands twice the last one by its fields counts, as in a map
    kept = rows.groupBy(F.col("rank").cast("string").alias("rank"), F.col("unit_id").cast("string").alias("unit_id")).agg(F.max(F.struct(*fields)).alias("entry"))
    ends = kept.groupBy("rank").agg(F.min("unit_id").alias("first"), F.max("unit_id").alias("last"))
    # two ranks go to the driver
    whole = ends.agg(F.min("rank").alias("least"), F.max("rank").alias("most")).first()
    key = lambda c: F.to_json(F.array(c)).substr(F.lit(2), F.length(F.to_json(F.array(c))) - 2)
    placed = kept.join(ends, "rank")
    first, last = F.col("unit_id") == F.col("first"), F.col("unit_id") == F.col("last")
    opens = F.concat(F.when(F.col("rank") == F.lit(whole["least"]), F.lit('{"corrections":{')).otherwise(F.lit(",")), key("rank"), F.lit(":{"))
    closes = F.when(F.col("rank") == F.lit(whole["most"]), F.lit("}}}")).otherwise(F.lit("}"))
    line = F.concat(F.when(first, opens).otherwise(F.lit(",")), key("unit_id"), F.lit(":"), F.to_json("entry"), F.when(last, closes).otherwise(F.lit("")))
    lines = placed.select(F.lit(f"{name}.json").alias("name"), "rank", "unit_id", line.alias("line"))
    if whole["least"] is None:
        lines = rows.sparkSession.createDataFrame([(f"{name}.json", "", "", '{"corrections":{}}')], "name string, rank string, unit_id string, line string")
    publish(lines, path, "name", "line", [F.col("rank"), F.col("unit_id")])


def bundles(units: DataFrame) -> DataFrame:
    """(rank, document): a book's units by chapter as one JSON document."""
    unit = F.struct("ordinal", F.struct("unit_id", "chapter", "kind", "source").alias("u"))
    chapters = units.groupBy("rank", "chapter").agg(F.transform(F.array_sort(F.collect_list(unit)), lambda x: x["u"]).alias("units"))
    books = chapters.groupBy("rank").agg(F.transform(F.array_sort(F.collect_list(F.struct("chapter", "units"))), lambda x: x["units"]).alias("chapters"))
    return books.select("rank", F.to_json(F.struct("rank", "chapters")).alias("document"))


def write_bundle_files(units: DataFrame, path: str) -> None:
    """One bundle for each rank (``043_source_bundle.json``), a document of one line."""
    found = bundles(units).select(F.concat(padded(F.col("rank"), 3), F.lit("_source_bundle.json")).alias("name"), F.col("document").alias("line"))
    publish(found, path, "name", "line", [])


def corrections(rows: DataFrame) -> DataFrame:
    """(rank, document): corrections of a rank by unit."""
    fields = [c for c in rows.columns if c not in ("rank", "unit_id")]
    return rows.groupBy("rank").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("unit_id", F.struct(*fields)))))).alias("document"))


def report(rows: DataFrame, columns: list) -> DataFrame:
    """A report of one row as JSON."""
    return rows.agg(*columns).select(F.to_json(F.struct("*")).alias("document"))


def job_matrix(jobs: DataFrame, limit: int = 256) -> DataFrame:
    """The jobs as one JSON list; more than ``limit`` of them is an error."""
    listed = F.slice(F.array_sort(F.collect_list(F.struct(*sorted(jobs.columns)))), 1, limit + 1)
    found = jobs.limit(limit + 1).agg(listed.alias("include"))
    return found.select(F.when(F.size("include") > limit, F.raise_error(F.lit(f"more than {limit} jobs"))).otherwise(F.to_json(F.struct("include"))).alias("document"))
