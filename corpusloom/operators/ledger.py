"""Joins and checks over ledgers of units: hash-bound assembly, overlays, fallbacks, conflicts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import normalized, padded, sha, slug


def bound(units: DataFrame) -> DataFrame:
    """Units with the hashes of their texts."""
    return units.withColumn("source_sha256", sha(F.col("source"))).withColumn("translation_sha256", sha(F.col("translation")))


def assembled(units: DataFrame, records: DataFrame, key: Sequence[str] = ("rank", "unit_id", "source_sha256")) -> DataFrame:
    """Each unit with the translation of the record of its name and source hash, null where there is none."""
    found = records.select(*key, F.col("translation").alias("_found"))
    return units.drop("translation").join(found, list(key), "left").withColumnRenamed("_found", "translation")


def missing(units: DataFrame, records: DataFrame, key: Sequence[str] = ("rank", "unit_id", "source_sha256")) -> DataFrame:
    """Units that no record is for."""
    return units.join(records, list(key), "left_anti")


def overlaid(ledger: DataFrame, corrections: DataFrame, key: Sequence[str] = ("rank", "unit_id")) -> DataFrame:
    """The ledger with corrections applied where the source hash is the same; others are ignored."""
    c = corrections.select(*key, F.col("source_sha256").alias("_sha"), F.col("translation").alias("_new"))
    fits = F.col("_sha") == F.col("source_sha256")
    return (
        ledger.join(c, list(key), "left")
        .withColumn("translation", F.when(fits, F.coalesce("_new", "translation")).otherwise(F.col("translation")))
        .withColumn("corrected", F.coalesce(fits & F.col("_new").isNotNull(), F.lit(False)))
        .drop("_sha", "_new")
    )


def override_violations(ledger: DataFrame, overrides: DataFrame, key: Sequence[str] = ("rank", "unit_id")) -> DataFrame:
    """(key, violation): overrides of another source, of no unit, or of a unit that has two of them."""
    l = ledger.select(*key, F.col("source_sha256").alias("_own"))  # noqa: E741
    joined = overrides.join(l, list(key), "left")
    wrong = joined.filter(F.col("_own").isNotNull() & (F.col("_own") != F.col("source_sha256"))).select(*key, F.lit("source_changed").alias("violation"))
    absent = joined.filter(F.col("_own").isNull()).select(*key, F.lit("unit_missing").alias("violation"))
    twice = duplicates(overrides, key).select(*key, F.lit("duplicate_override").alias("violation"))
    return wrong.unionByName(absent).unionByName(twice)


def with_fallback(primary: DataFrame, fallback: DataFrame, key: str = "rank") -> DataFrame:
    """All of primary, and of fallback the groups that primary doesn't have at all."""
    return primary.unionByName(fallback.join(primary.select(key).distinct(), key, "left_anti"))


def longest(ledgers: DataFrame, group: str = "rank", source: str = "path") -> DataFrame:
    """Of each group the rows from the source with the most rows; of equal ones the first by name."""
    counts = ledgers.groupBy(group, source).agg(F.count("*").alias("_n"))
    best = counts.groupBy(group).agg(F.min_by(source, F.struct(-F.col("_n"), F.col(source))).alias(source))
    return ledgers.join(best, [group, source], "left_semi")


def latest(rows: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The last row of each key: a merge in which the last one wins."""
    columns = [c for c in rows.columns if c not in key]
    last = F.max(F.struct(*[o.alias(f"_{i}") for i, o in enumerate(order)], F.struct(*columns).alias("_row")))
    return rows.groupBy(*key).agg(last.alias("_last")).select(*key, *[F.col(f"_last._row.{c}").alias(c) for c in columns])


def conflicts(records: DataFrame, key: Sequence[str] = ("rank", "unit_id")) -> DataFrame:
    """Units with different translations."""
    return records.groupBy(*key).agg(F.countDistinct("translation_sha256").alias("n_translations")).filter("n_translations > 1")


def duplicates(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def in_several_files(corrections: DataFrame, key: Sequence[str] = ("rank", "unit_id"), file: str = "file") -> DataFrame:
    return corrections.groupBy(*key).agg(F.countDistinct(file).alias("n_files")).filter("n_files > 1")


def resumable(before: DataFrame, now: DataFrame, key: str = "id") -> DataFrame:
    """What forbids to go on from an earlier output: units that are in one only, or whose source has changed."""
    a = before.select(key, F.col("source_sha256").alias("_before"))
    b = now.select(key, F.col("source_sha256").alias("_now"))
    return a.join(b, key, "full_outer").filter(~F.col("_before").eqNullSafe(F.col("_now"))).select(key)


def flag_counts(flagged: DataFrame, group: Sequence[str] = ("rank",)) -> DataFrame:
    """How often each flag of the column flags stands in each group. With an inner explode Spark would filter by the flags below it, and work them out again for that."""
    rows = flagged.select(*group, F.explode_outer("flags").alias("flag")).filter("flag is not null")
    return rows.groupBy(*group, "flag").agg(F.count("*").alias("n"))


def shard_plan(units: DataFrame, size: int, group: str = "rank") -> DataFrame:
    plan = units.groupBy(group).agg(F.count("*").alias("unit_count"))
    return plan.withColumn("shard_size", F.lit(size)).withColumn("shard_count", F.ceil(F.col("unit_count") / size).cast("int"))


def shard_jobs(plan: DataFrame) -> DataFrame:
    """A job for each shard of the plan."""
    return plan.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shard_count") - 1)))


def shard_slice(units: DataFrame, shard: int, size: int) -> DataFrame:
    """The units of one shard, by their ordinal from 0."""
    return units.filter((F.col("ordinal") >= shard * size) & (F.col("ordinal") < (shard + 1) * size))


def after_end(units: DataFrame, text: Column, markers: Sequence[str], cue: Column, least: int = 100, group: str = "rank") -> DataFrame:
    """units with ``skipped``: what follows a work's last end marker (at ordinal ``least`` or later), if a cue of boilerplate does."""
    whole = Window.partitionBy(group)
    last = F.max(F.when(text.isin(*markers), F.col("ordinal"))).over(whole)
    return (
        units.withColumn("_cue", cue)
        .withColumn("_last", last)
        .withColumn("_tail", F.max(F.when(F.col("_cue") & (F.col("ordinal") > F.col("_last")), True)).over(whole))
        .withColumn("skipped", F.coalesce((F.col("_last") >= least) & F.col("_tail") & (F.col("ordinal") > F.col("_last")), F.lit(False)))
        .drop("_cue", "_last", "_tail")
    )


def marker_groups(rows: DataFrame, marker: Column, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """rows with ``grp``: rows from one marker to the next; those before the first marker belong to the first group."""
    so_far = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("grp", F.greatest(F.sum(marker.cast("int")).over(so_far), F.lit(1)))


def with_expected_groups(grouped: DataFrame, expected: int, group: Sequence[str]) -> DataFrame:
    """Of marker_groups' rows those of groups that have as many parts as expected; any other grouping is given up."""
    whole = Window.partitionBy(*group)
    return grouped.withColumn("_most", F.max("grp").over(whole)).filter(F.col("_most") == expected).drop("_most")


def last_corrections(rows: DataFrame, key: Sequence[str] = ("rank", "unit_id"), file: str = "file") -> DataFrame:
    """Corrections read from several files: of each unit the one in the last file by name."""
    return latest(rows, key, [F.col(file)])


def merged_corrections(rows: DataFrame, key: Sequence[str] = ("rank", "unit_id"), file: str = "file") -> DataFrame:
    """Corrections of several files as one, with the ``files`` that each comes from; ``clash`` where a unit stands in more than one."""
    columns = [c for c in rows.columns if c not in (*key, file)]
    found = F.min(F.struct(F.col(file), *columns)).alias("_first")
    files = F.sort_array(F.collect_set(file)).alias("files")
    return rows.groupBy(*key).agg(found, files).select(*key, *[F.col(f"_first.{c}").alias(c) for c in columns], "files", (F.size("files") > 1).alias("clash"))


def shard_reports(units: DataFrame, size: int, group: str = "rank") -> DataFrame:
    """Per shard of ``size`` units by ordinal from 0: its units, the first and the last of them, and how many have a translation."""
    done = F.count_if(F.coalesce(F.col("translation"), F.lit("")) != "")
    return (
        units.withColumn("shard", F.floor(F.col("ordinal") / size).cast("int"))
        .groupBy(group, "shard")
        .agg(F.count("*").alias("n_units"), F.min_by("unit_id", "ordinal").alias("first_unit"), F.max_by("unit_id", "ordinal").alias("last_unit"), done.alias("translated"))
        .withColumn("status", F.when(F.col("translated") == F.col("n_units"), "PASS").otherwise("FAIL"))
    )


def prepared_jobs(configs: DataFrame, plans: DataFrame, bundles: DataFrame) -> DataFrame:
    """A job for each shard of each configured rank that has a plan and a bundle; the first of several by path counts.

    configs (rank, slug, path), plans (rank, shard_count, path), bundles (rank, path)."""
    plan = plans.groupBy("rank").agg(F.min_by("shard_count", "path").alias("shard_count"))
    bundle = bundles.groupBy("rank").agg(F.min("path").alias("bundle"))
    found = configs.withColumnRenamed("path", "config").join(plan, "rank").join(bundle, "rank")
    jobs = found.select(padded(F.col("rank"), 3).alias("rank"), "config", slug(F.col("slug")).alias("key"), "bundle", F.explode(F.sequence(F.lit(0), F.col("shard_count") - 1)).alias("shard"))
    return jobs.withColumn("shard_padded", padded(F.col("shard"), 4))


def unprepared(configs: DataFrame, plans: DataFrame, bundles: DataFrame) -> DataFrame:
    """(rank, violation): configured ranks without a plan or a bundle."""
    no_plan = configs.join(plans, "rank", "left_anti").select("rank", F.lit("no_plan").alias("violation"))
    return no_plan.unionByName(configs.join(bundles, "rank", "left_anti").select("rank", F.lit("no_bundle").alias("violation")))


def seeded(units: DataFrame, titles: DataFrame) -> DataFrame:
    """units whose headings that say the work's original title have its translated title: titles (rank, original_title, title)."""
    known = titles.select("rank", normalized(F.col("original_title")).alias("_original"), F.col("title").alias("_title"))
    says = (F.col("kind") == "heading") & (normalized(F.col("source")) == F.col("_original"))
    return units.join(F.broadcast(known), "rank", "left").withColumn("translation", F.when(says, F.col("_title")).otherwise(F.col("translation"))).drop("_original", "_title")


def in_ranks(rows: DataFrame, ranks: DataFrame, key: str = "rank") -> DataFrame:
    """The rows of the ranks asked for."""
    return rows.join(ranks.select(key).distinct(), key, "left_semi")


def progress(units: DataFrame, group: Sequence[str]) -> DataFrame:
    """Per group: units, those translated, and the characters that are still to be paid for."""
    done = F.coalesce(F.col("translation"), F.lit("")) != ""
    left = F.coalesce(F.sum(F.when(~done, F.length("source"))), F.lit(0)).cast("long")
    return units.groupBy(*group).agg(F.count("*").alias("units"), F.count_if(done).alias("translated"), left.alias("chars_left"))


def within_quota(chars: Column, used: Column, limit: Column) -> Column:
    """Whether what is left to translate fits what a service still allows."""
    return used + chars <= limit


def first_of(rows: DataFrame, group: Sequence[str], column: str, n: int) -> DataFrame:
    """Per group its rows counted, and the first ``n`` values of a column in order, as evidence of what a report is about.

    Rows are counted by a partial aggregation; of the others only those that are among the first n where they lie move on, so a
    group of any size is never one task's."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(column))
    # a limit on row numbers is applied before the shuffle, too
    first = rows.select(*group, column).filter(F.col(column).isNotNull()).withColumn("_place", place).filter(F.col("_place") <= n)
    listed = first.groupBy(*group).agg(F.sort_array(F.collect_list(column)).alias("first"))
    counts = rows.groupBy(*group).agg(F.count("*").alias("n"))
    same = reduce(lambda a, b: a & b, [F.col(f"c.{g}").eqNullSafe(F.col(f"f.{g}")) for g in group])
    found = counts.alias("c").join(listed.alias("f"), same, "left")
    none = F.array().cast(listed.schema["first"].dataType)
    return found.select(*[F.col(f"c.{g}").alias(g) for g in group], F.col("c.n").alias("n"), F.coalesce(F.col("f.first"), none).alias("first"))


def numbered_files(rows: DataFrame, order: Column, group: str = "rank") -> DataFrame:
    """rows with ``file``: the group and the row's place in it, as a file name."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(order))
    return rows.withColumn("file", F.concat(padded(F.col(group), 3), F.lit("-"), padded(place, 3), F.lit(".html")))


def retried(ledger: DataFrame, attempts: DataFrame, key: str = "url") -> DataFrame:
    """A ledger (key, status, ...) after another attempt at its rows that aren't recovered; rows that are stay as they are."""
    a = attempts.select(key, F.col("status").alias("_status"), F.col("sha256").alias("_sha256"))
    again = F.col("status") != "RECOVERED"
    return (
        ledger.join(a, key, "left")
        .withColumn("sha256", F.when(again & (F.col("_status") == "RECOVERED"), F.col("_sha256")).otherwise(F.col("sha256")))
        .withColumn("status", F.when(again, F.coalesce("_status", "status")).otherwise(F.col("status")))
        .drop("_status", "_sha256")
    )


def with_images(units: DataFrame, images: DataFrame, group: str = "rank") -> DataFrame:
    """units with ``image``: the n-th unit of a work that marks an illustration takes the work's n-th image (group, place, name)."""
    marks = F.regexp_like("source", F.lit(r"(?i)^\s*\[\s*Illustration\s*:"))
    order = Window.partitionBy(group).orderBy("chapter", "ordinal").rowsBetween(Window.unboundedPreceding, 0)
    placed = units.withColumn("_marks", marks).withColumn("_place", F.when(F.col("_marks"), F.sum(F.col("_marks").cast("int")).over(order)))
    given = images.select(group, F.col("place").cast("long").alias("_place"), F.col("name").alias("image"))
    return placed.join(given, [group, "_place"], "left").drop("_marks", "_place")
