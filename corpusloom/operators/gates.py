"""Release gates: statuses, evidence, rosters, parts. What is wrong comes as rows; a gate passes if there are none."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import padded, sha, slug
from corpusloom.operators.lineage import kept

#: Stands for the group of rows whose group is null.
_NO_NAME = "\0"


def rolled_up(evidence: DataFrame, required: Sequence[str], group: str = "rank") -> DataFrame:
    """Per group: whether every required gate is there, passed, and bound to the group's own hash.

    evidence: (group, gate, state, bound), one row a gate."""
    good = (F.col("state") == "PASS") & F.col("bound")
    per = evidence.filter(F.col("gate").isin(*required)).groupBy(group).agg(
        F.countDistinct(F.when(good, F.col("gate"))).alias("n_passed"), F.min(good).alias("all_good"), F.sort_array(F.collect_set(F.when(~good, F.col("gate")))).alias("failed")
    )
    return per.withColumn("state", F.when(F.col("all_good") & (F.col("n_passed") == len(required)), "PASS").otherwise("FAIL"))


def evidence_violations(claimed: DataFrame, members: DataFrame) -> DataFrame:
    """Claims (asset, path, sha256) whose file isn't in the asset, or has another hash there."""
    m = members.select("asset", "path", F.col("sha256").alias("_own"))
    return claimed.join(m, ["asset", "path"], "left").filter(~F.col("_own").eqNullSafe(F.col("sha256"))).select(
        "asset", "path", F.when(F.col("_own").isNull(), "absent").otherwise("changed").alias("violation")
    )


def partition_violations(everything: DataFrame, selected: DataFrame, excluded: DataFrame, key: str) -> DataFrame:
    """Where selected and excluded don't share out everything: (key, violation)."""
    s, x = selected.select(key).distinct(), excluded.select(key).distinct()
    both = s.join(x, key, "left_semi").select(key, F.lit("in_both").alias("violation"))
    none = everything.select(key).distinct().join(s.unionByName(x), key, "left_anti").select(key, F.lit("in_none").alias("violation"))
    alien = s.unionByName(x).distinct().join(everything, key, "left_anti").select(key, F.lit("unknown").alias("violation"))
    return both.unionByName(none).unionByName(alien)


def id_bitmaps(rows: DataFrame, key: str, name: str) -> DataFrame:
    """(bucket, name): the different ids of rows as bitmaps, one for each bucket of some thousand ids; null ids are none."""
    bit = F.bitmap_construct_agg(F.bitmap_bit_position(F.col(key))).alias(name)
    return rows.filter(F.col(key).isNotNull()).groupBy(F.bitmap_bucket_number(F.col(key)).alias("bucket")).agg(bit)


def partition_counts(everything: DataFrame, selected: DataFrame, excluded: DataFrame, key: str) -> DataFrame:
    """Per bucket of ids: how many stand in both selected and excluded, in neither, and in one of them but not in everything.

    Ids are whole numbers. Each table is one pass and one partial aggregation: what moves are bitmaps, not ids, and of each bucket the sizes of
    bitmaps and of their unions say all."""
    union = F.bitmap_or_agg("bits")
    every, s, x = (id_bitmaps(t, key, "bits").withColumn("of", F.lit(n)) for t, n in ((everything, "e"), (selected, "s"), (excluded, "x")))
    size = lambda *of: F.coalesce(F.bitmap_count(F.bitmap_or_agg(F.when(F.col("of").isin(*of), F.col("bits")))), F.lit(0))
    sums = every.unionByName(s).unionByName(x).groupBy("bucket").agg(size("e").alias("e"), size("s").alias("s"), size("x").alias("x"), size("s", "x").alias("sx"), F.bitmap_count(union).alias("all"))
    return sums.select("bucket", (F.col("s") + F.col("x") - F.col("sx")).alias("in_both"), (F.col("all") - F.col("sx")).alias("in_none"), (F.col("all") - F.col("e")).alias("unknown"))


def partition_violations_by_bitmaps(everything: DataFrame, selected: DataFrame, excluded: DataFrame, key: str) -> DataFrame:
    """The rows of partition_violations, for ids that are whole numbers: only buckets in which something is wrong are looked into."""
    wrong = kept(partition_counts(everything, selected, excluded, key).filter("in_both + in_none + unknown > 0"))
    of = lambda rows: rows.select(key).join(wrong.select("bucket"), F.bitmap_bucket_number(F.col(key)) == F.col("bucket"), "left_semi")
    return partition_violations(of(everything), of(selected), of(excluded), key)


def roster_violations(roster: DataFrame, manifest: DataFrame, order: str = "rank", identity: Sequence[str] = ("title", "author")) -> DataFrame:
    """Places, counted in order, at which roster and manifest name different works."""

    def placed(df: DataFrame, prefix: str) -> DataFrame:
        # a roster is a list of some hundred works, so it may be numbered in one place
        return df.select(F.row_number().over(Window.orderBy(order)).alias("place"), F.struct(order, *identity).alias(prefix))

    pairs = placed(roster, "a").join(placed(manifest, "b"), "place", "full_outer")
    return pairs.filter(~F.col("a").eqNullSafe(F.col("b"))).select("place")


def digest(rows: DataFrame, text: Column, order: Column, group: Sequence[str] = ()) -> DataFrame:
    """The hash of a ledger: that of its rows' canonical texts, in order, between brackets."""
    listed = F.array_sort(F.collect_list(F.struct(order.alias("o"), text.alias("t"))))
    joined = F.concat(F.lit("["), F.array_join(F.transform(listed, lambda r: r["t"]), ","), F.lit("]"))
    return rows.groupBy(*group).agg(sha(joined).alias("ledger_sha256"))


def parts(files: DataFrame, group: str, order: str, size: str, limit: int) -> DataFrame:
    """files (group, order, size) with ``part``, from 1: packed in order, a new part where the next file would pass limit.

    The rows are range-sorted, so that a group of any size lies on many tasks. What a task needs to know of those before it is how
    full their last part is. Tasks begin with a guess (empty) and tell how they end; the guesses are replaced by what the task
    before told until nothing changes. Parts that begin at different rows soon begin at the same ones, so few rounds do;
    a round reads three columns and brings one row per task to the driver."""
    spark = files.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = files.select(F.col(group), F.col(order), F.col(size).cast("long").alias(size))
    placed = kept(rows.repartitionByRange(width, group, order).sortWithinPartitions(group, order).withColumn("_task", F.spark_partition_id()))
    kinds = {c: rows.schema[c].dataType.simpleString() for c in (group, order)}

    def packed(entry: dict[int, tuple[str, int, int]], tell: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            now = None
            for frame in frames:
                numbers = np.zeros(len(frame), dtype=np.int64)
                names = frame[group].astype(str).where(frame[group].notna(), _NO_NAME)
                for i, (task, name, one) in enumerate(zip(frame["_task"], names, frame[size].fillna(0).astype("int64").tolist(), strict=True)):
                    if now is None:
                        now = list(entry.get(task, (None, 0, 1)))
                    if name != now[0]:
                        now = [name, 0, 1]
                    if now[1] > 0 and now[1] + one > limit:
                        now[1:] = [0, now[2] + 1]
                    now[1] += one
                    numbers[i] = now[2]
                if not tell:
                    yield frame[[group, order, size]].assign(part=numbers)
            if tell and now is not None:
                yield pd.DataFrame({"task": [int(task)], "name": [now[0]], "held": [now[1]], "part": [now[2]]})

        return run

    entry: dict[int, tuple[str, int, int]] = {}
    while True:
        told = placed.mapInPandas(packed(entry, True), "task int, name string, held long, part long").collect()
        found = {r["task"]: (r["name"], r["held"], r["part"]) for r in told}
        after, before = {}, None
        for task in sorted(found):
            if before is not None:
                after[task] = before
            before = found[task]
        if after == entry:
            break
        entry = after
    return placed.mapInPandas(packed(entry, False), f"`{group}` {kinds[group]}, `{order}` {kinds[order]}, `{size}` long, part long").withColumn("part", F.col("part").cast("int"))


def part_sizes(packed: DataFrame, group: str, size: str) -> DataFrame:
    """Per part: its files and their size."""
    return packed.groupBy(group, "part").agg(F.count("*").alias("files"), F.sum(size).alias("size"))


def archives(files: DataFrame, group: str, name: str = "name", content: str = "content") -> DataFrame:
    """(group, part, asset, files, size, sha256, content): each part's files (group, part, name, content) as one stored ZIP file.

    A part is no larger than the limit that ``parts`` packed it by, and is one task's."""
    kinds = files.schema

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(name)
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
            for n, c in zip(frame[name], frame[content], strict=True):
                z.writestr(zipfile.ZipInfo(n, (2000, 1, 1, 0, 0, 0)), bytes(c))
        first = frame.iloc[0]
        return pd.DataFrame({group: [first[group]], "part": [first["part"]], "files": [len(frame)], "content": [out.getvalue()]})

    packed = files.groupBy(group, "part").applyInPandas(run, f"`{group}` {kinds[group].dataType.simpleString()}, part {kinds['part'].dataType.simpleString()}, files int, content binary")
    asset = F.concat(slug(F.col(group).cast("string")), F.lit("-part-"), padded(F.col("part"), 2), F.lit(".zip"))
    return packed.select(group, "part", asset.alias("asset"), "files", F.length("content").cast("long").alias("size"), F.sha2("content", 256).alias("sha256"), "content")


def truncated_map(entries: Column, n: int) -> Column:
    """The first n entries of a map, by key, as evidence in a report."""
    return F.map_from_entries(F.slice(F.array_sort(F.map_entries(entries)), 1, n))


def public_domain(death_year: Column, before: int = 1956) -> Column:
    """Whether an author died long enough ago; unknown years don't count."""
    return F.coalesce(death_year < before, F.lit(False))


def self_hashed(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """rows with ``record_sha256``: the hash of their canonical JSON text, taken before this column is there."""
    return rows.withColumn("record_sha256", sha(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})))


def scored_candidates(candidates: DataFrame, title: Column, author: Column, language: Column) -> DataFrame:
    """candidates (title, authors, languages) with ``score``: 8 for the language, 1 for each long word of the title asked for that
    stands in theirs, 4 if the author's last name stands in one of theirs. Texts must be folded."""
    asked = F.filter(F.regexp_extract_all(title, F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)), lambda w: F.length(w) > 3)
    found = F.size(F.filter(asked, lambda w: F.contains(F.col("title"), w)))
    family = F.element_at(F.split(author, r"\s+"), -1)
    return candidates.withColumn(
        "score",
        F.when(F.array_contains("languages", language), 8).otherwise(0) + found + F.when(F.exists("authors", lambda a: F.contains(a, family)), 4).otherwise(0),
    )
