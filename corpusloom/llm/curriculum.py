"""A mix of sources by target weights whose proportions change while training runs; DataFrame functions only.

Every source has a target in words: sources by code point, null last, weigh 1, 2, 3, 1, 2, 3, ... and share all
words of the input; a target stops at ``most`` times the words of its source, and what is over is shared by weight
among the others, until none is above. Over training time t from 0 to 1 a source's weight follows a line: sources
of weight 1 fall from 1.5 to 0.5 of their mean weight, those of weight 2 stay, those of weight 3 rise. Its integral
W(t) says how many words of the source training has used at t; W(1) is the target.

A source's documents stand in a fixed random order (by the MD5 of doc_id) and are taken pass after pass. A copy
whose middle is at cumulative word c of its source is trained at the t with W(t) = c. A pass that the target ends
takes the documents that fit wholly, and then the one left document that comes nearest to what is missing, if
that is nearer than none. So a document is taken floor(target / source size) times, or once more.

Cumulative words come from sums of 4096 hash ranges of each source and sums inside a range, so a source that holds
a third of all rows is spread over as many tasks as any other rows.

Nulls: a null text has no words; a null source is a source. A source without words has target 0. Rows that repeat
a doc_id count as documents of their own; if such rows of one source are of one size, which of them is first is
of no consequence. An empty table gives an empty table. Columns other than doc_id, text, source are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import WORD, bucketed, numbered, shuffle_width, unused, written

#: How far the weights of sources of weight 1, 2, 3 lean to the end of training: the slope of their line, halved.
LEANS = {1: -0.5, 2: 0.0, 3: 0.5}
RANGE_DIGITS = 3
#: Sources up to which per-source figures are broadcast; beyond it they are joined by shuffling.
FEW_SOURCES = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, most: int = 3) -> tuple[DataFrame, int]:
    """(key, source_size, weight, target), one row a source, of rows (key, source, size); and how many sources."""
    sums = sizes.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    ranked, n = numbered(sums, F.col("source").asc_nulls_last())
    weighed = ranked.select("key", "source_size", (F.col("position") % 3 + 1).alias("weight"))
    cap = F.col("source_size") * most

    def figures(above: Column) -> tuple[int, int, int]:
        """Words capped, weight uncapped, sources capped."""
        row = weighed.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
            F.coalesce(F.sum(F.when(above, 1)), F.lit(0)),
        ).first()
        return row[0], row[1], row[2]

    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    unit, capped = 0.0, -1
    above: Column = F.lit(False)
    while True:  # the words for a weight of 1 only grow, so each round caps another source or is the last
        fixed, weight, now = figures(above)
        if now == capped or not weight:
            break
        capped, unit = now, (total - fixed) / weight
        above = F.lit(unit) * F.col("weight") > cap
    target = F.least(F.lit(unit) * F.col("weight"), cap.cast("double"))
    return weighed.withColumn("target", target), n


def _moment(share: Column, lean: Column) -> Column:
    """The t of 0 to 1 by which ``share`` of a source's target is used: t + lean * (t * t - t) = share."""
    flat = F.lit(1.0) - lean
    return F.when(lean == 0, share).otherwise((F.sqrt(flat * flat + F.lit(4.0) * lean * share) - flat) / (F.lit(2.0) * lean))


def mix(docs: DataFrame, most: int = 3, keep: Sequence[str] = ()) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, copies, taken and ``positions``, the training
    times (array<double>, ascending) of its copies; and the columns of keep, which also decide between rows alike in all else."""
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    sizes = written(
        docs.select(
            "doc_id",
            F.col("source").cast("string").alias("source"),
            key.alias("key"),
            word_count(F.col("text")).alias("size"),
            order.alias("order"),
            *keep,
        ).withColumn("range", F.conv(F.substring("order", 1, RANGE_DIGITS), 16, 10).cast("int"))
    )
    targets, n_sources = source_targets(sizes, most)
    small = F.broadcast if n_sources <= FEW_SOURCES else lambda df: df

    sums = sizes.groupBy("key", "range").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        sums.withColumn("ahead", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .drop("words")
        .join(small(targets), "key")
    )
    inside = Window.partitionBy("key", "range").orderBy("order", "doc_id", "size", *keep).rowsBetween(Window.unboundedPreceding, -1)
    width = shuffle_width(docs.sparkSession)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    placed = written(
        sizes.repartition(width, "key", "range")
        .join(ranges, ["key", "range"])
        .withColumn("start", F.col("ahead") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .withColumn("passes", F.least(passes, F.lit(most)).cast("long"))
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
        .withColumn("fits", (F.col("size") > 0) & (F.col("start") + F.col("size") <= F.col("rest")))
        .drop("ahead", "range")
    )
    # where the last pass ends inside a document, so many words are missing
    missing = placed.groupBy("key").agg(
        F.max(F.when((F.col("start") <= F.col("rest")) & (F.col("rest") < F.col("start") + F.col("size")), F.col("rest") - F.col("start"))).alias("missing")
    )
    off = F.abs(F.col("missing") - F.col("size"))
    closing = (
        placed.filter((F.col("size") > 0) & ~F.col("fits") & (F.col("passes") < most))
        .join(small(missing.filter(F.col("missing") > 0)), "key")
        .filter(off < F.col("missing"))
        .groupBy("key")
        .agg(F.min(F.struct(off.alias("off"), F.col("start").alias("start"), F.col("order").alias("order"))).alias("best"))
        .select("key", F.col("best.start").alias("last_start"), F.col("best.order").alias("last_order"))
    )
    lean = F.element_at(F.create_map(*[F.lit(x) for pair in LEANS.items() for x in pair]), F.col("weight").cast("int"))
    closes = F.coalesce((F.col("start") == F.col("last_start")) & (F.col("order") == F.col("last_order")) & (F.col("size") > 0), F.lit(False))
    copies = F.when(F.col("size") > 0, F.col("passes") + (F.col("fits") | closes).cast("long")).otherwise(F.lit(0)).cast("int")
    middle = F.col("start") + F.col("size") / F.lit(2.0)
    return (
        placed.join(small(closing), "key", "left")
        .withColumn("copies", copies)
        .withColumn("lean", lean)
        .withColumn(
            "positions",
            F.when(
                F.col("copies") > 0,
                F.transform(
                    F.sequence(F.lit(0), F.col("copies") - 1),
                    lambda i: _moment(F.least((i * F.col("source_size") + middle) / F.col("target"), F.lit(1.0)), F.col("lean")),
                ),
            ).otherwise(F.array().cast("array<double>")),
        )
        .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "positions", *keep)
    )


def training_rows(docs: DataFrame, most: int = 3) -> DataFrame:
    """docs with all its columns, each row as often as the mix takes it, range-sorted by training time.

    Each row is a document of its own, whatever its doc_id. Rows are numbered where they are read and written once, a bucket for
    each split of the input; their training times come back as one array for each split, so that texts move once, into their order."""
    row = unused(docs.columns, "_row")
    split, one, lists_, time = (f"{row}_{x}" for x in ("split", "one", "lists", "time"))
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    table = bucketed(numbered.withColumn(split, F.shiftright(row, 33)), split)
    inside = F.col(row).bitwiseAND(F.lit((1 << 33) - 1))
    times = mix(table, most, [row]).select(F.shiftright(row, 33).alias(split), F.struct(inside.alias("at"), "positions").alias(one))
    # as many rows as a split of the input holds, without their texts
    lists = times.groupBy(split).agg(F.transform(F.sort_array(F.collect_list(one)), lambda x: x["positions"]).alias(lists_))
    copies = table.join(lists, split).withColumn(time, F.explode(F.element_at(lists_, (inside + 1).cast("int"))))
    width = shuffle_width(docs.sparkSession)
    order = [F.col(time), F.col(row)]
    return copies.drop(lists_).repartitionByRange(width, *order).sortWithinPartitions(*order).select(*[F.col(f"`{c}`") for c in docs.columns])


def taken(mixed: DataFrame) -> DataFrame:
    """The contract's columns, range-sorted by the first position; what isn't taken comes last."""
    rows = mixed.select("doc_id", "size", "source_size", "target", "taken", F.round(F.try_element_at("positions", F.lit(1)), 9).alias("first_position"))
    order = [F.col("first_position").asc_nulls_last(), F.col("doc_id")]
    return rows.repartitionByRange(shuffle_width(mixed.sparkSession), *order).sortWithinPartitions(*order)


ORACLE = """
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size, md5(doc_id::VARCHAR) AS ord FROM documents
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source
), weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight FROM sums
), byratio AS (
  SELECT *, row_number() OVER (ORDER BY 3.0 * source_size / weight, source) AS r FROM weighed
), steps AS (
  SELECT *, ((SELECT sum(source_size) FROM weighed) - coalesce(sum(3 * source_size) OVER (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(weight) OVER (ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS unit FROM byratio
), unit AS (
  SELECT unit FROM steps WHERE unit * weight <= 3 * source_size ORDER BY r LIMIT 1
), targets AS (
  SELECT source, source_size, weight, least(coalesce((SELECT unit FROM unit), 0) * weight, (3 * source_size)::DOUBLE) AS target FROM weighed
), placed AS (
  SELECT s.*, t.source_size, t.weight, t.target,
    coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY ord, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
    CASE WHEN t.source_size > 0 THEN least(floor(t.target / t.source_size), 3)::BIGINT ELSE 0 END AS passes
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), rested AS (
  SELECT *, target - passes * source_size AS rest, size > 0 AND start + size <= target - passes * source_size AS fits FROM placed
), missing AS (
  SELECT source, max(CASE WHEN start <= rest AND rest < start + size THEN rest - start END) AS missing FROM rested GROUP BY source
), closing AS (
  SELECT r.source, r.start, r.ord, row_number() OVER (PARTITION BY r.source ORDER BY abs(m.missing - r.size), r.start, r.ord) AS n
  FROM rested r JOIN missing m ON r.source IS NOT DISTINCT FROM m.source
  WHERE r.size > 0 AND NOT r.fits AND r.passes < 3 AND m.missing > 0 AND abs(m.missing - r.size) < m.missing
), counted AS (
  SELECT r.*, CASE WHEN r.size > 0 THEN r.passes + CASE WHEN r.fits OR c.n IS NOT NULL THEN 1 ELSE 0 END ELSE 0 END AS copies
  FROM rested r LEFT JOIN closing c ON c.n = 1 AND r.source IS NOT DISTINCT FROM c.source AND r.start = c.start AND r.ord = c.ord AND r.size > 0
), timed AS (
  SELECT *, least((start + size / 2.0::DOUBLE) / target, 1.0) AS share, (weight - 2) * 0.5::DOUBLE AS lean FROM counted
)
SELECT doc_id, size::BIGINT AS size, source_size, target, (copies * size)::BIGINT AS taken,
  CASE WHEN copies > 0 THEN round(CASE WHEN lean = 0 THEN share
    ELSE (sqrt((1 - lean) * (1 - lean) + 4 * lean * share) - (1 - lean)) / (2 * lean) END, 9) END AS first_position
FROM timed
"""
