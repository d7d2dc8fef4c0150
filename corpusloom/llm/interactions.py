"""Audit of filters against each other: what each one removes in every order of application, and what is lost by it.

Five conditions fail a document: (A) under 200 words; (B) distinct words are less than half of them; (C) over two in a hundred code
points are capitals A-Z; (D) a character of ``#$%&*|``; (E) its text stands under a smaller doc_id.

Texts move once: they are range-sorted by fingerprint, full text and doc_id, so that equal texts are neighbours, and each is compared with
its predecessor. The ranges are cut by (fingerprint, doc_id), so that the driver's sample of cuts holds no texts and a text that very
many documents share is dealt over many tasks. The first run of equal texts in a range may have begun in ranges before; each range
tells the fingerprint and least doc_id of its first and its last run, and these few rows mend the first runs. The fingerprint is
SHA-256, so one fingerprint in two ranges is one text. From then on rows are a doc_id, a part and a mask of failures; they are summed to at most 32 masks a
part, and the masks to sums over all supersets, from which every order's figures follow by subtraction.

Null texts are empty; null sources and empty ones are the part "". A row without a doc_id has no smaller one and is nobody's smaller
one; rows with one doc_id aren't smaller than each other. Labels of a doc_id on several rows count as one, good or toxic if any of them is; labels without a
doc_id or without documents don't count. An empty table of documents has no parts, so the result is empty. Other columns aren't read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import shuffle_width, written

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 2
_MARKS = re.compile(rb"[#$%&*|]")
_CAPITALS = bytes(range(65, 91))
#: Bytes of UTF-8 that continue a code point.
_INNER = bytes(range(0x80, 0xC0))
DUPLICATE = 1 << FILTERS.index("E")


def failures_of(text: bytes) -> int:
    """The mask of the conditions A to D of one text in UTF-8."""
    words = text.split()
    points = len(text) - (0 if text.isascii() else len(text) - len(text.translate(None, _INNER)))
    return (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < LEAST_DISTINCT * len(words)) << 1
        | (100 * (len(text) - len(text.translate(None, _CAPITALS))) > MOST_CAPITALS * points) << 2
        | (_MARKS.search(text) is not None) << 3
    )


_NARROW = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("least", pa.int64()), ("edge", pa.binary()), ("is_edge", pa.bool_())])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range, in order: mask and least doc_id of each one's run so far, and the fingerprint of those in the first run."""
    last_text = last_print = least = mask = None
    first_run = True

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), _NARROW.types, strict=True)], schema=_NARROW)

    for batch in batches:
        rows = []
        ids, parts, texts, prints = (batch.column(i) for i in range(4))
        for doc, part, text, mark in zip(ids.to_pylist(), parts.to_pylist(), texts.to_pylist(), prints.to_pylist(), strict=True):
            if mark != last_print or text != last_text:
                if last_print is not None and first_run:
                    rows.append((None, None, None, least, last_print, True))
                    first_run = False
                last_text, last_print, least, mask = text, mark, doc, failures_of(text)
            rows.append((doc, part, mask, least, mark if first_run else None, False))
        if rows:
            yield batch_of(rows)
    if last_print is not None:
        yield batch_of([(None, None, None, least, last_print, True)])


def failure_masks(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, part and mask, the bits of the conditions that fail it (A is the lowest)."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("print")
    )
    ordered = rows.repartitionByRange(shuffle_width(docs.sparkSession), F.col("print"), F.col("doc_id").asc_nulls_last()).sortWithinPartitions(
        F.col("print"), F.col("text"), F.col("doc_id").asc_nulls_last()
    )
    narrow = written(ordered.mapInArrow(_compared, "doc_id long, part string, mask int, least long, edge binary, is_edge boolean"))
    # two rows a range at most
    edges = narrow.filter("is_edge").groupBy("edge").agg(F.min("least").alias("before"))
    again = F.coalesce(F.col("doc_id") > F.least("least", "before"), F.lit(False))
    return narrow.filter("not is_edge").join(F.broadcast(edges), "edge", "left").select("doc_id", "part", F.col("mask").bitwiseOR(F.when(again, DUPLICATE).otherwise(0)).alias("mask"))


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part and mask: documents n, and those of them with labels good and toxic."""
    marks = (
        labels.filter("doc_id is not null and (quality = 1 or toxic = 1)")
        .groupBy("doc_id")
        .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"))
    )
    # a doc_id that stands on very many rows is few rows before it is joined
    summed = masks.groupBy("doc_id", "part", "mask").agg(F.count("*").alias("n"))
    of = lambda mark: F.sum(F.col("n") * F.coalesce(F.col(mark), F.lit(0))).alias(mark)
    return summed.join(marks, "doc_id", "left").groupBy("part", "mask").agg(of("good"), of("toxic"), F.sum("n").alias("n"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order of the filters and step: what is kept, removed, redundant, lost, and the filter's share over all orders."""
    size = len(FILTERS)
    sets = range(1 << size)

    def free(count: str) -> F.Column:
        """For each set of filters, the documents that none of them fails."""
        return F.array(*[F.sum(F.when(F.col("mask").bitwiseAND(s) == 0, F.col(count)).otherwise(0)) for s in sets])

    counts = mask_counts(failure_masks(docs), labels)
    alone = F.array(*[F.sum(F.when(F.col("mask") == 1 << k, F.col("n")).otherwise(0)) for k in range(size)])
    parts = counts.groupBy("part").agg(free("n").alias("free"), free("good").alias("good"), free("toxic").alias("toxic"), alone.alias("alone"))

    def share(k: int) -> F.Column:
        terms = [(s, factorial(s.bit_count()) * factorial(size - 1 - s.bit_count())) for s in sets if not s >> k & 1]
        return sum((F.lit(w) * (F.element_at("free", s + 1) - F.element_at("free", (s | 1 << k) + 1)) for s, w in terms), F.lit(0))

    orders = ["".join(p) for p in permutations(FILTERS)]
    befores = [sum(1 << FILTERS.index(x) for x in order[:i]) for order in orders for i in range(size)]
    letters = [FILTERS.index(order[i]) for order in orders for i in range(size)]
    at = F.col("at") + 1
    rows = parts.withColumn("shares", F.array(*[share(k) for k in range(size)])).withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(len(befores) - 1))))
    rows = rows.withColumn("before", F.element_at(F.lit(befores), at)).withColumn("letter", F.element_at(F.lit(letters), at))
    bit = F.element_at(F.lit([1 << k for k in range(size)]), F.col("letter") + 1)
    after = F.col("before").bitwiseOR(bit)

    def removed(of: str) -> F.Column:
        return F.element_at(of, F.col("before") + 1) - F.element_at(of, after + 1)

    failing = F.element_at("free", F.lit(1)) - F.element_at("free", bit + 1)
    return rows.select(
        "part",
        F.element_at(F.lit(orders), F.floor(F.col("at") / size).cast("int") + 1).alias("filter_order"),
        (F.col("at") % size + 1).cast("int").alias("step"),
        F.element_at("free", after + 1).alias("kept"),
        removed("free").alias("removed"),
        (failing - removed("free")).alias("redundant"),
        F.element_at("alone", F.col("letter") + 1).alias("unique_fails"),
        removed("good").alias("good_lost"),
        removed("toxic").alias("toxic_lost"),
        F.element_at("shares", F.col("letter") + 1).alias("shapley"),
    )


ORACLE = """WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
cut AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
fails AS (SELECT doc_id, part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b, 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS c,
  regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > least, false) AS e FROM cut),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
masks AS (SELECT part, a::INT + b::INT * 2 + c::INT * 4 + d::INT * 8 + e::INT * 16 AS mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM fails LEFT JOIN marks USING (doc_id) GROUP BY 1, 2),
parts AS (SELECT DISTINCT part FROM d),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (SELECT v.l || w.l || x.l || y.l || z.l AS filter_order FROM letters v, letters w, letters x, letters y, letters z WHERE v.bit | w.bit | x.bit | y.bit | z.bit = 31),
steps AS (SELECT filter_order, step, bit, coalesce((SELECT sum(q.bit) FROM letters q WHERE contains(substring(filter_order, 1, step - 1), q.l)), 0)::INT AS before FROM (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders) s JOIN letters ON l = substring(filter_order, step, 1)),
figures AS (SELECT p.part, filter_order, step, bit,
  coalesce(sum(n) FILTER (WHERE mask & (before | bit) = 0), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (WHERE mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (WHERE mask & before > 0 AND mask & bit > 0), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (WHERE mask = bit), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (WHERE mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (WHERE mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS toxic_lost
  FROM parts p CROSS JOIN steps LEFT JOIN masks m ON m.part = p.part GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley FROM figures"""
