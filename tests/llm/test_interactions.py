"""The audit of filters against its definition, order by order."""

from __future__ import annotations

import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import interactions

LONG = " ".join(f"w{i}" for i in range(220))
ROWS = [
    (None, LONG, "a"), (1, LONG, "a"), (1, LONG, "b"), (2, LONG, None), (2, LONG, ""), (3, None, "a"), (4, "", "a"), (5, "x " * 300, "b"), (6, "x " * 300, "a"), (7, LONG + " $", "c"), (8, LONG.upper(), "c"),
    (9, LONG + " é ABCDEFGHIJKLMNOPQRSTUVWXYZ", "c"), (10, "é" * 200_000, "b"), (None, "", "z"), (11, "a b\x0bc\x1cd " * 60, "z"), (12, LONG.upper() + " |", "a"), (13, LONG.upper() + " |", "a"),
]
LABELS = [(1, 1, 0), (1, 0, 0), (2, 1, 1), (3, None, 1), (8, 1, None), (13, 1, 1), (99, 1, 1), (None, 1, 1)]


def by_hand(rows, labels):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    docs = []
    for doc, text, source in rows:
        t = text or ""
        w = word.findall(t)
        fails = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": doc is not None and any(o is not None and o < doc and (u or "") == t for o, u, _ in rows),
        }
        docs.append((source or "", doc, fails))
    out, shares = {}, Counter()
    for part in {p for p, _, _ in docs}:
        for order in map("".join, permutations("ABCDE")):
            left = [(d, f) for p, d, f in docs if p == part]
            gone = []
            for step, letter in enumerate(order, 1):
                removed = [(d, f) for d, f in left if f[letter]]
                redundant = sum(f[letter] for _, f in gone)
                unique = sum(f[letter] and sum(f.values()) == 1 for _, f in gone + left)
                left = [(d, f) for d, f in left if not f[letter]]
                gone += removed
                out[part, order, step] = (len(left), len(removed), redundant, unique, sum(d in good for d, _ in removed), sum(d in toxic for d, _ in removed))
                shares[part, letter] += len(removed)
    return {k: (*v, shares[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


@pytest.mark.parametrize("width", ["1", "4", "9"])
def test_audit_is_its_definition(spark, width):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        docs = spark.createDataFrame([(*r, 7, "x") for r in ROWS * 2], "doc_id long, text string, source string, mask int, part string").repartition(5)
        labels = spark.createDataFrame([(*r, 5) for r in LABELS], "doc_id long, quality int, toxic int, part int")
        got = {tuple(r)[:3]: tuple(r)[3:] for r in interactions.audit(docs, labels).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == by_hand(ROWS * 2, LABELS)


def test_audit_of_one_text_over_many_ranges(spark):
    """One text on most rows: only the least doc_id's row is no duplicate, whatever range a row falls into."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 5 > 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("text"), F.lit("s").alias("source")).repartition(7)
    again = interactions.failure_masks(docs).filter(F.col("mask").bitwiseAND(interactions.DUPLICATE) > 0)
    assert {r["doc_id"] for r in again.collect()} == {i for i in range(3000) if i % 5 and i > 1}


def test_audit_of_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert interactions.audit(none, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect() == []
