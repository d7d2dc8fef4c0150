"""Benchmark decontamination against its definition, and its suffix arrays against sorting."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import decontam
from corpusloom.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def by_hand(docs, bench, width=10):
    windows = {}
    for item, text in bench:
        w = WORD.findall(lowered(text))
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    widths = {len(x) for x in windows}
    items = [WORD.findall(lowered(t)) for _, t in bench]
    out = []
    for doc, text in docs:
        w = WORD.findall(lowered(text))
        hit, named, longest = set(), set(), 0
        for n in widths:
            for i in range(len(w) - n + 1):
                if (x := tuple(w[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    named |= {str(k) for k in windows[x] if k is not None}
                    for other in items:
                        for j in range(len(other)):
                            k = 0
                            while i + k < len(w) and j + k < len(other) and w[i + k] == other[j + k]:
                                k += 1
                            longest = max(longest, k if k >= min(width, len(other)) else 0)
        out.append((doc, len(w), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit), longest))
    return out


def of_digests(found):
    rows = []
    for r in found.collect():
        n = sum(s["end"] - s["start"] for s in r["spans"])
        rows.append((r["doc_id"], r["n_words"], n, len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), n > 0, r["longest"]))
    return rows


def key(row):
    return tuple((x is not None, x) for x in row)


def random_tables(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "c1", "é", "日本", "dd"][: rng.randint(1, 6)]
    text = lambda n: rng.choice([" ", "\n", ", ", "\x00", "-"]).join(rng.choice(vocabulary) for _ in range(n))
    bench = [(rng.choice([None, *range(8), 11]), text(rng.choice([0, 1, 3, 9, 10, 11, 25]))) for _ in range(rng.randint(0, 6))]
    docs = []
    for i in range(12):
        t = text(rng.choice([0, 2, 15, 60]))
        if bench and rng.random() < 0.5:
            t += " " + (rng.choice(bench)[1] or "").upper() + " zz " + text(4)
        docs.append((rng.choice([None, i, i, 3]), rng.choice([t, t, t, None])))
    return docs, bench


@pytest.mark.parametrize("seed", range(60))
def test_search_is_its_definition(seed, monkeypatch):
    docs, bench = random_tables(seed)
    block = decontam.block_of(bench)
    got = []
    for some in (docs[:5], docs[5:]):
        texts = [(t or "").encode() for _, t in some]
        for (doc, _), n, spans, items, longest in zip(some, *decontam.search(block, texts), strict=True):
            hits = sum(b - a for a, b in spans)
            got.append((doc, n, hits, len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), hits > 0, longest))
    assert got == by_hand(docs, bench)


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_blocks_of_items(spark, monkeypatch, block_bytes):
    """The same rows, whether the items are one block or many, and whatever other columns are called."""
    monkeypatch.setattr(decontam, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(decontam, "SHARD_BYTES", 300)
    docs, bench = random_tables(7)
    more, others = random_tables(21)
    docs, bench = docs + more, bench + others
    rows = spark.createDataFrame([(*d, 5, "x", i) for i, d in enumerate(docs)], "doc_id long, text string, n_words int, spans string, c0 int").repartition(3)
    items = spark.createDataFrame([(*b, "y") for b in bench], "item_id long, text string, block string")
    want = sorted(by_hand(docs, bench), key=key)
    assert sorted(of_digests(decontam.matches(rows, items)), key=key) == want
    kept = decontam.decontaminated(rows, items)
    assert kept.columns == rows.columns and kept.schema == rows.schema
    clean = {i for i, r in enumerate(by_hand(docs, bench)) if not r[5]}
    assert {r["c0"]: tuple(r) for r in kept.collect()} == {i: (*docs[i], 5, "x", i) for i in clean}
    assert [tuple(r)[1:] for r in decontam.contamination(rows.filter("c0 = 0"), items).collect()] == [by_hand(docs[:1], bench)[0][1:6]]


def test_no_items_and_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contamination(none, items).collect() == []
    one = spark.createDataFrame([(1, "a few words " * 50_000)], "doc_id long, text string")
    row = decontam.contamination(one, items).first()
    assert (row["n_words"], row["n_hit"], row["n_items"], row["contaminated"]) == (150_000, 0, 0, False)
    assert row["items_sha256"] == hashlib.sha256(b"").hexdigest()


def test_one_word_over_and_over(spark):
    """As many places as words, not as many as pairs of places."""
    docs = spark.createDataFrame([(1, "again " * 300_000)], "doc_id long, text string")
    items = spark.createDataFrame([(k, "again " * 300) for k in range(200)], "item_id long, text string")
    row = decontam.contamination(docs, items).first()
    assert (row["n_hit"], row["n_items"]) == (300_000, 200)


@pytest.mark.parametrize("seed", range(20))
def test_word_suffix_array_is_sorting(seed):
    rng = np.random.default_rng(seed)
    data = rng.integers(0, rng.integers(1, 5) + 1, rng.integers(0, 200))
    order = decontam.word_suffix_array(data, len(data) + 1)
    assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:].tolist())


def test_planted_passages_are_found(spark):
    """Items of the benchmark inside other words, in capitals and over line ends."""
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = items.select(F.col("item_id").alias("doc_id"), F.concat(F.lit("before it "), F.translate(F.regexp_replace("text", " ", "\n"), "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.lit(" after it")).alias("text"))
    found = decontam.matches(docs, items).toPandas()
    assert all(str(r.doc_id) in list(r.items) for r in found.itertuples())
    assert QUERIES["op12_suffix_array_decontamination"](spark, "/root/testdata/sf0.001").filter("contaminated").count() > 0
