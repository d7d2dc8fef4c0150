"""Alignment by bounds against sums over all pairs, in chapters of any size."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import similarity

WORDS = [f"{a}{b}{c}" for a in ("st", "pr", "m", "qu") for b in ("a", "o", "ei", "u") for c in ("nd", "rk", "l", "ssen", "x")]


def chapter(rng, name, n_anchors, n_paragraphs):
    text = lambda n: " ".join(rng.choice(WORDS) if rng.random() < 0.7 else rng.choice(("the", "and", "of")) for _ in range(n))
    paragraphs = [(name, str(i), text(rng.randint(1, 30)), i / n_paragraphs) for i in range(n_paragraphs)]
    anchors = []
    for i in range(n_anchors):
        base = rng.choice(paragraphs)
        words = base[2].split()
        rng.shuffle(words)
        anchors.append((name, f"a{i}", rng.choice([" ".join(words[:8]), text(6), base[2], "", "zzz"]), rng.random()))
    return anchors, paragraphs


def by_definition(anchors, paragraphs, top, pull):
    out = []
    for name in {x[0] for x in anchors}:
        mine = [("a", *x[1:]) for x in anchors if x[0] == name] + [("p", *x[1:]) for x in paragraphs if x[0] == name]
        counts = [Counter(g for w in (t or "").split() for g in similarity.word_grams(w)) for _, _, t, _ in mine]
        df = Counter(g for c in counts for g in c)
        vectors = []
        for c in counts:
            v = {g: n * (math.log((1 + len(mine)) / (1 + df[g])) + 1) for g, n in c.items()}
            length = math.sqrt(sum(x * x for x in v.values()))
            vectors.append({g: x / length for g, x in v.items()})
        for (side, key, _, fa), v in zip(mine, vectors, strict=True):
            if side == "a":
                found = []
                for (other, to, _, fp), w in zip(mine, vectors, strict=True):
                    if other == "p" and (shared := v.keys() & w.keys()):
                        cosine = sum(v[g] * w[g] for g in shared)
                        found.append((round(-(cosine - pull * abs(fp - fa)), 9), fp, to, cosine))
                for place, (_, _, to, cosine) in enumerate(sorted(found)[:top], 1):
                    out.append((name, key, to, place, round(cosine, 6)))
    return sorted(out)


@pytest.mark.parametrize(("few", "top", "pull"), [(256, 3, 0.12), (0, 3, 0.12), (10, 1, 0.5), (0, 5, 0.0)])
def test_alignment_is_its_definition(spark, few, top, pull):
    rng = random.Random(17)
    chapters = [chapter(rng, f"c{i}", 6, n) for i, n in enumerate((1, 2, 9, 40, 120))]
    anchors, paragraphs = ([r for c in chapters for r in c[k]] for k in (0, 1))
    anchors.append(("none", "x", "no paragraphs here", 0.5))
    shape = "chapter string, key string, text string, fraction double"
    found = similarity.aligned(spark.createDataFrame(anchors, shape), spark.createDataFrame(paragraphs, shape), top=top, pull=pull, few=few)
    got = sorted((r["chapter"], r["anchor"], r["paragraph"], r["place"], round(r["similarity"], 6)) for r in found.collect())
    assert got == by_definition(anchors, paragraphs, top, pull)


def test_bounds_leave_out_most_pairs(spark):
    """In one large chapter of words as frequent as those of prose, the pairs that are summed are a small part of those that share a gram."""
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("aeioubcdfghlmnprstvw") for _ in range(rng.randint(2, 9))) for _ in range(4000)]
    odds = [1 / (i + 3) for i in range(len(vocabulary))]
    texts = [" ".join(rng.choices(vocabulary, odds, k=rng.randint(15, 60))) for _ in range(2500)]
    shape = "chapter string, key string, text string, fraction double"
    # each anchor was cut out of a paragraph, and its two neighbours go on with it
    anchors = []
    for i in range(20):
        at = rng.randrange(1, len(texts) - 1)
        words = texts[at].split()
        for k in (at - 1, at + 1):
            texts[k] += " " + " ".join(words[:12])
        anchors.append(("c", str(i), " ".join(words), at / len(texts)))
    a = spark.createDataFrame(anchors, shape)
    p = spark.createDataFrame([("c", str(i), t, i / len(texts)) for i, t in enumerate(texts)], shape)
    both = a.withColumn("key", F.concat(F.lit("a"), "key")).unionByName(p.withColumn("key", F.concat(F.lit("p"), "key")))
    w = similarity.tfidf(both, "chapter", "key", "text").cache()
    wa = w.filter("key like 'a%'").select("chapter", F.col("key").alias("anchor"), "gram", F.col("weight").alias("wa"))
    wp = w.filter("key like 'p%'").select("chapter", F.col("key").alias("paragraph"), "gram", F.col("weight").alias("wp"))
    places = [x.select("chapter", F.concat(F.lit(n[0]), "key").alias(n), F.col("fraction").alias(f"f{n[0]}")) for x, n in ((a, "anchor"), (p, "paragraph"))]
    kept = similarity.best_by_bounds(wa, wp, *places, "chapter", 3, 0.12).count()
    ordered = similarity.in_impact_order(wa, wp, *places, "chapter", 3, 0.12).cache()
    listed = [ordered.filter(which).join(wp, ["chapter", "gram"]).count() for which in ("makes_pairs", "not makes_pairs")]
    assert listed[0] < 0.7 * sum(listed), listed
    every = wa.join(wp, ["chapter", "gram"]).select("anchor", "paragraph").distinct().count()
    assert every > 40_000 and kept < every / 20, (every, kept)
    full, cut = (similarity.aligned(a, p, few=few).select("anchor", "place", "paragraph").collect() for few in (10_000, 1000))
    assert sorted(full) == sorted(cut)


def test_chapters_are_scored_in_place(spark):
    """No n-gram is moved for a chapter of some hundred paragraphs; chapters go on over batches; rows without a key only count."""
    rng = random.Random(23)
    chapters = [chapter(rng, f"c{i}", 5, n) for i, n in enumerate((1, 3, 300, 7))]
    anchors, paragraphs = ([r for c in chapters for r in c[k]] for k in (0, 1))
    shape = "chapter string, key string, text string, fraction double"
    a, p = spark.createDataFrame(anchors, shape), spark.createDataFrame(paragraphs, shape)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        found = similarity.aligned(a, p)
        assert "xxhash64" not in found._jdf.queryExecution().toString()
        got = sorted((r["chapter"], r["anchor"], r["paragraph"], r["place"], round(r["similarity"], 6)) for r in found.collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == by_definition(anchors, paragraphs, 3, 0.12)
    odd = similarity.aligned(
        spark.createDataFrame([("c", "1", "ab cd", 0.5), ("c", None, "ab", 0.1), (None, "2", "ab", 0.1), ("d", "3", "ab", 0.1)], shape),
        spark.createDataFrame([("c", "1", "ab", 0.5), ("c", "2", "AB  cd", None), ("c", "3", None, 0.5), ("c", None, "cd", 0.5)], shape),
    )
    assert sorted((r["chapter"], r["anchor"], r["paragraph"], r["place"], round(r["similarity"], 6)) for r in odd.collect()) == [("c", "1", "1", 2, 0.650696), ("c", "1", "2", 1, 1.0)]
