"""Bounds before difflib change no verdict; near-equal sentences alone raise the flags that they should."""

from __future__ import annotations

import random
import time
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import detectors as D
from corpusloom.operators import selection, similarity, translate
from corpusloom.plans import catalog

LINE = "the committee met again in the old town hall on a cold morning and nobody spoke"


def altered(rng, text, share):
    out = list(text)
    for _ in range(int(len(out) * share)):
        i = rng.randrange(len(out))
        out[i : i + rng.choice([0, 1])] = rng.choice(["", "x", "ab", "é", "日"])
    return "".join(out)


def some(rng):
    alphabet = rng.choice(["ab", "abc de", "abcdefghij klmnop", "éü日本 a"])
    text = "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 5, 40, 199, 200, 201, 450])))
    return text, rng.choice([text, altered(rng, text, 0.03), altered(rng, text, 0.2), text[::-1], text[: len(text) // 2] * 2, ""])


@pytest.mark.parametrize("least", [0.5, 0.72, 0.8, 0.88, 0.93, 1.0])
def test_ratio_at_least_is_difflibs(least):
    rng = random.Random(int(least * 100))
    hits = 0
    for _ in range(400):
        a, b = some(rng)
        want = SequenceMatcher(None, a, b).ratio()
        got = similarity.ratio_at_least(a, b, least)
        assert got == (want if want >= least else None), (a, b)
        hits += got is not None
    assert hits > 20


@pytest.mark.parametrize("least", [0.6, 0.93])
def test_near_repeat_is_every_pair(least):
    rng = random.Random(3)
    seen = set()
    for _ in range(150):
        base = [some(rng)[0] for _ in range(rng.randint(0, 6))]
        parts = base + ([altered(rng, rng.choice(base), rng.choice([0.01, 0.04, 0.1]))] if base else [])
        rng.shuffle(parts)
        want = any(a == b or SequenceMatcher(None, b, a).ratio() >= least for i, b in enumerate(parts) for a in parts[:i])
        assert similarity.near_repeat(parts, least) == want, parts
        seen.add(want)
    assert seen == {True, False}


#: The second sentence is the first one but for one word, so no equal sentence, half or neighbour gives the flag.
NEARLY = f"{LINE.capitalize()} today. Another sentence of many words stands here between both of them. {LINE.capitalize()} todey."


def test_near_equal_sentences_are_what_is_flagged(spark):
    rows = [(1, "Fünf Wölfe liefen quer über den zugefrorenen Fluß, und keiner von ihnen sah zurück. Jäger folgten. " + "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich, bis es dunkel wird.", NEARLY, "paragraph"), (2, LINE, LINE.upper() + "!", "paragraph"), (3, LINE, LINE, "heading"), (4, LINE, "Something else altogether was said about them.", None)]
    table = spark.createDataFrame(rows, "id long, source string, translation string, kind string")
    formed, forms = D.prepared(table)
    s, t = F.col("source"), F.col("translation")
    assert not formed.select(D.sentence_seen_before(t).alias("x")).first()["x"]
    hard = formed.select("id", D.hard_flags_repair(s, t, "en", similarity.repeated_span(t, forms.target_norms)).alias("f"))
    assert {r["id"]: r["f"] for r in hard.collect()} == {1: ["decoder_repetition"], 2: [], 3: [], 4: []}
    flags = formed.select("id", selection.repair_flags(s, t, F.col("kind"), "en", forms).alias("f"))
    assert {r["id"]: r["f"] for r in flags.collect()} == {1: [], 2: ["unchanged_source_language"], 3: [], 4: []}
    made = table.filter("id = 1").select("id", "source", "kind", F.lit(0).alias("candidate"), "translation").unionByName(
        table.filter("id = 1").select("id", "source", "kind", F.lit(1).alias("candidate"), F.lit("A worse one, but of no sentence said twice over in any way.").alias("translation"))
    )
    best = translate.best(made, ["id"], "en").first()
    assert (best["candidate"], best["clear"]) == (1, True)


def test_flags_of_english_sources_are_their_definition(spark):
    """The query's arm of likeness against difflib over every pair."""
    sf = "/root/testdata/sf0.001"
    got = {(r["rank"], r["ordinal"]): "unchanged_source_language" in r["flags"] for r in catalog.repair_flags_en(spark, sf).collect()}
    sides = similarity.normalized(F.col("source")).alias("a"), similarity.normalized(F.col("translation")).alias("b")
    for r in catalog.like_pairs(spark, sf).select("rank", "ordinal", "kind", *sides).collect():
        want = r["kind"] != "heading" and min(len(r["a"]), len(r["b"])) >= 18 and SequenceMatcher(None, r["a"], r["b"]).ratio() >= 0.72
        assert got[r["rank"], r["ordinal"]] == want
    assert any(got.values()) and not all(got.values())


def test_exact_ratio_is_difflibs():
    rng = random.Random(11)
    for _ in range(1500):
        a, b = some(rng)
        a, b = (a, b) if rng.random() < 0.5 else (a, some(rng)[0])
        assert similarity.exact_ratio(a, b) == SequenceMatcher(None, a, b).ratio(), (a, b)
    a, b = "ab " * (similarity.MOST_LAID_OUT // 3 + 1), "ba"
    assert similarity.exact_ratio(a, b) == SequenceMatcher(None, a, b).ratio()


@pytest.mark.parametrize("n", [190, 900])
def test_exact_ratio_takes_less_time_than_difflib(n):
    rng = random.Random(n)
    words = ["".join(rng.choice("etaoinsrhldcumfpgwybvk") for _ in range(rng.randint(2, 9))) for _ in range(200)]
    texts = [(" ".join(rng.choices(words, k=n))[: 2 * n], " ".join(rng.choices(words, k=n))[:n]) for _ in range(15)]

    def seconds(use):
        began = time.process_time()
        for a, b in texts:
            use(a, b)
        return time.process_time() - began

    assert 1.5 * min(seconds(similarity.exact_ratio) for _ in range(3)) < min(seconds(lambda a, b: SequenceMatcher(None, a, b).ratio()) for _ in range(3))


def test_unchanged_similarity_counts_as_before(spark):
    rows = [("paragraph", "x" * 18, "x" * 18), ("paragraph", "x" * 17, "x" * 18), ("heading", "x" * 18, "x" * 18), (None, "x" * 18, "x" * 18), ("paragraph", None, "x" * 18), ("paragraph", "日本 " * 9, "日本 é" * 9)]
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, kind string, s string, t string")
    found = [r.v for r in table.select("i", similarity.unchanged_similarity(F.col("s"), F.col("t"), F.col("kind")).alias("v")).orderBy("i").collect()]
    assert found == [1.0, 0.0, 0.0, 0.0, 0.0, SequenceMatcher(None, "日本 " * 8 + "日本", "日本 é" * 9).ratio()]
