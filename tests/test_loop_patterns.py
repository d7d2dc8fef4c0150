"""Patterns for loops tell the same texts as the plain ones, which try every word again shorter."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from corpusloom.functions import detectors as D

SIGN, PART, WORD = r"([^\p{L}\p{N}_\s])\1{5,}", r"(?iu)([a-zà-öø-ÿ]{2,15})\1{3,}", r"(?iuU)\b([a-zà-öø-ÿ]{2,25})(?:[.\s_-]+\1){3,}\b"
FIVE = r"(?i)\b([a-zà-ÿ]{3,})(?:[\s,.;:!?—-]+\1){4,}\b"


def test_same_as_plain_patterns(spark):
    rng = random.Random(11)
    signs = ["a", "A", "b", "é", "É", "ÿ", "Ÿ", "÷", "K", "k", "ſ", "s", "ı", "İ", "ß", "я", "1", "_", " ", "  ", ".", "-", "!", "…", "—", "\n", " "]
    texts = []
    for _ in range(3000):
        some = rng.sample(signs, rng.randint(1, 4))
        word = "".join(rng.choice(some) for _ in range(rng.choice([1, 2, 3, 4, 15, 16, 25, 26])))
        parts = [rng.choice([word, word, word.upper(), word.lower(), word[:-1]]) + rng.choice(["", rng.choice(signs)]) for _ in range(rng.randint(2, 7))]
        texts.append((rng.choice(["", "x", "so "]) + rng.choice(["", " "]).join(parts),))
    texts += [(sep.join([w] * n + [end]),) for w in ("so", "sos", "Séß", "été", "a÷b", "x1y") for sep in (" ", ", ", "_", "—", "") for n in (3, 4, 5, 6) for end in ("", w[:-1], "z")]
    t = F.col("t")
    plain = F.regexp_like(t, F.lit(SIGN)) | F.regexp_like(t, F.lit(PART)) | F.regexp_like(t, F.lit(WORD))
    got = spark.createDataFrame(texts, "t string").select("t", D.decoder_loop(t).alias("a"), plain.alias("b"), D.word_five_times(t).alias("c"), F.regexp_like(t, F.lit(FIVE)).alias("d"))
    rows = got.collect()
    assert [r["t"] for r in rows if r["a"] != r["b"] or r["c"] != r["d"]] == []
    assert 100 < sum(r["a"] for r in rows) < 2900 and sum(r["c"] for r in rows) > 20
