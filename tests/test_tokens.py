"""Tokens by tables of signs are those of the ranges, and only the words that are asked for are folded."""

from __future__ import annotations

import re
import time

from pyspark.sql import functions as F

from corpusloom.functions import detectors as D
from corpusloom.functions import text as T


def test_same_signs(spark):
    every = [(chr(i),) for i in range(0x20, 0x2200)] + [(chr(i),) for i in (0x212A, 0xFB00, 0xFFFD, 0x10330, 0x1F600)]
    x = F.concat(F.lit("a"), "c", F.lit("b'"), "c", F.lit("’"), "c", F.lit("z"))
    found = spark.createDataFrame(every, "c string").select("c", F.regexp_extract_all(x, F.lit(T._TOKEN), F.lit(0)).alias("t"), F.regexp_like("c", F.lit(D._ALIEN)).alias("alien")).collect()
    for r in found:
        assert r.t == re.findall(T.TOKEN, f"a{r.c}b'{r.c}’{r.c}z"), hex(ord(r.c))
        assert r.alien == bool(re.search("[А-Яа-яЁёΑ-ωΆ-ώ]", r.c)), hex(ord(r.c))


def test_function_words_alone_are_kept(spark):
    words = D.function_words("it") + D.function_words("de")
    texts = ["eßere ESSERE Eẞere daß Daß’s È perché PERCHÉ İl il", "l'il Der der,die;das niẞ", "", None, "Kein kein KEINE"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(T.tokens(F.col("t")).alias("all"), T.tokens_among(F.col("t"), words).alias("some")).collect()
    for r in rows:
        assert r.some == (None if r.all is None else [w for w in r.all if w in words])
    assert rows[0].some == ["essere", "essere", "e", "dass", "è", "perché", "perché", "il"]


def test_tokens_are_found_in_less_time(spark):
    text = "Whereof one cannot speak, thereof one must be silent; où l’été s’en va, là 1921. " * 40
    table = spark.range(0, 4000, 1, 2).select(F.concat(F.lit(text), F.col("id").cast("string")).alias("t")).cache()
    table.count()

    def seconds(expression):
        began = time.perf_counter()
        table.select(F.sum(F.size(F.regexp_extract_all("t", F.lit(expression), F.lit(0))))).collect()
        return time.perf_counter() - began

    times = [(seconds(T.TOKEN), seconds(T._TOKEN)) for _ in range(4)]
    table.unpersist()
    assert min(b for _, b in times) < 0.9 * min(a for a, _ in times), times
