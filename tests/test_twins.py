"""Queries on rows that the tables at hand lack, against their twins in SQL, and against definitions where twins have none."""

from __future__ import annotations

import random
import re

import duckdb
import pandas as pd

from pyspark.sql import functions as F

from corpusloom.functions import packing as P
from corpusloom.plans import catalog, oracle, repair, workflow

QUERIES = catalog.QUERIES | workflow.QUERIES | repair.QUERIES
ORACLES = oracle.ORACLES | workflow.ORACLES | repair.ORACLES


def compared(spark, folder, name, **tables):
    """A query over these tables: (its rows, its twin's rows)."""
    con = duckdb.connect()
    for table, frame in tables.items():
        frame.to_parquet(f"{folder}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    rows = lambda f: sorted(tuple(map(repr, r)) for r in f[sorted(f.columns)].astype(object).where(f[sorted(f.columns)].notna(), None).values.tolist())
    return rows(QUERIES[name](spark, str(folder)).toPandas()), rows(con.execute(ORACLES[name]).df())


def conversations(*turns):
    """Conversations (conv_id, texts)."""
    return pd.DataFrame([(c, i, "user" if i % 2 == 0 else "assistant", t) for c, texts in turns for i, t in enumerate(texts)], columns=["conv_id", "turn", "role", "text"])


def test_ranks_of_more_than_three_digits_are_read_again(spark, tmp_path):
    got, want = compared(spark, tmp_path, "alignment_roundtrip", conversations=conversations((7, ["a", "b"]), (1000, ["c", "d", "e"]), (123456, ["f", "g"])))
    assert got == want and len(got) == 4


def test_sentences_are_cut_once_for_adjacent_repeats(spark):
    text = spark.createDataFrame([("a",)], "text string").select(catalog.D.adjacent_repeat(catalog._text()).alias("r"))
    plan = text._jdf.queryExecution().executedPlan().toString()
    assert plan.count("[.!?…]+") == 1


def test_masked_stops_are_those_of_the_twin(spark, tmp_path):
    rows = ["Mr. Signora. X. St.Mr. A b. Dr.A. Nosig. sig.sig. Ä. É.", "He met Mrs. Ab. And Prof. C. D. left! 1. Then etc. Vs. no more. (Mr.) Ok", None, "", " . Mr."]
    docs = pd.DataFrame({"doc_id": range(5), "text": rows, "lang": list("abcde")})
    for name in ("adjacent_repeat", "unit_extract"):
        got, want = compared(spark, tmp_path, name, documents=docs)
        assert got == want


def greedy(text, limit):
    """Words and blanks packed to limit, written out."""
    done, now = [], ""
    for piece in re.findall(r"[ \t\n\x0b\f\r]+|[^ \t\n\x0b\f\r]+", text):
        if now and len(now) + len(piece) > limit:
            done.append(now)
            now = piece
        else:
            now += piece
    found = [p for p in (re.sub(r"^[ \t\n\x0b\f\r\xa0]+|[ \t\n\x0b\f\r\xa0]+$", "", d) for d in [*done, *([now] if now else [])]) if p]
    return found or [text]


def test_bounded_segments_are_greedy_and_take_one_expression(spark):
    rng = random.Random(5)
    texts = ["", " \n ", "x" * 300, "a" + " " * 150 + "b", "𝒜" * 109 + " b"] + ["".join(rng.choice(["ab", "é𝒜", "c" * rng.randint(1, 130), " ", "\n\t", "\xa0"]) for _ in range(rng.randint(1, 80))) for _ in range(200)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", P.bounded_segments(F.col("t"), 110).alias("p"))
    assert {r["i"]: r["p"] for r in frame.collect()} == {i: greedy(t, 110) for i, t in enumerate(texts)}
    assert "aggregate(" not in frame._jdf.queryExecution().executedPlan().toString()


def test_words_of_composed_forms_are_counted_without_being_folded(spark, tmp_path):
    docs = pd.DataFrame({"doc_id": range(5), "text": ["“Don’t” Ångström Straße", "é ‘a’ b’c", "", "plain  WORDS\n1", "éạ̈ ok"]})
    docs.to_parquet(f"{tmp_path}/documents.parquet")
    frame = QUERIES["composed_forms"](spark, str(tmp_path))
    made = spark.read.parquet(f"{tmp_path}/documents.parquet").select("doc_id", F.size(catalog.T.words(F.col("text"))).alias("words"))
    assert {r["doc_id"]: r["words"] for r in frame.collect()} == {r["doc_id"]: r["words"] for r in made.collect()}
    assert "lambda" not in frame._jdf.queryExecution().executedPlan().toString()
    assert catalog.T._without_marks("éạ̈") == "ea"
