"""Columns of documents that are called as operators call theirs inside come back as they were."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import hilbert

SMALL = "/root/testdata/sf0.001"
OWN = ["doc_id", "text", "lang", "source", "n_chars"]
#: Every name in quotes in the operators, and what training_rows and write_shards make of theirs.
NAMES = sorted(
    {x.lower() for path in (Path(__file__).parents[2] / "corpusloom/llm").glob("*.py") for x in re.findall(r'"([A-Za-z_]{1,24})"', path.read_text())}
    | {"_row", "_row_", "_row_split", "_row_one", "_position", "_lists", "_one", "shard", "shard_", "shard_slot", "slot", "text_known"}
)


@pytest.fixture(scope="module")
def crowded(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    more = [F.concat(F.lit(f"{name} "), F.col("doc_id").cast("string")).alias(name) for name in NAMES if name not in OWN]
    return docs.limit(60).select("*", *more).cache()


def same(rows, names):
    seen = 0
    for r in rows.collect():
        seen += 1
        assert all(r[n] == f"{n} {r['doc_id']}" for n in names)
    assert seen


@pytest.mark.parametrize("k", range(4))
def test_stages_keep_columns(spark, crowded, k):
    import corpus_pipeline

    out = corpus_pipeline.STAGES[k][1](spark, crowded, SMALL)
    assert out.columns == crowded.columns
    same(out, [n for n in NAMES if n not in OWN])


def test_written_shards_keep_columns(spark, crowded, tmp_path):
    name = hilbert.write_shards(crowded, str(tmp_path / "shards"), 5)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert name not in crowded.columns and name in back.columns
    same(back, [n for n in NAMES if n not in OWN])
