"""A corpus from raw documents to token ids: rid of toxic texts, near copies and repeated passages, mixed, encoded.

Each stage is (name, function of (spark, docs, sf_dir)); its result is written and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import curriculum, jaccard, pieces, repeats, toxicity
from corpusloom.llm.common import table, written
from corpusloom.llm.queries import MODEL


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't toxic, judged by what the labelled ones among them teach."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least document of each group of near copies."""
    return jaccard.first_of_each(docs, 80)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document holds; n_chars counts what is left."""
    return repeats.without_repeats(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, in the order of training."""
    return curriculum.training_rows(docs, most=3)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of them and of the text that they decode to."""
    found = pieces.encode(docs, MODEL)
    return pieces.digests(found, more=["ids"])


STAGES = [
    ("toxicity", clean),
    ("ngram_jaccard_join", distinct),
    ("suffix_array_dedup", unrepeated),
    ("curriculum_mix", mixed),
    ("sentencepiece", encoded),
]

#: No SQL: learned scores, byte-wise removal and encoding aren't expressible in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs)
    return docs
