"""The queries of the training-data operators, with their production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import covertree, curriculum, decontam, hilbert, interactions, jaccard, langid, mainhtml, orderhash, pieces, repeats, toxicity, turntrie, twins
from corpusloom.llm.common import table

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mainhtml.main_text(table(spark, sf_dir, "pages"))


def op2_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.shards(table(spark, sf_dir, "documents"), 40)


def op3_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum.taken(curriculum.mix(table(spark, sf_dir, "documents"), most=3))


def op4_nearest_centroid_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op7_cover_tree_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_duplicates(table(spark, sf_dir, "embeddings"), 0.95)


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_components(table(spark, sf_dir, "documents"), 80)


def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orderhash.against_neighbours(table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(pieces.encode(table(spark, sf_dir, "documents"), MODEL))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turntrie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_suffix_array_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_html_main_text": op1_html_main_text,
    "op2_hilbert_shards": op2_hilbert_shards,
    "op3_curriculum_mix": op3_curriculum_mix,
    "op4_nearest_centroid_language": op4_nearest_centroid_language,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_cover_tree_duplicates": op7_cover_tree_duplicates,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_order_minhash": op9_order_minhash,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_suffix_array_decontamination": op12_suffix_array_decontamination,
    "op13_filter_interactions": op13_filter_interactions,
}

ORACLES: dict[str, str] = {
    "op3_curriculum_mix": curriculum.ORACLE,
    "op5_suffix_array_dedup": twins.REPEATS,
    "op7_cover_tree_duplicates": twins.COVER_TREE,
    "op8_ngram_jaccard_join": twins.JACCARD,
    "op11_conversation_trie": turntrie.ORACLE,
    "op12_suffix_array_decontamination": decontam.ORACLE,
    "op13_filter_interactions": interactions.ORACLE,
}
