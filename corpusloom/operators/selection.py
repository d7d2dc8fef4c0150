"""What selects units for repair, and what remains of a repair: the flags that need likeness or several forms of the texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import detectors as D
from corpusloom.functions.text import known, words
from corpusloom.operators.similarity import repeated_adjacent, similarity_at_least

#: Languages of sources in which an unchanged text is told by its likeness, and the likeness.
LIKE_LANGUAGES, LIKE = ("en", "fr", "de"), 0.72


def repair_flags(source: Column, target: Column, kind: Column, language: str, forms: D.Forms | None = None) -> Column:
    """What a unit is to be looked at for: empty, length_or_repetition, source_script_spillover, unchanged_source_language."""
    flags = [
        ("empty", D.empty(target)),
        ("length_or_repetition", (F.coalesce(kind, F.lit("paragraph")) != "heading") & D.translation_risk(source, target, forms)),
        ("source_script_spillover", D.script_count(target, language) > 0),
    ]
    if language in LIKE_LANGUAGES:
        flags.append(("unchanged_source_language", similarity_at_least(source, target, F.coalesce(kind, F.lit("paragraph")), LIKE) >= LIKE))
    return D.named(*flags)


def with_candidate_reasons(pairs: DataFrame, language: str, source: str = "source", target: str = "translation", column: str = "reasons") -> DataFrame:
    """pairs with the reasons for which a unit is a candidate for repair, in their order; empty for one that isn't.

    Texts are composed (NFKC) and cut into words once; the blocks that are said again at once are found in both of them."""
    forms = pairs.withColumns({"_source_words": words(F.col(source)), "_target_words": words(F.col(target))})
    forms = forms.withColumns({"_source_repeat": repeated_adjacent(F.col("_source_words")), "_target_repeat": repeated_adjacent(F.col("_target_words"))})
    s, t = F.col("_source_words"), F.col("_target_words")
    reasons = D.named(
        ("missing_translation", D.empty(F.col(target))),
        ("decoder_loop", D.decoder_loop(F.col(target))),
        ("source_language_residue", D.source_residue(F.col(target), t, language)),
        ("exact_duplicate_half", D.duplicate_half(s, t)),
        ("strong_source_unmatched_repetition", D.unmatched_repetition(F.col("_source_repeat"), F.col("_target_repeat"))),
        ("source_language_copy", D.source_copy(s, t, language)),
        ("severe_length_anomaly", D.token_length_anomaly(s, t)),
        ("modern_intrusion", D.modern_intrusion(F.col(source), F.col(target))),
    )
    return forms.withColumn(column, reasons).drop("_source_words", "_target_words", "_source_repeat", "_target_repeat")


def candidates(pairs: DataFrame, language: str) -> DataFrame:
    """The units that have a reason to be repaired."""
    return with_candidate_reasons(pairs.withColumn("translation", known(F.col("translation"))), language).filter(F.size("reasons") > 0)
