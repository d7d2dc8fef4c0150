"""The boundary to translation models: units are cut, sent in batches, and put together again.

A translator is a function of (texts, parameters) that gives as many texts, in order. Models and services live behind it.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator, Sequence
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import detectors as D
from corpusloom.functions.books import copied_heading
from corpusloom.functions.packing import bounded_segments, source_segments
from corpusloom.functions.text import known, stripped
from corpusloom.operators.lineage import kept
from corpusloom.operators.similarity import collapsed, repeated_span, similarity_at_least

Translator = Callable[[Sequence[str], dict], Sequence[str]]
#: Length limits and parameters of the attempts after one another, for units that no attempt has cleared.
LADDER = [(110, {"beams": 3, "penalty": 1.25}), (70, {"beams": 5, "penalty": 1.35}), (42, {"beams": 8, "penalty": 1.45}), (28, {"beams": 10, "penalty": 1.55}), (18, {"beams": 12, "penalty": 1.65})]


def echo(texts: Sequence[str], parameters: dict) -> Sequence[str]:
    """A translator for tests: gives each text back."""
    return list(texts)


#: Tokens that a decoding may have, at least and at most, and per token of its source.
DECODED = (96, 384, 2)


def decode_limit(tokens: Column) -> Column:
    """How many tokens a model may give for a source of so many."""
    least, most, each = DECODED
    return F.least(F.lit(most), F.greatest(F.lit(least), each * tokens))


@cache
def runtime(factory: str) -> Translator:
    """The translator that ``module:function`` makes, made once in each worker that asks for it."""
    module, _, name = factory.partition(":")
    return getattr(importlib.import_module(module), name)()


def by_runtime(factory: str) -> Translator:
    """A translator that is made where it is used, as a model that can't travel must be."""
    return lambda texts, parameters: runtime(factory)(texts, parameters)


def batches(texts: Sequence[str], most: int, most_bytes: int | None = None) -> Iterator[list[str]]:
    """texts in their order, so many at once and, if that is asked for, so many bytes; a longer text goes alone."""
    now: list[str] = []
    size = 0
    for text in texts:
        n = len(text.encode("utf-8", "surrogatepass"))
        if now and (len(now) >= most or (most_bytes is not None and size + n > most_bytes)):
            yield now
            now, size = [], 0
        now.append(text)
        size += n
    if now:
        yield now


def translated(
    units: DataFrame, key: Sequence[str], translators: Sequence[Translator], pieces: Column | None = None, parameters: dict | None = None, batch: int = 32, batch_bytes: int | None = None
) -> DataFrame:
    """units (key, source) with ``translation``: pieces of each source go through the chain of translators, in batches of like length.

    batch_bytes: the most bytes of a batch, for services that limit requests. A translator that gives another number of texts is an error."""
    cut = source_segments(known(F.col("source"))) if pieces is None else pieces
    rows = units.select(*key, F.posexplode(cut).alias("_at", "_piece")).withColumn("_length", F.length("_piece"))
    given = dict(parameters or {})
    schema = ", ".join(f"`{c}` {units.schema[c].dataType.simpleString()}" for c in key) + ", _at int, _out string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out: list[str] = []
            for texts in batches(frame["_piece"].tolist(), batch, batch_bytes):
                for translate in translators:
                    n, texts = len(texts), list(translate(texts, given))
                    if len(texts) != n:
                        raise ValueError(f"a translator gave {len(texts)} texts for {n}")
                out += texts
            yield frame[[*key, "_at"]].assign(_out=out)

    done = rows.sortWithinPartitions("_length").mapInPandas(run, schema)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_out"))), lambda x: x["_out"]), " ")
    return units.drop("translation").join(done.groupBy(*key).agg(stripped(joined).alias("translation")), list(key), "left")


def pending(units: DataFrame) -> DataFrame:
    """Units that a model must see: without a translation, and no numerals to copy."""
    return units.filter(D.empty(F.col("translation")) & ~copied_heading(F.col("source")))


def best(candidates: DataFrame, key: Sequence[str], language: str) -> DataFrame:
    """Of candidates (key, source, kind, candidate, translation) the one without hard flags and with the least score, else the first."""
    s, t = F.col("source"), F.col("translation")
    formed, forms = D.prepared(candidates)
    # the score asks only for likeness from there on, and only of these languages
    like = similarity_at_least(s, t, F.col("kind"), D.ALIKE) if language in D.LIKENESS_COUNTS else None
    hard = D.hard_flags_repair(s, t, language, repeated_span(t, forms.target_norms))
    scored = formed.withColumn("score", D.score(s, t, F.col("kind"), language, like, forms)).withColumn("clear", F.size(hard) == 0)
    chosen = F.min(F.struct((~F.col("clear")).alias("bad"), "score", "candidate", "translation", "source", "kind")).alias("b")
    return scored.groupBy(*key).agg(chosen).select(*key, "b.source", "b.kind", "b.candidate", "b.translation", "b.score", (~F.col("b.bad")).alias("clear"))


def repaired(units: DataFrame, key: Sequence[str], translators: Sequence[Translator], language: str, ladder: Sequence[tuple[int, dict]] = LADDER) -> DataFrame:
    """units with their best candidate: as they are, without repetitions, translated anew; and then, only for units that none
    of these clears, step after step of the ladder, in ever shorter pieces."""
    base = units.select(*key, "source", "kind", known(F.col("translation")).alias("translation"))
    tries = F.array(F.struct(F.lit(0).alias("candidate"), F.col("translation").alias("t")), F.struct(F.lit(1).alias("candidate"), collapsed(F.col("source"), F.col("translation")).alias("t")))
    made = base.select(*key, "source", "kind", F.explode(tries).alias("c")).select(*key, "source", "kind", "c.candidate", F.col("c.t").alias("translation"))
    again = translated(base.drop("translation"), key, translators).withColumn("candidate", F.lit(2))
    columns = [*key, "source", "kind", "candidate", "translation"]
    found = kept(best(made.select(columns).unionByName(again.select(columns)), key, language))
    for step, (limit, parameters) in enumerate(ladder):
        left = found.filter(~F.col("clear")).select(*key, "source", "kind")
        tried = translated(left, key, translators, bounded_segments(known(F.col("source")), limit), parameters).withColumn("candidate", F.lit(3 + step))
        better = best(found.filter(~F.col("clear")).select(columns).unionByName(tried.select(columns)), key, language)
        found = kept(found.filter("clear").unionByName(better))
    return found


def repaired_risky(units: DataFrame, key: Sequence[str], translators: Sequence[Translator], parameters: dict | None = None) -> DataFrame:
    """units (key, source, translation, ...) in which risky ones are translated anew, where the new text is accepted; ``repaired`` says which."""
    risky = D.translation_risk(F.col("source"), F.col("translation"))
    again = translated(units.filter(risky).select(*key, "source"), key, translators, parameters=parameters).select(*key, F.col("translation").alias("_again"))
    takes = F.coalesce(accepted(F.col("source"), F.col("translation"), F.col("_again")), F.lit(False)) & F.col("_again").isNotNull()
    return units.join(again, list(key), "left").withColumn("repaired", takes).withColumn("translation", F.when(takes, F.col("_again")).otherwise(F.col("translation"))).drop("_again")


def accepted(source: Column, before: Column, after: Column) -> Column:
    """Whether a repair is taken: it says something, and what it replaces was risky or is to grow by 6 % at least."""
    grows = F.length(known(after)) >= 1.06 * F.length(known(before))
    return ~D.empty(after) & (D.translation_risk(source, before) | grows)


def improves(source: Column, before: Column, after: Column, aim: float = 1.05) -> Column:
    """Whether risk and distance of the length ratio from aim are strictly less than before."""

    def cost(target: Column) -> Column:
        return F.when(D.translation_risk(source, target), 2.0).otherwise(0.0) + F.abs(D.ratio(source, target) - aim)

    return cost(after) < cost(before)


def runs_away(source: Column, target: Column) -> Column:
    """A decoding that is much too long or too short, which is done again."""
    n, s = F.length(known(target)), F.length(known(source))
    return (n > F.greatest(F.lit(220), F.floor(2.4 * s))) | (n < F.greatest(F.lit(2), F.floor(0.18 * s)))
