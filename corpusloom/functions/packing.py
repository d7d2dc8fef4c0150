"""Greedy packing as folds over arrays, in the order given."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import once, sentences, stripped


def packed(parts: Column, limit: int, blank: str = " ") -> Column:
    """Join neighbours with a blank while they stay within limit characters; a longer part stands alone."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("now"))

    def add(state: Column, part: Column) -> Column:
        over = (state["now"] != "") & (F.length(state["now"]) + len(blank) + F.length(part) > limit)
        joined = F.when(state["now"] == "", part).otherwise(F.concat(state["now"], F.lit(blank), part))
        return F.when(over, F.struct(F.concat(state["done"], F.array(state["now"])).alias("done"), part.alias("now"))).otherwise(F.struct(state["done"].alias("done"), joined.alias("now")))

    return F.aggregate(parts, start, add, lambda s: F.when(s["now"] == "", s["done"]).otherwise(F.concat(s["done"], F.array(s["now"]))))


def words_of(x: Column) -> Column:
    return F.filter(F.split(x, r"[\s\x{00a0}]+"), lambda w: w != "")


def split_long_block(x: Column, limit: int = 1400, found: Column | None = None) -> Column:
    """Sentences; a longer one than limit is packed from its clauses, and a longer clause word by word. found: the sentences of x, if known."""

    def piece(sentence: Column) -> Column:
        clauses = F.split(sentence, r"(?<=[;:,—–])[\s\x{00a0}]+")
        # the words of an overlong clause go into the running piece one by one
        parts = F.flatten(F.transform(clauses, lambda c: F.when(F.length(c) > limit, words_of(c)).otherwise(F.array(c))))
        return F.when(F.length(sentence) <= limit, F.array(sentence)).otherwise(packed(parts, limit))

    return F.flatten(F.transform(sentences(x) if found is None else found, piece))


def atomic_segments(x: Column, whole: int = 180, limit: int = 150, found: Column | None = None) -> Column:
    """Clauses; one longer than ``whole`` is packed word by word to limit. found: the sentences of x, if known."""

    def clauses(sentence: Column) -> Column:
        parts = F.filter(F.transform(F.split(sentence, r"(?<=[,;:!?…—–])[\s\x{00a0}]+"), stripped), lambda c: c != "")
        kept = once(parts, lambda p: F.when(F.size(p) > 0, p).otherwise(F.array(sentence)))
        return F.flatten(F.transform(kept, lambda c: F.when(F.length(c) <= whole, F.array(c)).otherwise(packed(words_of(c), limit))))

    base = once(sentences(x) if found is None else found, lambda f: F.when(F.size(f) > 0, f).otherwise(F.array(x)))
    return F.flatten(F.transform(base, clauses))


def bounded_segments(x: Column, limit: int) -> Column:
    """Words and the white space between them, packed to limit and stripped; never empty."""
    # the most characters up to limit that end at a border of words, or a longer word or blank alone
    run = rf"(?s).{{1,{limit}}}(?:(?<=\s)(?=\S)|(?<=\S)(?=\s)|\z)|\s+|\S+"
    pieces = F.filter(F.transform(F.regexp_extract_all(x, F.lit(run), F.lit(0)), stripped), lambda p: p != "")
    return once(pieces, lambda p: F.when(F.size(p) > 0, p).otherwise(F.array(x)))


def _rough(x: Column) -> Column:
    return F.filter(F.transform(F.split(x, r"(?<=[.!?…])\s+|\n+"), stripped), lambda p: p != "")


def _packed_sentences(x: Column, limit: int, long: Callable[[Column], Column]) -> Column:
    def cut(text: Column) -> Column:
        parts = F.flatten(F.transform(_rough(text), lambda p: F.when(F.length(p) > limit, long(p)).otherwise(F.array(p))))
        return F.when(F.length(text) <= limit, F.array(text)).otherwise(packed(parts, limit))

    return once(F.regexp_replace(stripped(x), "[ \\t]+", " "), cut)


def source_segments(x: Column, limit: int = 700) -> Column:
    """Sentences packed to limit; an overlong one is cut into fragments first, which are packed whole."""
    return _packed_sentences(x, limit, lambda p: packed(words_of(p), limit))


def source_segments_by_word(x: Column, limit: int = 760) -> Column:
    """As source_segments, but the words of an overlong sentence go into the running chunk one by one."""
    return _packed_sentences(x, limit, words_of)


def bins(sizes: Column, limit: int) -> Column:
    """The number of the part, from 1, that each size of an array goes to: a new one when the next would pass limit."""
    start = F.struct(F.array().cast("array<int>").alias("out"), F.lit(1).alias("part"), F.lit(0).cast("long").alias("held"))

    def add(state: Column, size: Column) -> Column:
        over = (state["held"] > 0) & (state["held"] + size > limit)
        part = F.when(over, state["part"] + 1).otherwise(state["part"])
        held = F.when(over, size).otherwise(state["held"] + size).cast("long")
        return F.struct(F.concat(state["out"], F.array(part)).alias("out"), part.alias("part"), held.alias("held"))

    return F.aggregate(sizes, start, add, lambda s: s["out"])
