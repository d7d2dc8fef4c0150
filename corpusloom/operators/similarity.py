"""Likeness of texts: difflib ratios in pandas UDFs behind cheap guards, and TF-IDF of character n-grams as joins."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from difflib import SequenceMatcher
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StringType, StructField, StructType

from corpusloom.functions.rows import given_back, of_each
from corpusloom.functions.text import bare, known, normalized, once, sentences, spaced, stripped
from corpusloom.operators.lineage import kept


def _common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, a bit for each character of a: one pass over b."""
    places: dict[str, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    left = full
    for x in b:
        if at := places.get(x):
            both = left & at
            left = (left + both | left - both) & full
    return len(a) - left.bit_count()


#: Fixed values of difflib: characters of the second text from which frequent ones begin no match, and of how many of its characters one is frequent.
POPULAR_FROM, POPULAR_SHARE = 200, 100
#: Characters of the first text up to which it is laid out in bits, some 25 bytes each.
MOST_LAID_OUT = 100_000

_Block = tuple[int, int, int]


def _longest_by_bits(a: str, b: str) -> Callable[[int, int, int, int], _Block]:
    """Finds the longest block that a[alo:ahi] and b[blo:bhi] have in common, the first in a, then in b: (begin in a, begin in b, length).

    Each character of a is a row of bits, one for each equal character of b, and all rows are one number; moved by a row and a bit and laid
    over itself, it keeps the begins of blocks of two, of these those of four, and so on."""
    places: dict[str, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j

    def longest(alo: int, ahi: int, blo: int, bhi: int) -> _Block:
        if ahi - alo == 1:
            j = b.find(a[alo], blo, bhi)
            return alo, max(j, blo), int(j >= 0)
        if bhi - blo == 1:
            i = a.find(b[blo], alo, ahi)
            return max(i, alo), blo, int(i >= 0)
        part, width = a[alo:ahi], bhi - blo
        size, full = (width >> 3) + 1, (1 << width) - 1
        rows = {x: (places.get(x, 0) >> blo & full).to_bytes(size, "little") for x in set(part)}
        begins = int.from_bytes(b"".join([rows[x] for x in part]), "little")
        if not begins:
            return alo, blo, 0
        step, n, shorter = 8 * size + 1, 1, []
        while twice := begins & begins >> step * n:
            shorter.append((n, begins))
            begins, n = twice, 2 * n
        for more, at in reversed(shorter):
            if longer := begins & at >> step * n:
                begins, n = longer, n + more
        i, j = divmod((begins & -begins).bit_length() - 1, 8 * size)
        return alo + i, blo + j, n

    return longest


def _longest_by_rare(a: str, b: str) -> Callable[[int, int, int, int], _Block]:
    """The same where frequent characters of b begin no match, but lengthen what others found: only the places of the others are looked at."""
    places: dict[str, list[int]] = {}
    for j, x in enumerate(b):
        places.setdefault(x, []).append(j)
    rare = {x: at for x, at in places.items() if len(at) <= len(b) // POPULAR_SHARE + 1}
    known_places = [i for i, x in enumerate(a) if x in rare]

    def longest(alo: int, ahi: int, blo: int, bhi: int) -> _Block:
        i0, j0, n = alo, blo, 0
        last, before = -2, {}
        for k in range(bisect_left(known_places, alo), bisect_left(known_places, ahi)):
            i = known_places[k]
            if i != last + 1:
                before = {}
            here = {}
            for j in rare[a[i]]:
                if j >= bhi:
                    break
                if j >= blo:
                    long = here[j] = before.get(j - 1, 0) + 1
                    if long > n:
                        i0, j0, n = i - long + 1, j - long + 1, long
            last, before = i, here
        while i0 > alo and j0 > blo and a[i0 - 1] == b[j0 - 1]:
            i0, j0, n = i0 - 1, j0 - 1, n + 1
        while i0 + n < ahi and j0 + n < bhi and a[i0 + n] == b[j0 + n]:
            n += 1
        return i0, j0, n

    return longest


def exact_ratio(a: str, b: str) -> float:
    """difflib's ratio of two texts, which takes the longest common block and then those before and after it, by faster ways to find that block."""
    if a == b:
        return 1.0
    if len(b) < POPULAR_FROM and len(a) > MOST_LAID_OUT:
        return SequenceMatcher(None, a, b).ratio()
    longest = (_longest_by_bits if len(b) < POPULAR_FROM else _longest_by_rare)(a, b)
    matched, left = 0, [(0, len(a), 0, len(b))]
    while left:
        alo, ahi, blo, bhi = left.pop()
        i, j, n = longest(alo, ahi, blo, bhi)
        matched += n
        if n and alo < i and blo < j:
            left.append((alo, i, blo, j))
        if n and i + n < ahi and j + n < bhi:
            left.append((i + n, ahi, j + n, bhi))
    return 2.0 * matched / (len(a) + len(b))


def _bag_bound(a: Counter, b: Counter, total: int) -> float:
    return 2.0 * (a & b).total() / total


def ratio_at_least(a: str, b: str, least: float) -> float | None:
    """difflib's ratio of a and b if that is ``least`` or more, else none.

    What difflib matches is a subsequence of both texts, so the ratio is at most what their lengths, the characters that they have in common
    in any order, and their longest common subsequence allow, each of which costs much less than matching."""
    total = len(a) + len(b)
    if not total:
        return 1.0
    if a == b:
        return 1.0
    if 2.0 * min(len(a), len(b)) / total < least or _bag_bound(Counter(a), Counter(b), total) < least:
        return None
    if 2.0 * _common_subsequence(a, b) / total < least:
        return None
    found = exact_ratio(a, b)
    return found if found >= least else None


#: Fixed value: characters from which texts are compared.
LEAST_COMPARED = 18


@F.arrow_udf(DoubleType())
def _ratio(a: pa.Array, b: pa.Array) -> pa.Array:
    return of_each(lambda x, y: None if x is None or y is None or min(len(x), len(y)) < LEAST_COMPARED else exact_ratio(x, y), pa.float64(), a, b)


def unchanged_similarity(source: Column, target: Column, kind: Column) -> Column:
    """How like its source a translation is: 0 for headings and where one of them has under 18 characters."""
    # the UDF sees nulls, and does nothing, for headings; it measures the texts, so that they are folded once
    folded = lambda x: F.when(kind != "heading", normalized(known(x)))
    return F.coalesce(_ratio(folded(source), folded(target)), F.lit(0.0))


def similarity_at_least(source: Column, target: Column, kind: Column, least: float) -> Column:
    """unchanged_similarity where it is ``least`` or more, else 0: most texts are told by bounds."""

    @F.pandas_udf(DoubleType())
    def bounded(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else ratio_at_least(x, y, least) for x, y in zip(a, b, strict=True)], dtype="float64")

    a, b = normalized(known(source)), normalized(known(target))
    counts = (kind != "heading") & (F.least(F.length(a), F.length(b)) >= 18)
    return F.coalesce(bounded(F.when(counts, a), F.when(counts, b)), F.lit(0.0))


#: Fixed value: how like two sentences must be to be one said again.
NEAR = 0.93


def near_repeat(parts: list[str], least: float = NEAR) -> bool:
    """Whether a sentence is equal or nearly equal to one before it: a join of the sentences with themselves, filtered before it is verified.

    Sentences in the order of their lengths: each is paired only with the longer ones that are short enough for the ratio. A pair is dropped where the bag of
    characters, then the longest common subsequence forbids the ratio, and only then verified by difflib, the later sentence first."""
    if len(set(parts)) < len(parts):
        return True
    order = sorted(range(len(parts)), key=lambda i: len(parts[i]))
    lengths = [len(parts[i]) for i in order]
    bags: dict[int, Counter] = {}

    def bag(i: int) -> Counter:
        if i not in bags:
            bags[i] = Counter(parts[i])
        return bags[i]

    for k, i in enumerate(order):
        # of lengths n and m >= n, 2 n / (n + m) is the most; one character more, as the rest is checked exactly
        stop = bisect_left(lengths, int(lengths[k] * (2.0 - least) / least) + 2, lo=k + 1)
        for j in order[k + 1 : stop]:
            total = len(parts[i]) + len(parts[j])
            if 2.0 * len(parts[i]) / total >= least and _bag_bound(bag(i), bag(j), total) >= least:
                first, second = (parts[i], parts[j]) if i < j else (parts[j], parts[i])
                if ratio_at_least(second, first, least) is not None:
                    return True
    return False


@F.pandas_udf(BooleanType())
def _near_repeat(values: pd.Series) -> pd.Series:
    return pd.Series([v is not None and near_repeat(list(v)) for v in values])


def repeated_span(target: Column, norms: Column | None = None) -> Column:
    """A sentence of 35 characters or more that is equal or nearly equal to one before it. norms: the target's folded sentences, if known."""
    found = F.transform(sentences(known(target)), normalized) if norms is None else norms
    long = F.filter(found, lambda s: F.length(s) >= 35)
    return _near_repeat(once(long, lambda parts: F.when(F.size(parts) > 1, parts)))


#: Fixed value: tokens of a block that is said again at once, at most.
MOST_SIZE = 32


@F.arrow_udf(StructType([StructField("size", IntegerType()), StructField("count", IntegerType()), StructField("score", IntegerType()), StructField("phrase", StringType())]))
def _adjacent(lists: pa.Array) -> pa.Array:
    """All rows of a batch at once, over the numbers of their tokens: a block of some size is said again where tokens are equal to those as many before, in a run."""
    n, tokens = len(lists), lists.flatten()
    owner = np.repeat(np.arange(n), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    codes = tokens.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    best = {name: np.zeros(n, np.int32) for name in ("size", "count", "score")}
    begin = np.zeros(n, np.int64)
    for size in range(1, min(MOST_SIZE, len(codes) // 2) + 1):
        at = np.flatnonzero((codes[size:] == codes[:-size]) & (owner[size:] == owner[:-size]))
        first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        count = np.diff(first, append=len(at)) // size + 1
        enough = count >= (3 if size == 1 else 2)
        start, count = at[first[enough]], count[enough]
        # the most often in each row, the first of these; a larger block of the same score is better
        order = np.lexsort((start, -count, owner[start]))
        rows, places = np.unique(owner[start[order]], return_index=True)
        found = order[places]
        better = size * count[found] >= best["score"][rows]
        rows, found = rows[better], found[better]
        best["size"][rows], best["count"][rows], best["score"][rows], begin[rows] = size, count[found], size * count[found], start[found]
    phrases: list[str | None] = [None] * n
    for i in np.flatnonzero(best["score"]):
        phrases[i] = " ".join(tokens.slice(begin[i], best["size"][i]).to_pylist())
    given_back()
    return pa.StructArray.from_arrays([*map(pa.array, best.values()), pa.array(phrases, pa.string())], names=[*best, "phrase"])


def repeated_adjacent(tokens: Column) -> Column:
    """The best block of tokens that is said again at once: size, count, score (their product), phrase; zeros if none."""
    return _adjacent(tokens)


def _chunks(x: Column) -> Column:
    parts = F.regexp_extract_all(x, F.lit(r"(?s).+?(?:[.!?…;:]+[»«”\"’]*(?=\s|$)|$)"), F.lit(0))
    return F.filter(F.transform(parts, stripped), lambda p: p != "")


#: Characters of a clause that may end another one, words that may stand in another one in order, and
#: how like clauses of up to four words, and longer ones, must be.
ENDING_CHARS, ORDERED_WORDS, SHORT_CLAUSE, SHORT_LIKE, LONG_LIKE = 14, 3, 4, 0.80, 0.88


def _ends_the_other(a: str, b: str) -> bool:
    """The shorter clause, of enough characters, is how the longer one ends."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    return len(short) >= ENDING_CHARS and long.endswith(short)


def _stands_in_order(a: list[str], b: list[str]) -> bool:
    """All words of the clause of fewer words, if they are enough, stand in the other one in the same order."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if len(short) < ORDERED_WORDS:
        return False
    at = 0
    for word in long:
        at += at < len(short) and word == short[at]
    return at == len(short)


def _alike(a: str, b: str, most_words: int) -> bool:
    return ratio_at_least(a, b, SHORT_LIKE if most_words <= SHORT_CLAUSE else LONG_LIKE) is not None


def says_again(a: str, b: str) -> bool:
    """Whether folded clause b says a again; empty clauses say nothing."""
    if not a or not b:
        return False
    words_a, words_b = a.split(), b.split()
    return a == b or _ends_the_other(a, b) or _stands_in_order(words_a, words_b) or _alike(a, b, max(len(words_a), len(words_b)))


@F.pandas_udf(StringType())
def _collapsed(chunks: pd.Series, norms: pd.Series, n_source: pd.Series) -> pd.Series:
    out = []
    for parts, norm, n in zip(chunks, norms, n_source, strict=True):
        kept: list[int] = []
        for i in range(len(parts)):
            if not (len(parts) > n and any(says_again(norm[k], norm[i]) for k in kept)):
                kept.append(i)
        out.append(" ".join(parts[i] for i in kept))
    return pd.Series(out, dtype=object)


def collapsed(source: Column, target: Column) -> Column:
    """The target without clauses that say an earlier one again, while it has more clauses than the source."""
    chunks = _chunks(spaced(known(target)))
    return spaced(_collapsed(chunks, F.transform(chunks, normalized), F.size(_chunks(known(source)))))


#: Sizes of character n-grams.
GRAM_SIZES = (3, 4, 5)
#: What Spark's regular expressions take for white space.
_BLANKS = re.compile(r"[ \t\n\x0b\f\r]+")
#: Rows that are handed back at once.
_ROWS = 200_000


def word_grams(word: str) -> list[str]:
    """Character n-grams of a word between blanks; a word no longer than n is one gram, and has no longer ones."""
    padded = f" {word} "
    return [padded[i : i + k] for k in GRAM_SIZES if k == GRAM_SIZES[0] or len(padded) >= k for i in range(max(1, len(padded) - k + 1))]


def gram_counts(texts: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """(keys, gram, tf): how often each character n-gram stands in a text. Each text is counted where it lies; no row is moved for it."""
    kinds = ", ".join(f"`{k}` {texts.schema[k].dataType.simpleString()}" for k in keys)
    rows = texts.select(*keys, bare(known(F.col(text))).alias("_bare"))
    kind_of = [f for f in rows.schema if f.name in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in kind_of]

        def out(owners: list[int], sizes: list[int], grams: list[str], tf: list[int], batch: pa.RecordBatch) -> pa.RecordBatch:
            rows_ = pa.array(np.repeat(owners, sizes))
            own = [batch.column(i).take(rows_).cast(t) for i, t in enumerate(types)]
            return pa.RecordBatch.from_arrays([*own, pa.array(grams, pa.string()), pa.array(tf, pa.int32())], names=[*keys, "gram", "tf"])

        for batch in batches:
            owners, sizes, grams, tf = [], [], [], []
            of: dict[str, list[str]] = {}
            for i, said in enumerate(batch.column(len(keys)).to_pylist()):
                counts: Counter[str] = Counter()
                for word in _BLANKS.split(said or ""):
                    if word:
                        if word not in of:
                            of[word] = word_grams(word)
                        counts.update(of[word])
                if counts:
                    owners.append(i)
                    sizes.append(len(counts))
                    grams += counts.keys()
                    tf += counts.values()
                if len(grams) > _ROWS:
                    yield out(owners, sizes, grams, tf, batch)
                    owners, sizes, grams, tf = [], [], [], []
                if len(of) > _ROWS:
                    of = {}
            if grams:
                yield out(owners, sizes, grams, tf, batch)

    return rows.mapInArrow(run, f"{kinds}, gram string, tf int")


def _raw_weights(texts: DataFrame, group: str, keys: Sequence[str], text: str) -> DataFrame:
    """(group, keys, gram, raw): term frequency times smoothed idf over the texts of a group, dealt out by group and gram. Grams
    are known by 64 bits of hashes from here on."""
    n = texts.groupBy(group).agg(F.count("*").alias("_n"))
    counted = gram_counts(texts.join(n, group), [group, *keys, "_n"], text).withColumn("gram", F.xxhash64("gram"))
    df = F.count("*").over(Window.partitionBy(group, "gram"))
    idf = F.ln((F.lit(1) + F.col("_n")) / (F.lit(1) + df)) + 1
    return counted.withColumn("raw", F.col("tf") * idf).drop("_n", "tf")


def tfidf(texts: DataFrame, group: str, key: str, text: str) -> DataFrame:
    """(group, key, gram, weight): smoothed idf over the texts of a group, vectors of length 1. gram is the hash of a character n-gram."""
    raw = _raw_weights(texts, group, [key], text)
    lengths = raw.groupBy(group, key).agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("_length"))
    return raw.join(lengths, [group, key]).select(group, key, "gram", (F.col("raw") / F.col("_length")).alias("weight"))


#: Paragraphs up to which all those of a chapter that share a gram with an anchor are summed, in one place unless the chapter has more
#: characters or rows than these.
FEW_PARAGRAPHS, FEW_CHARS, FEW_ROWS = 2560, 3_000_000, 5120
#: Grams of an anchor whose lists are read to find what its best paragraphs score at least.
SEED_GRAMS = 24
#: Of what an anchor's best score at least, what its grams that make no pairs may give at most: a smaller share makes more pairs, and fewer of them stay.
TAIL_SHARE = 0.4
#: What sums in another order may differ by.
SLACK = 1e-9
#: Weights of a chapter that lie in one matrix at once, and grams that are known by numbers at once.
_CELLS, _NUMBERED = 1 << 20, 500_000


class _Grams:
    """Character n-grams of texts as numbers; each different word is cut once."""

    def __init__(self) -> None:
        self.numbers: dict[str, int] = {}
        self.of: dict[str, np.ndarray] = {}

    def _word(self, word: str) -> np.ndarray:
        if word not in self.of:
            self.of[word] = np.array([self.numbers.setdefault(g, len(self.numbers)) for g in word_grams(word)])
        return self.of[word]

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(n-grams, how often each stands in the text)."""
        found = [self._word(w) for w in _BLANKS.split(text) if w]
        return np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _cosines(counts: list[tuple[np.ndarray, np.ndarray]], anchors: np.ndarray, paragraphs: np.ndarray, n_texts: int) -> np.ndarray:
    """Cosines of anchors and paragraphs (places in counts) of one chapter of n_texts texts; 0 where they share no n-gram."""
    sizes = [len(grams) for grams, _ in counts]
    owner, tf = np.repeat(np.arange(len(counts)), sizes), np.concatenate([n for _, n in counts])
    _, gram, df = np.unique(np.concatenate([g for g, _ in counts]), return_inverse=True, return_counts=True)
    raw = tf * (np.log((1 + n_texts) / (1 + df)) + 1)[gram]
    lengths = np.sqrt(np.bincount(owner, raw * raw, minlength=len(counts)))
    dots, width = np.zeros((len(anchors), len(paragraphs))), max(1, _CELLS // len(counts))
    if len(df) > width:
        order = np.argsort(gram, kind="stable")
        owner, gram, raw = owner[order], gram[order], raw[order]
    for begin in range(0, len(df), width):
        end = min(begin + width, len(df))
        here = slice(*np.searchsorted(gram, (begin, end))) if len(df) > width else slice(None)
        weights = np.zeros((len(counts), end - begin))
        weights[owner[here], gram[here] - begin] = raw[here]
        dots += weights[anchors] @ weights[paragraphs].T
    return np.divide(dots, np.outer(lengths[anchors], lengths[paragraphs]), out=dots, where=dots > 0)


def _best_of_chapter(rows: dict[str, list], fractions: np.ndarray, grams: _Grams, top: int, pull: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, paragraph, cosine), rows by their places, of the pairs of one chapter that may be among an anchor's best; rows without a key only count."""
    texts: dict[tuple[str, str | None], str] = {}
    for side, key, text in zip(rows["side"], rows["key"], rows["text"], strict=True):
        texts[side, key] = f"{texts[side, key]} {text}" if (side, key) in texts else text
    counts_of = {text: grams.counts(text) for text in set(texts.values())}
    place = {name: i for i, name in enumerate(texts)}
    at = np.array([place[name] for name in zip(rows["side"], rows["key"], strict=True)])
    own = [np.array([i for i, name in enumerate(zip(rows["side"], rows["key"], strict=True)) if name[0] == side and name[1] is not None], np.int64) for side in "ap"]
    if not len(own[0]) or not len(own[1]):
        return own[0][:0], own[1][:0], np.zeros(0)
    cosines = _cosines([counts_of[text] for text in texts.values()], at[own[0]], at[own[1]], len(at))
    score = cosines - pull * np.abs(fractions[own[0]][:, None] - fractions[own[1]][None, :])
    score[(cosines > 0) & np.isnan(score)] = np.inf  # a place that isn't known is first
    score[cosines == 0] = -np.inf
    n = min(top, len(own[1]))
    # what is equal but for rounding stays: Spark orders it
    a, p = np.nonzero((score >= np.partition(score, -n, axis=1)[:, [-n]] - 4 * SLACK) & (cosines > 0))
    return own[0][a], own[1][p], cosines[a, p]


def _best_in_place(both: DataFrame, group: str, top: int, pull: float) -> DataFrame:
    """(group, anchor, paragraph, similarity, fa, fp) of pairs that may be among an anchor's best, of (group, side, key, text, fraction). Rows are
    dealt out by chapter, and a chapter's texts are counted and compared where they meet."""
    rows = both.filter(F.col(group).isNotNull()).select(F.col(group).alias("group"), "side", "key", bare(known(F.col("text"))).alias("text"), "fraction")
    shape = StructType(
        [StructField(group, both.schema[group].dataType), *(StructField(x, StringType()) for x in ("anchor", "paragraph")), *(StructField(x, DoubleType()) for x in ("similarity", "fa", "fp"))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = _Grams()

        def chapters(table: pa.Table, ends: list[int]) -> Iterator[pa.RecordBatch]:
            nonlocal grams
            found = []
            for begin, end in pairwise(ends):
                if len(grams.numbers) > _NUMBERED or len(grams.of) > _NUMBERED:
                    grams = _Grams()
                part = table.slice(begin, end - begin)
                a, p, cosine = _best_of_chapter(part.select(["side", "key", "text"]).to_pydict(), part["fraction"].to_numpy().astype(float), grams, top, pull)
                found.append((a + begin, p + begin, cosine))
            if found:
                a, p, cosine = (np.concatenate(x) for x in zip(*found, strict=True))
                out = [table["group"].take(a), table["key"].take(a), table["key"].take(p), pa.array(cosine), table["fraction"].take(a), table["fraction"].take(p)]
                yield from pa.table(out, names=shape.names).combine_chunks().to_batches()

        # the last chapter of a batch may go on in the next one
        left: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if left is None else pa.concat_tables([left, table])
            names = table["group"].to_pylist()
            ends = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1])]
            yield from chapters(table, ends)
            left = table.slice(ends[-1]).combine_chunks()
        if left is not None:
            yield from chapters(left, [0, len(left)])
        given_back()

    return rows.repartition("group").sortWithinPartitions("group").mapInArrow(run, shape)


def aligned(anchors: DataFrame, paragraphs: DataFrame, group: str = "chapter", top: int = 3, pull: float = 0.12, few: int = FEW_PARAGRAPHS) -> DataFrame:
    """For each anchor (group, key, text, fraction) the best ``top`` paragraphs (group, key, text, fraction) of its group, by
    the cosine of their n-grams less ``pull`` times how far apart they stand.

    A chapter of at most ``few`` paragraphs is scored in one place. Those of larger ones (or of very many characters) are dealt out by
    n-gram, and only those are summed up that may be among the best (``best_by_bounds``)."""
    side = lambda rows, name: rows.select(group, F.lit(name).alias("side"), F.col("key").cast("string").alias("key"), "text", F.col("fraction").cast("double").alias("fraction"))
    both = side(anchors, "a").unionByName(side(paragraphs, "p"))
    sizes = both.groupBy(group).agg(F.count_if(F.col("side") == "p").alias("n"), F.sum(F.length("text")).alias("chars"), F.count("*").alias("rows"))
    large = kept(sizes.filter((F.col("n") > few) | (F.col("chars") > FEW_CHARS) | (F.col("rows") > FEW_ROWS)).select(group))
    if large.isEmpty():
        scored = _best_in_place(both, group, top, pull)
    else:
        scored = _best_in_place(both.join(large, group, "left_anti"), group, top, pull)
        both = both.join(large, group, "left_semi")
        raw = _raw_weights(both, group, ["side", "key"], "text")
        lengths = raw.groupBy(group, "side", "key").agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("length"))
        weights = kept(raw.join(lengths, [group, "side", "key"]).select(group, "side", "key", "gram", (F.col("raw") / F.col("length")).alias("weight")))
        a = weights.filter("side = 'a'").select(group, F.col("key").alias("anchor"), "gram", F.col("weight").alias("wa"))
        p = weights.filter("side = 'p'").select(group, F.col("key").alias("paragraph"), "gram", F.col("weight").alias("wp"))
        places = [kept(both.filter(F.col("side") == x[0]).select(group, F.col("key").alias(x), F.col("fraction").alias(f"f{x[0]}"))) for x in ("anchor", "paragraph")]
        scored = scored.unionByName(best_by_bounds(a, p, *places, group, top, pull))
    adjusted = F.col("similarity") - pull * F.abs(F.col("fp") - F.col("fa"))
    best = Window.partitionBy(group, "anchor").orderBy(F.round(-adjusted, 9), "fp")
    return scored.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= top).select(group, "anchor", "paragraph", "similarity", "place")


def _partial(grams: DataFrame, p: DataFrame, anchors: DataFrame, paragraphs: DataFrame, group: str, pull: float) -> DataFrame:
    """Pairs that share one of these grams: their score by them, the length of the paragraph's part that was seen, and what their places cost."""
    sums = grams.join(p, [group, "gram"]).groupBy(group, "anchor", "paragraph").agg(F.sum(F.col("wa") * F.col("wp")).alias("score"), F.sum(F.col("wp") * F.col("wp")).alias("seen"))
    placed = sums.join(anchors, [group, "anchor"]).join(paragraphs, [group, "paragraph"])
    return placed.withColumn("off", pull * F.abs(F.col("fp") - F.col("fa")))


def _with_more(pairs: DataFrame, grams: DataFrame, p: DataFrame, group: str) -> DataFrame:
    """pairs with the score that these grams of their anchors add."""
    asked = p.join(pairs.select(group, "paragraph").distinct(), [group, "paragraph"], "left_semi")
    more = (
        pairs.select(group, "anchor", "paragraph").join(grams.select(group, "anchor", "gram", "wa"), [group, "anchor"])
        .join(asked, [group, "paragraph", "gram"]).groupBy(group, "anchor", "paragraph").agg(F.sum(F.col("wa") * F.col("wp")).alias("more"))
    )
    return pairs.join(more, [group, "anchor", "paragraph"], "left").withColumn("score", F.col("score") + F.coalesce("more", F.lit(0.0))).drop("more")


def in_impact_order(a: DataFrame, p: DataFrame, anchors: DataFrame, paragraphs: DataFrame, group: str, top: int, pull: float) -> DataFrame:
    """a with n (a gram's place by impact), rest (what it and all after it give a paragraph at most), length (of their part of the vector), least
    (what the anchor's top-th best paragraph scores at least), and makes_pairs."""
    most = p.groupBy(group, "gram").agg(F.max("wp").alias("most"))
    by_impact = Window.partitionBy(group, "anchor").orderBy(F.desc("impact"), "gram")
    on = by_impact.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ordered = kept(
        a.join(most, [group, "gram"])
        .withColumn("impact", F.col("wa") * F.col("most"))
        .withColumn("n", F.row_number().over(by_impact))
        .withColumn("length", F.sqrt(F.sum(F.col("wa") * F.col("wa")).over(on)))
        .withColumn("rest", F.least(F.sum("impact").over(on), "length"))
        .drop("most", "impact")
    )

    def nth(rows: DataFrame, most: int) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(group, "anchor").orderBy(F.desc(F.col("score") - F.col("off")), "paragraph"))
        return rows.withColumn("nth", place).filter(F.col("nth") <= most)

    # the best by few grams, scored wholly: the top-th best of all scores as much as the top-th best of these at least
    seeds = kept(nth(_partial(ordered.filter(F.col("n") <= SEED_GRAMS), p, anchors, paragraphs, group, pull), 2 * top))
    least = nth(_with_more(seeds, ordered.filter(F.col("n") > SEED_GRAMS), p, group), top).filter(F.col("nth") == top)
    least = least.select(group, "anchor", (F.col("score") - F.col("off")).alias("least"))
    makes = F.coalesce(F.col("rest") >= TAIL_SHARE * F.col("least") - SLACK, F.lit(True))
    return ordered.join(least, [group, "anchor"], "left").withColumn("makes_pairs", makes)


def best_by_bounds(a: DataFrame, p: DataFrame, anchors: DataFrame, paragraphs: DataFrame, group: str, top: int, pull: float) -> DataFrame:
    """(group, anchor, paragraph, similarity, fa, fp) of all pairs that may be among an anchor's best ``top``, of a (group, anchor, gram, wa),
    p (group, paragraph, gram, wp), and the places (fa, fp) of both.

    An anchor's grams are ordered by impact: its weight times the largest one that any paragraph has. The lists of the first
    few give partial scores; the best of these are scored wholly, and the top-th of them, less the pull of its place, is what the best ones score
    at least. What grams at the end give a paragraph is at most the sum of their impacts, and at most the length of their part of the anchor's
    vector, as vectors have length 1. Where that is TAIL_SHARE of the least, they can't lift a paragraph among the best alone, so their lists, the
    longest ones, make no pairs; they are only added to the pairs that the other grams found, and that what is missing may still lift."""
    known = kept(in_impact_order(a, p, anchors, paragraphs, group, top, pull))
    tail = known.filter(~F.col("makes_pairs"))
    bounds = known.groupBy(group, "anchor").agg(
        F.max("least").alias("least"), F.max(F.when(~F.col("makes_pairs"), F.col("rest"))).alias("missing"), F.max(F.when(~F.col("makes_pairs"), F.col("length"))).alias("tail_length")
    )
    found = _partial(known.filter("makes_pairs").select(group, "anchor", "gram", "wa"), p, anchors, paragraphs, group, pull).join(bounds, [group, "anchor"])
    unseen = F.sqrt(F.greatest(F.lit(0.0), 1.0 - F.col("seen") + SLACK)) * F.col("tail_length")
    lift = F.coalesce(F.least("missing", unseen), F.lit(0.0))
    can = F.coalesce(F.col("score") + lift - F.col("off") >= F.col("least") - SLACK, F.lit(True))
    pairs = kept(found.filter(can).select(group, "anchor", "paragraph", "score", "fa", "fp"))
    return _with_more(pairs, tail, p, group).select(group, "anchor", "paragraph", F.col("score").alias("similarity"), "fa", "fp")


def token_grams(rows: DataFrame, key: str, tokens: Column, size: int) -> DataFrame:
    """(key, gram): each run of ``size`` tokens of a row, once."""
    grams = F.transform(F.sequence(F.lit(1), F.size("_t") - size + 1), lambda i: F.array_join(F.slice("_t", i, F.lit(size)), " "))
    return rows.select(key, tokens.alias("_t")).filter(F.size("_t") >= size).select(key, F.explode(F.array_distinct(grams)).alias("gram"))


#: Grams up to which a side is broadcast, some 60 bytes each.
FEW_GRAMS = 1_000_000


def shared_grams(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """(left_key, right_key, grams): how many grams (key, gram) two rows have in common. A right side of at most FEW_GRAMS grams is
    counted first and broadcast; a larger one is summed up by gram, so that a gram that very many rows hold is split by AQE."""
    few = right.limit(FEW_GRAMS + 1).count() <= FEW_GRAMS
    return left.join(F.broadcast(right) if few else right, "gram").groupBy(left_key, right_key).agg(F.count("*").alias("grams"))
