"""Benchmark passages in training documents, found with suffix arrays of the documents, and removal of the documents that hold them.

Words are runs of letters a-z (A-Z lower-cased), digits and all that isn't ASCII. A window of an item is ``WIDTH`` words in a row, or the whole of an item
that has fewer. A word of a document is hit if it lies in an occurrence of a window.

The items are the stated query set: they are cut into blocks of bounded size, and each block goes against all documents in one pass. Documents aren't moved:
each task cuts its documents into shards and makes a suffix array of each shard over word numbers, by Larsson and Sadakane's doubling. Words that no item of the block has, and
runs of words that are shorter than the shortest window, can't be in an occurrence and are left out. Every different suffix of the items is
binary-searched in each shard: its place gives its longest match there, and if that is as long as its window, two more
searches give all places where the window occurs. Equal windows are located once, so places are at most ten a word, however often an item
repeats itself. The longest match of each place is found the other way round, by binary search among the items' suffixes.

Null and empty texts have no words. An item without an id hits words, but is neither counted nor named; rows of one item_id are one item. Rows that repeat a doc_id are judged
each by itself. Without items nothing is hit; an empty table gives an empty table. Columns of any name are kept by ``decontaminated``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import written

WIDTH = 10
#: Bytes of documents in a shard, and of items in a block; passes that are chained before their result is written.
SHARD_BYTES, BLOCK_BYTES, CHAINED = 8 << 20, 8 << 20, 4
_WORDS = bytes(i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


# ---------------------------------------------------------------- suffix arrays over word numbers


def word_suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Places of data (non-negative numbers) in the order of what stands from each on, as far as ``depth`` numbers.

    Groups of like beginnings are told apart by the rank of what follows them, twice as far each time; groups of one are ready."""
    n = len(data)
    order = np.argsort(data, kind="stable")
    new = np.ones(n, dtype=bool)
    new[1:] = data[order][1:] != data[order][:-1]
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1] if n else 0
    have = 1
    while have < depth:
        size = np.diff(np.append(np.flatnonzero(new), n))
        open_ = np.flatnonzero(np.repeat(size > 1, size))
        if not len(open_):
            break
        of = order[open_]
        group = rank[of]
        after = np.where(of + have < n, rank[np.minimum(of + have, n - 1)] + 1, 0)
        by = np.lexsort((after, group))
        order[open_] = of[by]
        split = np.ones(len(by), dtype=bool)
        split[1:] = (group[by][1:] != group[by][:-1]) | (after[by][1:] != after[by][:-1])
        new[open_] = split
        rank[order[open_]] = np.maximum.accumulate(np.where(split, open_, 0))
        have *= 2
    return order


def _common(query: np.ndarray, a: np.ndarray, data: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many numbers query[a:] and data[b:] have in common, up to most; both end in a zero, which is in common with nothing."""
    common = np.zeros(len(a), dtype=np.int64)
    going = np.flatnonzero(most > 0)
    while len(going):
        at = common[going]
        x = query[a[going] + at]
        same = (x == data[b[going] + at]) & (x > 0)
        going = going[same]
        common[going] += 1
        going = going[common[going] < most[going]]
    return common


def _place(query: np.ndarray, a: np.ndarray, most: np.ndarray, data: np.ndarray, order: np.ndarray, past: bool) -> np.ndarray:
    """By binary search: how many suffixes of data come before query[a : a + most]; with ``past``, those too that begin with it."""
    low, high = np.zeros(len(a), dtype=np.int64), np.full(len(a), len(order))
    while len(open_ := np.flatnonzero(low < high)):
        mid = (low[open_] + high[open_]) // 2
        at, of, m = order[mid], a[open_], most[open_]
        common = _common(query, of, data, at, m)
        whole = common == m
        before = np.where(whole, past, data[at + common] < query[of + np.minimum(common, m - 1)])
        low[open_[before]] = mid[before] + 1
        high[open_[~before]] = mid[~before]
    return low


# ---------------------------------------------------------------- a block of items


@dataclass
class Block:
    """Items as numbers of words, one after another with a zero after each; their suffixes in order; and windows that differ."""

    vocabulary: dict[bytes, int]
    words: np.ndarray
    order: np.ndarray
    #: Where each suffix that begins a window starts, how long it is, and which window it begins.
    start: np.ndarray
    rest: np.ndarray
    window: np.ndarray
    #: Where each window stands once, and its width; items[cut[w] : cut[w + 1]] (numbers in ids) are the items that have it.
    at: np.ndarray
    width: np.ndarray
    cut: np.ndarray
    items: np.ndarray
    ids: list[str]
    widest: int


def block_of(rows: list[tuple[int | None, str | None]], width: int = WIDTH) -> Block:
    vocabulary: dict[bytes, int] = {}
    names = sorted({str(i) for i, _ in rows if i is not None})
    number = {x: k for k, x in enumerate(names)}
    parts, sizes, owners = [], [], []
    for item, text in rows:
        found = words_of((text or "").encode("utf-8", "surrogatepass"))
        parts.append(np.array([*(vocabulary.setdefault(w, len(vocabulary) + 1) for w in found), 0], dtype=np.int64))
        sizes.append(len(found))
        owners.append(-1 if item is None else number[str(item)])
    words = np.concatenate([*parts, np.zeros(1, dtype=np.int64)])
    size, owner = np.array(sizes, dtype=np.int64), np.array(owners, dtype=np.int64)
    order = word_suffix_array(words, int(size.max(initial=0)) + 1)
    # every place's item, how many of its words are left, and how many of them a window takes
    item = np.append(np.repeat(np.arange(len(size)), size + 1), len(size))
    left = np.append(np.repeat(np.cumsum(size + 1), size + 1), len(words)) - 1 - np.arange(len(words))
    wide = np.append(np.minimum(width, size), 0)[item]
    starts = (left >= wide) & (wide > 0)
    sorted_ = order[starts[order]]
    # equal windows of one width are neighbours among the suffixes whose windows have that width
    sorted_ = sorted_[np.argsort(wide[sorted_], kind="stable")]
    same = np.zeros(len(sorted_), dtype=bool)
    if len(sorted_):
        w = wide[sorted_[1:]]
        same[1:] = (w == wide[sorted_[:-1]]) & (_common(words, sorted_[1:], words, sorted_[:-1], w) == w)
    window = np.cumsum(~same) - 1
    at = sorted_[~same]
    named = owner[item[sorted_]] if len(size) else np.zeros(0, dtype=np.int64)
    pairs = np.unique(np.stack((window[named >= 0], named[named >= 0])), axis=1)
    cut = np.searchsorted(pairs[0], np.arange(len(at) + 1))
    return Block(vocabulary, words, order, sorted_, left[sorted_], window, at, wide[at], cut, pairs[1], names, width)


def search(block: Block, texts: list[bytes]) -> tuple[list[int], list[list[tuple[int, int]]], list[list[str]], list[int]]:
    """Of a shard, per text: its words, spans of hit words [from, to), the ids of items with occurring windows, and the longest match."""
    get = block.vocabulary.get
    counts, parts = [], []
    for text in texts:
        found = words_of(text)
        counts.append(len(found))
        parts.append(np.fromiter(map(get, found, repeat(0)), dtype=np.int32, count=len(found)))
        parts.append(np.zeros(1, dtype=np.int32))
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    named: list[list[str]] = [[] for _ in texts]
    longest = [0] * len(texts)
    if not len(block.start) or not texts:
        return counts, spans, named, longest
    numbers = np.concatenate(parts)
    # runs of known words that a window fits into; after each a zero, so that nothing matches from one into the next
    known = np.concatenate(([False], numbers > 0, [False]))
    first, end = np.flatnonzero(~known[:-1] & known[1:]), np.flatnonzero(known[:-1] & ~known[1:])
    fits = end - first >= block.width.min()
    first, end = first[fits], end[fits]
    if not len(first):
        return counts, spans, named, longest
    size = end - first + 1
    where = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
    # the word after a run is unknown or an end, so it is the zero
    data = np.append(numbers[where], 0).astype(np.int64)
    order = word_suffix_array(data, int(block.rest.max()) + 1)
    # each suffix's place among those of the shard: what it has most in common with stands next to it
    at = _place(block.words, block.start, block.rest, data, order, False)
    near = [_common(block.words, block.start, data, order[np.clip(x, 0, len(order) - 1)], block.rest) for x in (at - 1, at)]
    hit = np.unique(block.window[np.maximum(*near) >= block.width[block.window]])
    if not len(hit):
        return counts, spans, named, longest
    low, high = (_place(block.words, block.at[hit], block.width[hit], data, order, past) for past in (False, True))
    n = high - low
    place = order[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    window = np.repeat(hit, n)
    wide = block.width[window]
    change = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(change, place, 1)
    np.add.at(change, place + wide, -1)
    covered = np.concatenate(([False], np.cumsum(change)[: len(data)] > 0, [False]))
    lows, highs = np.flatnonzero(~covered[:-1] & covered[1:]), np.flatnonzero(covered[:-1] & ~covered[1:])
    starts = np.concatenate(([0], np.cumsum(np.array(counts) + 1)))
    place_of = lambda x: np.searchsorted(starts, where[x], side="right") - 1
    for doc, a, b in zip(place_of(lows).tolist(), where[lows].tolist(), where[highs - 1].tolist(), strict=True):
        spans[doc].append((a - int(starts[doc]), b + 1 - int(starts[doc])))
    # the other way round: what the shard's suffix at each of these places has most in common with, among the suffixes of the items
    doc_of = place_of(place)
    once = np.unique(place)
    stop = np.flatnonzero(data == 0)
    rest = stop[np.searchsorted(stop, once)] - once
    beside = _place(data, once, rest, block.words, block.order, False)
    lengths = np.maximum(*(_common(data, once, block.words, block.order[np.clip(x, 0, len(block.order) - 1)], rest) for x in (beside - 1, beside)))
    best = np.zeros(len(texts), dtype=np.int64)
    np.maximum.at(best, place_of(once), np.where(lengths >= block.widest, lengths, 0))
    np.maximum.at(best, doc_of, wide)
    longest = best.tolist()
    pair = np.unique(doc_of * np.int64(len(block.at)) + window)
    docs, windows = pair // len(block.at), pair % len(block.at)
    seen: dict[bytes, list[str]] = {}
    for doc in np.unique(docs).tolist():
        mine = windows[np.searchsorted(docs, doc) : np.searchsorted(docs, doc, side="right")]
        if (key := mine.tobytes()) not in seen:
            some = np.unique(np.concatenate([block.items[block.cut[w] : block.cut[w + 1]] for w in mine.tolist()]))
            seen[key] = [block.ids[i] for i in some.tolist()]
        named[doc] = seen[key]
    return counts, spans, named, longest


# ---------------------------------------------------------------- the job


def _blocks(bench: DataFrame) -> Iterator[Block]:
    """The items in blocks of BLOCK_BYTES, about: one at a time is on the driver. Equal rows are one."""
    rows = bench.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long") + 64), F.lit(0))).first()[0]
    many = -(-2 * total // BLOCK_BYTES) if total > BLOCK_BYTES else 1
    if many > 1:
        rows = written(rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(many))))
    for k in range(many):
        some = rows.filter(F.col("block") == k) if many > 1 else rows
        yield block_of([(r["item_id"], r["text"]) for r in some.collect()])


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_FOUND = [("n_words", pa.int64()), ("spans", pa.list_(_SPAN)), ("items", pa.list_(pa.string())), ("longest", pa.int32())]


def _passes(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """docs (columns c0, c1, ... with the text at c0) with n_words, spans, items and longest: a pass for each block of items."""
    columns = docs.columns
    many = len(columns)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema) + ", n_words long, spans array<struct<start:int,end:int>>, items array<string>, longest int"

    def against(block: Block, again: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = [t or b"" for t in batch.column(0).cast(pa.binary()).to_pylist()]
                found: tuple[list, ...] = ([], [], [], [])
                ends = np.cumsum([len(t) for t in texts])
                cut = np.concatenate(([0], np.flatnonzero(np.diff(ends // SHARD_BYTES)) + 1, [len(texts)])).tolist()
                for a, b in zip(cut[:-1], cut[1:], strict=True):
                    for column, more in zip(found, search(block, texts[a:b]), strict=True):
                        column += more
                if again:
                    _, spans, items, longest = (batch.column(many + i).to_pylist() for i in range(4))
                    found = (
                        found[0],
                        [_merged([*((s["start"], s["end"]) for s in x), *y]) for x, y in zip(spans, found[1], strict=True)],
                        [sorted({*x, *y}) for x, y in zip(items, found[2], strict=True)],
                        [max(x, y) for x, y in zip(longest, found[3], strict=True)],
                    )
                own = [batch.column(i) for i in range(many)]
                shaped = [[{"start": a, "end": b} for a, b in x] for x in found[1]]
                made = [pa.array(x, t) for x, (_, t) in zip((found[0], shaped, *found[2:]), _FOUND, strict=True)]
                yield pa.RecordBatch.from_arrays([*own, *made], names=[*columns, *(k for k, _ in _FOUND)])

        return run

    found = docs
    for k, block in enumerate(_blocks(bench)):
        found = found.mapInArrow(against(block, k > 0), schema)
        if k % CHAINED == CHAINED - 1:
            found = written(found)
    return found


def matches(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, spans (hit words, [start, end)), items (ids of items with occurring windows, sorted as strings) and
    longest (the most words in a row that it has in common with an item, of at least a window)."""
    inner = docs.select(F.col("text").alias("c0"), F.col("doc_id").alias("c1"))
    return _passes(inner, bench).select(F.col("c1").alias("doc_id"), "n_words", "spans", "items", "longest")


def contamination(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The contract's columns."""
    found = matches(docs, bench)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """docs with all its columns, without the documents that hold a window of an item."""
    names = docs.columns
    others = [c for c in names if c != "text"]
    inner = docs.select(F.col("text").alias("c0"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others, 1)])
    place = {"text": 0} | {c: i for i, c in enumerate(others, 1)}
    return _passes(inner, bench).filter(F.size("spans") == 0).select(*[F.col(f"c{place[c]}").alias(c) for c in names])


ORACLE = """WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest(list_transform(generate_series(1, len(w) - least(len(w), 10) + 1), lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS x FROM b WHERE len(w) > 0),
widths AS (SELECT DISTINCT n FROM windows),
places AS (SELECT r, n, unnest(generate_series(1, len(w) - n + 1)) AS i, w FROM d JOIN widths ON len(w) >= n),
found AS (SELECT r, p.n, i, item_id FROM (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS x FROM places) p JOIN windows b ON b.x = p.x AND b.n = p.n),
hits AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS k FROM found) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS named FROM (SELECT DISTINCT r, item_id::VARCHAR AS s FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(named, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)"""
