"""Removal of passages that an earlier document holds, byte by byte, with suffix arrays.

A byte of a document goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller doc_id.
Which strings of 50 bytes (windows) are repeats is found in steps, each of which only spares work:

1. Texts are packed into rows of about 2 MB, a table bucketed by pack, so that what is found elsewhere joins it without
   moving texts again. In each window the 24-gram with the least hash is its anchor. Equal windows have equal anchors at equal
   places, so a window whose anchor no other document has isn't repeated. Anchors are counted over all packs.
2. The windows that share one anchor make a context, the bytes that these windows cover. Contexts are known by 128 bits of
   hashes. All windows of a context that an earlier document has are repeats; each pack sends a context once.
3. Contexts with like anchors but different surroundings (at the edges of repeated passages) are compared window by window,
   only in their first document: they are dealt out by anchor into shards of bounded size; each shard is sorted into a suffix array
   by Larsson and Sadakane's refinement, Kasai's common prefixes cut it into runs of equal windows, and the sorted
   windows of different shards are merged by binary search. An anchor with very many surroundings is dealt out by window.

Null texts are empty. Texts of under 50 bytes lose nothing. Rows that repeat a doc_id aren't earlier than each other; rows with a
null doc_id lose nothing and are nobody's earlier document. An empty table gives an empty table. All other columns are kept by
``without_repeats``; ``repeats`` has its own only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import lean, written
from corpusloom.llm.exchange import buckets_for, placed, token_counts
from corpusloom.llm.packs import longs, packed
from corpusloom.llm.shingles import mixed

LENGTH, GRAM, SIDE = 50, 24, 13
SLICE_BYTES = 1 << 18
#: Bytes of a suffix array, and contexts of one anchor that stay together.
SHARD_BYTES, TOGETHER = 1 << 20, 20_000
#: Bytes of pieces that go on in one frame, about.
FRAME_BYTES = 4 << 20
_U = np.uint64
_A, _B = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)
ALONE, REPEATED, OPEN, SPREAD = 0, 1, 2, 3


# ---------------------------------------------------------------- anchors and contexts


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _A + b * _B
    x ^= x >> _U(32)
    return x


def gram_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of the GRAM bytes from each position on, and one of eight bytes."""
    h1 = data.astype(np.uint64) + _U(1)
    h2 = _joined(h1[:-1], h1[1:])
    h4 = _joined(h2[:-2], h2[2:])
    h8 = _joined(h4[:-4], h4[4:])
    h16 = _joined(h8[:-8], h8[8:])
    return mixed(_joined(h16[: len(data) - GRAM + 1], h8[16 : 16 + len(data) - GRAM + 1])), h8


def anchors(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """For texts one after another in data: runs of windows with one anchor.

    Gives the first window's start, the number of windows, the text's number, the anchor's hash, the context's hash, and a
    hash of the SIDE bytes before the anchor and of those after it. (All windows hold the anchor, and SIDE bytes before or after
    it.) Texts are worked through some at a time, so that what is held besides stays small."""
    ends = np.cumsum(lengths)
    cut = np.unique(np.concatenate(([0], np.flatnonzero(np.diff(ends // SLICE_BYTES)) + 1, [len(lengths)])))
    parts = []
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        at = int(ends[a] - lengths[a])
        first, many, text, *hashes = _anchors(data[at : int(ends[b - 1])], lengths[a:b])
        parts.append((first + at, many, text + a, *hashes))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else _anchors(data[:0], lengths)


def _anchors(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    none = np.zeros(0, dtype=np.int64)
    if len(data) < LENGTH:
        return none, none, none, *[none.astype(np.uint64)] * 4
    h, h8 = gram_hashes(data)
    bits = _U(max(24, len(h).bit_length()))
    low = (_U(1) << bits) - _U(1)
    least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    wide, have = LENGTH - GRAM + 1, 1
    while have * 2 <= wide:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    least = np.minimum(least[: len(least) - (wide - have)], least[wide - have :])
    place = (least & low).astype(np.int64)
    # windows that end inside their own text
    text = np.repeat(np.arange(len(lengths)), lengths)
    inside = text[: len(place)] == text[LENGTH - 1 : LENGTH - 1 + len(place)]
    start = np.concatenate(([True], place[1:] != place[:-1]))
    start[1:] |= inside[1:] & ~inside[:-1]
    first = np.flatnonzero(start & inside)
    stop = np.flatnonzero(np.concatenate((start[1:] | ~inside[1:], [True])) & inside)
    many, at = stop - first + 1, place[first]
    end = first + many - 1 + LENGTH
    tail = end - GRAM
    context = h[first] * _A + h[first + GRAM] * _B
    context = mixed(context) + h[np.minimum(first + 2 * GRAM, tail)] * _A
    context = mixed(context) + h[tail] * _B + (many * 64 + (at - first)).astype(np.uint64)
    context = mixed(context)
    # a side that the context doesn't reach SIDE bytes of is like no other
    left = np.where(at - first >= SIDE, _joined(h8[np.maximum(at - SIDE, 0)], h8[np.maximum(at - 8, 0)]), context)
    after = np.minimum(at + GRAM, len(h8) - 1)
    right = np.where(end - at - GRAM >= SIDE, _joined(h8[after], h8[np.minimum(after + SIDE - 8, len(h8) - 1)]), context)
    return first, many, text[first], h[at], context, left, right


# ---------------------------------------------------------------- suffix arrays


def suffix_array(data: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Positions of data in the order of the ``depth`` bytes (or more) from each one on.

    Larsson and Sadakane: groups of like beginnings are refined by the rank of what follows, twice as far each time; groups of one
    are ready and aren't touched again."""
    n = len(data)
    padded = np.concatenate((data, np.zeros(8, dtype=np.uint8))).astype(np.uint64)
    key = np.zeros(n, dtype=np.uint64)
    for i in range(7):  # seven bytes, each plus one, so that the end sorts first
        key = key * _U(257) + np.where(np.arange(n) + i < n, padded[i : i + n] + _U(1), _U(0))
    order = np.argsort(key, kind="stable")
    new = np.concatenate(([True], key[order][1:] != key[order][:-1]))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    have = 7
    while have < depth:
        size = np.diff(np.append(np.flatnonzero(new), n))
        open_ = np.flatnonzero(np.repeat(size > 1, size))
        if not len(open_):
            break
        of = order[open_]
        group = rank[of]
        after = np.where(of + have < n, rank[np.minimum(of + have, n - 1)] + 1, 0)
        by = np.argsort(group * (n + 2) + after, kind="stable")
        order[open_] = of[by]
        split = np.concatenate(([True], (group[by][1:] != group[by][:-1]) | (after[by][1:] != after[by][:-1])))
        new[open_] = split
        heads = np.where(split, open_, 0)
        rank[order[open_]] = np.maximum.accumulate(heads)
        have *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Kasai: how much each suffix has in common with the one before it in order, counted up to depth.

    Where a text position has the same neighbour as the position before, both one further on, it has one less in common, unless
    that had nothing. So of such a run only the first is compared, eight bytes at a time and as far as the run needs it, and
    then the first one past the place where they differ; all runs go along together."""
    n = len(data)
    before = np.empty(n, dtype=np.int64)
    before[order] = np.concatenate(([-1], order[:-1]))
    padded = np.concatenate((data, np.zeros(depth + 8, dtype=np.uint8))).astype(np.uint64)
    word = np.zeros(n + depth, dtype=np.uint64)
    for i in range(8):
        word = word << _U(8) | padded[i : i + n + depth]
    out = np.zeros(n, dtype=np.int64)
    first = np.flatnonzero(np.concatenate(([True], (before[1:] != before[:-1] + 1) | (before[:-1] < 0))))
    run = np.diff(np.append(first, n))
    while len(first):
        a, b = first, before[first]
        far = np.where(b >= 0, np.minimum(run + depth, n - np.maximum(a, b)), 0)
        common = np.zeros(len(first), dtype=np.int64)
        going = np.flatnonzero(far > 0)
        while len(going):
            off = word[a[going] + common[going]] ^ word[b[going] + common[going]]
            same = np.full(len(going), 8)
            for k in range(8):
                same -= off >= _U(1 << (8 * k))
            common[going] += same
            going = going[(same == 8) & (common[going] < far[going])]
        common = np.minimum(common, far)
        # positions up to the place where they differ
        known = np.minimum(run, common + 1)
        at = np.repeat(first - (np.cumsum(known) - known), known) + np.arange(known.sum())
        out[at] = np.repeat(common, known) - (at - np.repeat(first, known))
        rest = run > known
        first, run = (first + known)[rest], (run - known)[rest]
    return np.clip(out, 0, depth)[order]


def shard_windows(contexts: list[bytes], owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of contexts with the ids of their documents: sorted different windows, the least id of each, and which of
    these each window of each context is, context by context."""
    data = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    size = np.array([len(c) for c in contexts])
    order = suffix_array(data)
    common = common_prefixes(data, order)
    valid = np.concatenate([np.arange(s) <= s - LENGTH for s in size])
    owner = np.repeat(owners, size)
    # equal windows are neighbours, with others between them that only reach over a context's end
    run = np.cumsum(common < LENGTH) - 1
    kept = valid[order]
    runs, which = np.unique(run[kept], return_inverse=True)
    least = np.full(len(runs), np.iinfo(np.int64).max)
    np.minimum.at(least, which, owner[order[kept]])
    first = np.full(len(runs), -1)
    first[which[::-1]] = order[kept][::-1]
    rows = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[first]
    # a last byte that isn't zero, so that zeros before it count
    windows = np.ascontiguousarray(np.concatenate((rows, np.ones((len(rows), 1), dtype=np.uint8)), 1)).view(f"S{LENGTH + 1}").ravel()
    back = np.full(len(data), -1)
    back[order[kept]] = which
    return windows, least, back[valid]


def window_hashes(windows: np.ndarray) -> np.ndarray:
    rows = np.zeros((len(windows), -(-windows.itemsize // 8) * 8), dtype=np.uint8)
    rows[:, : windows.itemsize] = windows.view(np.uint8).reshape(len(windows), windows.itemsize)
    out = np.zeros(len(windows), dtype=np.uint64)
    for word in rows.view("<u8").T:
        out = mixed(out * _A + word * _B)
    return out


def merged_least(shards: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """For sorted windows of shards and the least id of each: the least id of all shards, by binary search.

    Only windows whose hash some other shard has, too, are looked for."""
    out = [least.copy() for _, least in shards]
    if len(shards) < 2:
        return out
    _, which, n = np.unique(np.concatenate([window_hashes(w) for w, _ in shards]), return_inverse=True, return_counts=True)
    ends = np.cumsum([len(w) for w, _ in shards])
    shared = [np.flatnonzero(n[which[e - len(w) : e]] > 1) for (w, _), e in zip(shards, ends.tolist(), strict=True)]
    some = [windows[at] for (windows, _), at in zip(shards, shared, strict=True)]
    for i, windows in enumerate(some):
        for j, other in enumerate(some):
            if i != j and len(other):
                at = np.minimum(np.searchsorted(other, windows), len(other) - 1)
                same = other[at] == windows
                mine = shared[i][same]
                out[i][mine] = np.minimum(out[i][mine], shards[j][1][shared[j][at[same]]])
    return out


# ---------------------------------------------------------------- the job


def _anchored(row: object) -> tuple[np.ndarray, ...]:
    """anchors() of a pack, without those of documents without an id."""
    found = anchors(np.frombuffer(row.texts, dtype=np.uint8), longs(row.lengths))
    named = longs(row.ids)[found[2]] < np.iinfo(np.int64).max
    return tuple(x[named] for x in found)


def _dealt(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cut)):
        yield int(b), order[cut[b] : cut[b + 1]]


def _by_key(frames: Iterator[pd.DataFrame], key: str) -> Iterator[tuple[int, list]]:
    """Rows of each key, of frames sorted by it."""
    at, held = None, []
    for frame in frames:
        for row in frame.itertuples():
            if getattr(row, key) != at and held:
                yield at, held
                held = []
            at = getattr(row, key)
            held.append(row)
    if held:
        yield at, held


def _judged(docs: DataFrame) -> tuple[DataFrame, Callable[[object], np.ndarray]]:
    """Packs with all that was found of them, and a function that says of such a row which bytes are to go."""
    packs, total = packed(docs)

    # 1. anchors that stand in several places
    def grams_of(found_: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A pack's different anchors, which of them several of its documents have, and which one each anchor is."""
        text, f = found_[2], found_[3]
        order = np.argsort(f, kind="stable")  # texts stand in their order
        f, text = f[order], text[order]
        new = np.concatenate(([True], f[1:] != f[:-1])) if len(f) else np.zeros(0, dtype=bool)
        start = np.flatnonzero(new)
        several = text[start] != text[np.append(start[1:], len(f)) - 1] if len(f) else new
        which = np.empty(len(f), dtype=np.int64)
        which[order] = np.cumsum(new) - 1
        return f[start], several, which

    anchor_bytes = total // 3
    buckets = buckets_for(anchor_bytes)
    own = packs.select("pack", "ids", "lengths", "texts")
    counted = token_counts(own, buckets, lambda row: grams_of(_anchored(row))[0])

    def anchor_bucket(f: np.ndarray) -> np.ndarray:
        return ((f >> _U(33)) % _U(buckets)).astype(np.int64)

    # 2. contexts: what stays of each pack, and what it sends; one frame for all buckets, as packs and buckets both grow
    def contexts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                first, many, text, f, c, left, right = found_ = _anchored(row)
                known, several, which = grams_of(found_)
                shared = ((placed(known, row.back, buckets) > 1) | several)[which]
                first, many, f, c, left, right = (x[shared] for x in (first, many, f, c, left, right))
                doc = longs(row.ids)[text[shared]]
                order = np.lexsort((doc, c, f))
                fo, co, do = f[order], c[order], doc[order]
                new = np.concatenate(([True], (fo[1:] != fo[:-1]) | (co[1:] != co[:-1]))) if len(fo) else np.zeros(0, dtype=bool)
                start = np.flatnonzero(new)
                entry = np.empty(len(fo), dtype=np.int64)
                entry[order] = np.cumsum(new) - 1
                least = do[start]
                # a later document of this pack has all of it from an earlier one of this pack
                later = doc > least[entry] if len(fo) else np.zeros(0, dtype=bool)
                stays = np.stack((first, many, entry, later.astype(np.int64))).astype("<i4"), np.stack((least, fo[start].astype(np.int64))).astype("<i8")
                goes = np.stack((fo[start], co[start], do[start].astype(np.uint64)), 1).astype("<u8")
                sides = np.stack([(x[order][start] >> _U(32)).astype("<u4") for x in (left, right)], 1)
                cells = [(-1, *(x.tobytes() for x in stays))]
                cells += [(b, goes[some].tobytes(), sides[some].tobytes()) for b, some in _dealt(anchor_bucket(fo[start]), buckets)]
                bucket, x, y = zip(*cells, strict=True)
                yield pd.DataFrame({"bucket": bucket, "pack": row.pack, "x": x, "y": y})

    shape = "bucket int, pack long, x binary, y binary"
    sent = written(own.join(counted, "pack", "left").mapInPandas(lean(contexts), shape))

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, rows in _by_key(frames, "bucket"):
            parts = [np.frombuffer(r.x, dtype="<u8").reshape(-1, 3) for r in rows]
            f, c, doc = np.ascontiguousarray(np.concatenate(parts).T)
            sides = np.concatenate([np.frombuffer(r.y, dtype="<u4").reshape(-1, 2) for r in rows]).T.astype(np.uint64)
            doc = doc.astype(np.int64)
            order = np.lexsort((doc, c, f))
            fo, co, do = f[order], c[order], doc[order]
            new_f = np.concatenate(([True], fo[1:] != fo[:-1]))
            new = new_f | np.concatenate(([True], co[1:] != co[:-1]))
            start = np.flatnonzero(new)
            least = do[start][np.cumsum(new) - 1]
            of_f = np.cumsum(new_f) - 1
            # two contexts of one anchor may have windows in common if they are alike on one side of it
            alike = np.zeros(len(start), dtype=bool)
            for side in sides:
                key = mixed(side[order][start]) + of_f[start].astype(np.uint64) * _A
                _, which, n = np.unique(key, return_inverse=True, return_counts=True)
                alike |= n[which] > 1
            different = np.bincount(of_f[start][alike], minlength=of_f[-1] + 1)[of_f]
            alike = alike[np.cumsum(new) - 1]
            status = np.where(least < do, REPEATED, np.where(~alike, ALONE, np.where(different <= TOGETHER, OPEN, SPREAD)))
            back = np.empty(len(f), dtype=np.uint8)
            back[order] = status
            ends = np.cumsum([len(p) for p in parts])
            open_ = np.concatenate(([0], np.cumsum(back >= OPEN)))
            begins = ends - [len(p) for p in parts]
            y = [back[a:e].tobytes() for a, e in zip(begins.tolist(), ends.tolist(), strict=True)]
            yield pd.DataFrame({"bucket": rows[0].bucket, "pack": [r.pack for r in rows], "y": y, "open": open_[ends] - open_[begins]})

    judged = written(
        sent.filter("bucket >= 0").repartitionById(buckets, "bucket").sortWithinPartitions("bucket").mapInPandas(lean(judge), "bucket int, pack long, y binary, open long")
    )
    many_open = judged.agg(F.coalesce(F.sum("open"), F.lit(0))).first()[0]
    shards = max(12, -(-many_open * 64 // (4 * SHARD_BYTES)))
    state = sent.filter("bucket < 0").select("pack", F.col("x").alias("runs"), F.col("y").alias("least"))
    verdicts = judged.groupBy("pack").agg(F.collect_list(F.struct("bucket", "y")).alias("verdicts"))

    def status_of(row: object) -> tuple[np.ndarray, ...]:
        first, many, entry, later = np.frombuffer(row.runs, dtype="<i4").reshape(4, -1).astype(np.int64)
        status = np.zeros(len(row.least) // 16, dtype=np.uint8)
        if len(status):
            by_bucket = {v["bucket"]: v["y"] for v in row.verdicts}
            for b, some in _dealt(anchor_bucket(longs(row.least).reshape(2, -1)[1].astype(np.uint64)), buckets):
                status[some] = np.frombuffer(by_bucket[b], dtype=np.uint8)
        return first, many, entry, later.astype(bool), status

    # 3. surroundings that differ, window by window
    def edge_frame(pack: int, cells: list[tuple[int, bytes, bytes]]) -> pd.DataFrame:
        shard, about, pieces = zip(*cells, strict=True)
        return pd.DataFrame({"shard": shard, "pack": pack, "about": about, "pieces": pieces})

    def edges(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                first, many, entry, _, status = status_of(row)
                open_ = np.flatnonzero(status >= OPEN)
                if not len(open_):
                    continue
                where = np.full(len(status), -1)
                where[entry[::-1]] = np.arange(len(entry))[::-1]
                least, anchor = longs(row.least).reshape(2, -1)
                spread = status[open_] == SPREAD
                # a whole context by its anchor, which is what its windows have in common; or each window by itself
                whole, single = open_[~spread], open_[spread]
                start, n = first[where[whole]], many[where[whole]]
                parts = many[where[single]]
                s1 = np.repeat(first[where[single]] - (np.cumsum(parts) - parts), parts) + np.arange(parts.sum())
                by_window = [xxhash.xxh64_intdigest(row.texts[x : x + LENGTH]) for x in s1.tolist()]
                key = np.concatenate((anchor[whole].astype(np.uint64), np.array(by_window, dtype=np.uint64)))
                start, n = np.concatenate((start, s1)), np.concatenate((n, np.ones(len(s1), dtype=np.int64)))
                owner = np.concatenate((whole, np.repeat(single, parts)))
                offset = start - first[where[owner]]
                about = np.stack((owner, offset, n, least[owner]), 1).astype("<i8")
                cells, size = [], 0
                for b, some in _dealt((mixed(key) % _U(shards)).astype(np.int64), shards):
                    pieces = b"".join([row.texts[s : s + m + LENGTH - 1] for s, m in zip(start[some].tolist(), n[some].tolist(), strict=True)])
                    cells.append((b, about[some].tobytes(), pieces))
                    size += len(pieces)
                    if size >= FRAME_BYTES:
                        yield edge_frame(row.pack, cells)
                        cells, size = [], 0
                if cells:
                    yield edge_frame(row.pack, cells)

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, rows in _by_key(frames, "shard"):
            about = np.ascontiguousarray(np.concatenate([np.frombuffer(r.about, dtype="<i8").reshape(-1, 4) for r in rows]).T)
            pack = np.repeat([r.pack for r in rows], [len(r.about) // 32 for r in rows])
            size = about[2] + LENGTH - 1
            ends, text = np.cumsum(size), b"".join(r.pieces for r in rows)
            cut = np.concatenate(([0], np.flatnonzero(np.diff(ends // SHARD_BYTES)) + 1, [len(size)]))
            parts, sorted_ = [], []
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                if a < b:
                    pieces = [text[e - s : e] for e, s in zip(ends[a:b].tolist(), size[a:b].tolist(), strict=True)]
                    windows, least, which = shard_windows(pieces, about[3, a:b])
                    parts.append((a, b, which))
                    sorted_.append((windows, least))
            for (a, b, which), least in zip(parts, merged_least(sorted_), strict=True):
                n = about[2, a:b]
                again = least[which] < np.repeat(about[3, a:b], n)
                at = np.repeat(about[1, a:b] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                hit = np.flatnonzero(again)
                if not len(hit):
                    continue
                which = np.repeat(np.arange(b - a), n)[hit]
                owner, offset, of = about[0, a:b][which].astype("<i8"), at[hit].astype("<i8"), pack[a:b][which]
                # a row for each run of hits of one pack
                run = np.concatenate(([0], np.flatnonzero(of[1:] != of[:-1]) + 1, [len(of)]))
                x = [owner[u:v].tobytes() + offset[u:v].tobytes() for u, v in zip(run[:-1].tolist(), run[1:].tolist(), strict=True)]
                yield pd.DataFrame({"pack": of[run[:-1]], "x": x})

    base = packs.select("pack", "texts").join(state, "pack").join(verdicts, "pack", "left")
    compared = (
        base.mapInPandas(lean(edges), "shard int, pack long, about binary, pieces binary")
        .repartitionById(shards, "shard")
        .sortWithinPartitions("shard")
        .mapInPandas(lean(compare), "pack long, x binary")
    )
    hits = compared.groupBy("pack").agg(F.collect_list("x").alias("hits"))

    def gone(row: object) -> np.ndarray:
        """Which bytes of a pack's texts are to go."""
        first, many, entry, later, status = status_of(row)
        change = np.zeros(len(row.texts) + 1, dtype=np.int32)
        whole = later | (status[entry] == REPEATED)
        np.add.at(change, first[whole], 1)
        np.add.at(change, first[whole] + many[whole] + LENGTH - 1, -1)
        if row.hits is not None and len(row.hits):
            owner, at = np.concatenate([np.frombuffer(x, dtype="<i8").reshape(2, -1) for x in row.hits], axis=1)
            # every place of the context in its first document
            order = np.argsort(entry, kind="stable")
            low, high = np.searchsorted(entry[order], owner), np.searchsorted(entry[order], owner, side="right")
            n = high - low
            run = order[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            start = first[run] + np.repeat(at, n)
            np.add.at(change, start, 1)
            np.add.at(change, start + LENGTH, -1)
        return np.cumsum(change[:-1], dtype=np.int32) > 0

    return packs.join(state, "pack").join(verdicts, "pack", "left").join(hits, "pack", "left"), gone


def repeats(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept (binary, the bytes that stay)."""

    packs, gone = _judged(docs.select("doc_id", "text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                ids, length = longs(row.ids), longs(row.lengths)
                removed, spans, kept = _cut(row, gone(row))
                yield pd.DataFrame(
                    {"doc_id": pd.array(ids, dtype="Int64"), "n_bytes": length, "n_removed": removed, "n_spans": spans, "kept": kept}
                ).assign(doc_id=lambda d, ids=ids: d["doc_id"].mask(ids == np.iinfo(np.int64).max))

    return packs.mapInPandas(lean(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def _cut(row: object, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """For each text of a pack: bytes removed, runs of them, and what is kept."""
    length = longs(row.lengths)
    data = np.frombuffer(row.texts, dtype=np.uint8)
    ends = np.cumsum(length)
    starts = ends - length
    begins = gone & ~np.concatenate(([False], gone[:-1]))
    begins[starts[(length > 0)]] = gone[starts[(length > 0)]]
    sums, runs = np.concatenate(([0], np.cumsum(gone))), np.concatenate(([0], np.cumsum(begins)))
    removed, spans = sums[ends] - sums[starts], runs[ends] - runs[starts]
    kept = [row.texts[a:b] if not r else data[a:b][~gone[a:b]].tobytes() for a, b, r in zip(starts.tolist(), ends.tolist(), removed.tolist(), strict=True)]
    return removed, spans, kept


def without_repeats(docs: DataFrame) -> DataFrame:
    """docs with all its columns, and the repeated bytes cut out of text; characters that are cut in two go wholly."""
    columns = docs.columns
    packs, gone = _judged(docs)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            for row in pd.DataFrame(batch.to_pydict()).itertuples():
                rest = pa.ipc.open_stream(row.rest).read_all().combine_chunks()
                _, _, kept = _cut(row, gone(row))
                text = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())
                arrays = [text if c == "text" else rest.column(c).combine_chunks() for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return packs.mapInArrow(lean(run), docs.schema)
