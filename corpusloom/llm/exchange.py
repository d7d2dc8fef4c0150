"""Counting packed tokens: how often each token of each pack occurs in all packs.

A pack is one row that stands for many documents or strings: an id and the little-endian bytes of its tokens (unsigned integers
of 8 bytes). Tokens travel packed by hash bucket, one row for each pack and bucket instead of one for each token, are
sorted and counted by bucket, and their counts travel back the same way, in the pack's own order. A token that stands in
very many packs is one token in each, and each pack sends it once for each time it holds it; buckets are even
because they are cut by hash. Tokens must be hashes: their upper half deals them out, and only the lower half
travels, so that tokens that agree in bucket and lower half count as one. A count may be too large by that, never too small.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import lean

#: Bytes of packed tokens for each bucket, about.
BUCKET_BYTES = 8 << 20


def bucket_of(tokens: np.ndarray, buckets: int) -> np.ndarray:
    return ((tokens >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def buckets_for(size: int) -> int:
    return max(12, -(-size // BUCKET_BYTES))


def own_tokens(row: object) -> np.ndarray:
    return np.frombuffer(row.tokens, dtype="<u8")


def token_counts(packs: DataFrame, buckets: int, tokens_of: Callable[[object], np.ndarray] = own_tokens) -> DataFrame:
    """For each pack: ``back``, the counts of its tokens by bucket, which ``placed`` puts in their order."""

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                tokens, pack = tokens_of(row), row.pack
                bucket = bucket_of(tokens, buckets)
                order = np.argsort(bucket, kind="stable")
                cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
                ordered = tokens[order].astype("<u4")
                filled = np.flatnonzero(np.diff(cut))
                yield pd.DataFrame({"bucket": filled, "pack": pack, "tokens": [ordered[cut[b] : cut[b + 1]].tobytes() for b in filled]})

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held = None, []

        def out() -> pd.DataFrame:
            parts = [np.frombuffer(blob, dtype="<u4") for _, blob in held]
            _, where, n = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
            each = np.minimum(n, 0xFFFFFFFF).astype("<u4")[where]
            ends = np.cumsum([len(p) for p in parts])
            return pd.DataFrame({"bucket": at, "pack": [p for p, _ in held], "counts": [each[e - len(p) : e].tobytes() for p, e in zip(parts, ends, strict=True)]})

        for frame in frames:
            for bucket, pack, blob in zip(frame["bucket"], frame["pack"], frame["tokens"], strict=True):
                if bucket != at and held:
                    yield out()
                    held = []
                at = bucket
                held.append((pack, blob))
        if held:
            yield out()

    counted = (
        packs.mapInPandas(lean(send), "bucket int, pack long, tokens binary")
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket")
        .mapInPandas(lean(count), "bucket int, pack long, counts binary")
    )
    # one struct for each bucket of a pack, so at most ``buckets`` of them
    return counted.groupBy("pack").agg(F.collect_list(F.struct("bucket", "counts")).alias("back"))


def placed(tokens: np.ndarray, back: list | None, buckets: int) -> np.ndarray:
    """The counts of tokens, in their order."""
    out = np.zeros(len(tokens), dtype="<u4")
    if len(tokens):
        order = np.argsort(bucket_of(tokens, buckets), kind="stable")
        out[order] = np.concatenate([np.frombuffer(b["counts"], dtype="<u4") for b in sorted(back, key=lambda b: b["bucket"])])
    return out
