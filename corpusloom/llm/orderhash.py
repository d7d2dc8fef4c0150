"""Order MinHash fingerprints: signatures of a text that notice edits, not only changed content.

A text's k-mers of code points are numbered by occurrence (the second "abc" differs from the first), so the
whole is a set. Each of the hash functions selects the ``TUPLE`` k-mers with the least hashes; they are put back
in the order in which they stand in the text, and the hash of this tuple is one place of the fingerprint. Two
texts agree in a place if the same k-mers are selected and stand in the same order, which for random functions
gets likelier the smaller the edit distance. Likeness is the share of places that agree.

A text shorter than a k-mer has one k-mer, the text itself; so has an empty text, and nulls count as empty.
Equal texts have equal fingerprints. Very long texts are worked through by blocks of functions, in bounded memory.

To compare each document with its neighbour in the order of doc_id, documents are range-sorted; a task walks its
sorted rows, and the last row of each partition meets the first row of the next filled partition in a join with
two rows a partition. Rows that repeat a doc_id are ordered by text, nulls first. A single row is its own
neighbour; an empty table gives an empty table. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import shuffle_width, written

K = 12
PLACES = 64
TUPLE = 2
_U = np.uint64
_M1, _M2, _M3 = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9)
#: What each function adds to a k-mer's hash and multiplies it by (odd), from a fixed seed.
_ADDED, _FACTORS = np.random.default_rng(12).integers(0, 2**31, (2, PLACES, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_LAST = np.uint32(0x2C1B3C6D)
#: Hashes held at once.
_BLOCK = 1 << 18


def _mixed(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    x = a * _M1 + b * _M2
    x ^= x >> _U(31)
    x *= _M3
    x ^= x >> _U(29)
    return x


def kmers(text: str) -> np.ndarray:
    """A hash for each k-mer of text, in text order."""
    h1 = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    if len(h1) < K:
        seed = np.array([len(h1)], dtype=np.uint64)
        for c in h1:
            seed = _mixed(seed, np.array([c]))
        return seed
    h2 = _mixed(h1[:-1], h1[1:])
    h4 = _mixed(h2[:-2], h2[2:])
    h8 = _mixed(h4[:-4], h4[4:])
    return _mixed(h8[: len(h1) - K + 1], h4[8:])


def numbered_kmers(text: str) -> np.ndarray:
    """As kmers(), but the k-mer and how often it stood before are hashed together."""
    h = kmers(text)
    n = len(h)
    bits = _U(max(1, n.bit_length()))
    keyed = np.sort((h >> bits << bits) | np.arange(n, dtype=np.uint64))
    same = (keyed >> bits)[1:] == (keyed >> bits)[:-1]
    if not same.any():
        return _mixed(h, _U(0))
    starts = np.concatenate(([0], np.where(same, 0, np.arange(1, n))))
    before = np.arange(n) - np.maximum.accumulate(starts)
    times = np.empty(n, dtype=np.uint64)
    times[(keyed & ((_U(1) << bits) - _U(1))).astype(np.int64)] = before
    return _mixed(h, times)


def order_of(short: np.ndarray, functions: slice) -> np.ndarray:
    """The place of each k-mer's hash of 32 bits under some of the functions; each one is a permutation whose bits are well mixed."""
    x = (short[None, :] + _ADDED[functions]) * _FACTORS[functions]
    x ^= x >> np.uint32(15)
    x *= _LAST
    return x


def fingerprint(text: str) -> np.ndarray:
    """PLACES hashes of 16 bits."""
    x = numbered_kmers(text)
    n = len(x)
    short = (x >> _U(32)).astype(np.uint32)
    out = np.empty(PLACES, dtype=np.uint64)
    step = max(1, _BLOCK // n)
    for at in range(0, PLACES, step):
        hashes = order_of(short, slice(at, at + step))
        rows = np.arange(len(hashes))
        places = []
        for _ in range(min(TUPLE, n)):
            least = hashes.argmin(axis=1)
            places.append(least)
            hashes[rows, least] = ~np.uint32(0)
        value = np.full(len(hashes), _U(min(TUPLE, n)))
        for place in np.sort(np.array(places), axis=0):
            value = _mixed(value, x[place])
        out[at : at + step] = value
    return (out >> _U(48)).astype(">u2")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, after: str) -> str:
    """text with its last third replaced by as many code points from the start of ``after``."""
    n = len(text) // 3
    return text[: len(text) - n] + after[:n]


_COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _compared(doc_id: object, text: str, print_: np.ndarray, after: str, after_print: np.ndarray) -> tuple:
    other = edited(text, after)
    other_print = fingerprint(other)
    digest = hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest()
    return (
        doc_id,
        len(text),
        digest,
        print_.tobytes(),
        other_print.tobytes(),
        likeness(print_, other_print),
        likeness(print_, after_print),
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: doc_id and fingerprint (lowercase hex)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            prints = [fingerprint(t or "").tobytes().hex() for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "fingerprint": prints})

    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, fingerprint string")


def against_neighbours(docs: DataFrame) -> DataFrame:
    """The contract's columns: each document against its edited text and the next one by descending doc_id."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    result = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the row that waits for its neighbour
        done: list[tuple] = []
        part = -1

        def out() -> pd.DataFrame:
            frame = pd.DataFrame(done, columns=_COLUMNS)
            return frame.assign(part=part, role="done", text=None)

        def edge(role: str, doc_id: object, text: str) -> pd.DataFrame:
            row = dict.fromkeys(_COLUMNS) | {"doc_id": doc_id, "part": part, "role": role, "text": text}
            return pd.DataFrame([row])

        for frame in frames:
            for doc_id, text, part in zip(frame["doc_id"], frame["text"], frame["part"], strict=True):  # noqa: B020
                text = text or ""
                now = (doc_id, text, fingerprint(text))
                if held is None:
                    yield edge("head", doc_id, text)
                else:
                    done.append(_compared(*held, text, now[2]))
                held = now
            if done:
                yield out()
                done = []
        if held is not None:
            yield edge("tail", held[0], held[1])

    order = [F.col("doc_id").desc(), F.col("text").asc_nulls_first()]
    walked = written(
        docs.select("doc_id", "text")
        .repartitionByRange(shuffle_width(spark), F.col("doc_id").desc())
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .mapInPandas(walk, f"{result}, part int, role string, text string")
    )
    # one number for each filled partition
    parts = sorted(r["part"] for r in walked.filter(F.col("role") == "head").select("part").collect())
    hexed = [F.lower(F.hex(c)).alias(c) if "fingerprint" in c else F.col(c) for c in _COLUMNS]
    if not parts:
        return walked.select(*hexed)
    after = F.create_map(*[F.lit(x) for pair in zip(parts, parts[1:] + parts[:1], strict=True) for x in pair])
    tails = walked.filter(F.col("role") == "tail").select("doc_id", "text", F.element_at(after, F.col("part")).alias("next_part"))
    heads = walked.filter(F.col("role") == "head").select(F.col("text").alias("after"), F.col("part").alias("next_part"))

    def last(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [_compared(d, t, fingerprint(t), a, fingerprint(a)) for d, t, a in zip(frame["doc_id"], frame["text"], frame["after"], strict=True)]
            yield pd.DataFrame(rows, columns=_COLUMNS)

    ends = tails.join(heads, "next_part").select("doc_id", "text", "after").mapInPandas(last, result)
    return walked.filter(F.col("role") == "done").select(*_COLUMNS).unionByName(ends).select(*hexed)
