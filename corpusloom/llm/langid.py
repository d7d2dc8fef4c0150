"""Language of a text: the nearest of several centroids per language among TF-IDF vectors of byte trigrams.

Bytes of the lower-case text, with everything but letters as a blank, are taken by threes and hashed to ``BINS`` bins. A
vector holds log(1 + count) * idf, scaled to length 1; idf comes from all documents that may be learned from. Each
language's vectors are clustered (spherical k-means) into ``CENTROIDS`` centroids, on a sample of about ``SAMPLE``
of its documents at most: those with the least hashes of doc_id and text, the least one always, and rows that are equal in
both count once; a task clusters one language's sample. A text gets the language of the centroid with the largest
cosine, which is also its score (ties: the language that comes first by code point). A text farther from its centroid
than ``SLACK`` times the distance within which nearly all of the centroid's own documents lie is marked as rejected.

Null texts and texts without a letter are "und", with score 0, and rejected; so is every text if there is nothing to learn
from. Repeated rows are judged alike; an empty table gives an empty table. Columns other than doc_id, text and lang (for
learning) are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 4096
SAMPLE = 600
CENTROIDS = 4
ROUNDS = 12
LEAST_SHARE = 0.02
SLACK = 1.5
UNKNOWN = "und"
#: The largest hash, of 63 bits.
_MOST = (1 << 63) - 1
_LETTER = re.compile(r"[^\W\d_]")
_BLANK = np.array([i if i >= 128 or chr(i).isalpha() else 32 for i in range(256)], dtype=np.uint32)


def counts(texts: list[str | None]) -> np.ndarray:
    """A row of trigram counts for each text."""
    out = np.zeros((len(texts), BINS), dtype=np.float32)
    for i, text in enumerate(texts):
        if text:
            b = _BLANK[np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), dtype=np.uint8)]
            three = b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]
            three = three[three != 0x202020]
            out[i] = np.bincount((three * np.uint32(2654435761)) >> np.uint32(20), minlength=BINS)
    return out


def vectors(texts: list[str | None], idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts(texts)) * idf
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(length > 0, length, 1)


def _clustered(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of the rows of x by spherical k-means, and the distance within which 99 % of each one's rows lie."""
    k = min(CENTROIDS, len(x))
    c = x[[(2 * i + 1) * len(x) // (2 * k) for i in range(k)]]
    for _ in range(ROUNDS):
        own = (x @ c.T).argmax(1)
        sums = np.array([x[own == k].sum(0) if (own == k).any() else c[k] for k in range(len(c))])
        c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    # a cluster of a few odd texts doesn't stand for a language
    sizes = np.bincount((x @ c.T).argmax(1), minlength=len(c))
    c = c[sizes >= max(1, LEAST_SHARE * len(x))]
    cos = x @ c.T
    own = cos.argmax(1)
    reach = [float(np.quantile(1 - cos[own == k, k], 0.99)) if (own == k).any() else 0.0 for k in range(len(c))]
    return c, np.array(reach)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Model:
    """Bounded by the number of languages."""

    def __init__(self, idf: np.ndarray, langs: list[str], centroids: np.ndarray, reach: np.ndarray):
        self.idf, self.langs, self.centroids, self.reach = idf, langs, centroids, reach

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether it is rejected, for each text."""
        known = np.array([bool(t and _LETTER.search(t)) for t in texts]) & bool(self.langs)
        langs, best, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        at = np.flatnonzero(known)
        for start in range(0, len(at), 256):
            some = at[start : start + 256]
            cos = vectors([texts[i] for i in some], self.idf) @ self.centroids.T
            own = cos.argmax(1)
            best[some] = np.clip(cos[np.arange(len(some)), own], 0, 1)
            rejected[some] = 1 - best[some] > SLACK * self.reach[own]
            for i, k in zip(some, own, strict=True):
                langs[i] = self.langs[k]
        return langs, best, rejected


def fit(docs: DataFrame) -> Model:
    """Learn from the rows that aren't held out and have a text and a language."""
    rows = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).filter(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
    )

    rows = rows.withColumn("hash", F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 1))

    def seen(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        docs_with, per_lang, least = np.zeros(BINS, dtype=np.int64), {}, {}
        for frame in frames:
            for start in range(0, len(frame), 256):
                docs_with += (counts(frame["text"].iloc[start : start + 256].tolist()) > 0).sum(0)
            for lang, hashes in frame.groupby("lang")["hash"]:
                per_lang[lang] = per_lang.get(lang, 0) + len(hashes)
                least[lang] = min(least.get(lang, _MOST), int(hashes.min()))
        if per_lang:
            yield pd.DataFrame({"bin": np.arange(BINS), "lang": "", "n": docs_with, "least": _MOST})
            yield pd.DataFrame({"bin": -1, "lang": list(per_lang), "n": list(per_lang.values()), "least": list(least.values())})

    sums = (
        rows.select("text", "lang", "hash").mapInPandas(seen, "bin int, lang string, n long, least long").groupBy("bin", "lang").agg(F.sum("n").alias("n"), F.min("least").alias("least")).collect()
    )
    docs_with, per_lang, limits = np.zeros(BINS), {}, {}
    for row in sums:
        if row["bin"] >= 0:
            docs_with[row["bin"]] = row["n"]
        else:
            per_lang[row["lang"]] = row["n"]
            limits[row["lang"]] = max(row["least"], min(_MOST, _MOST // row["n"] * SAMPLE))
    total = sum(per_lang.values())
    idf = (np.log((1 + total) / (1 + docs_with)) + 1).astype(np.float32)
    if not per_lang:
        return Model(idf, [], np.zeros((0, BINS), dtype=np.float32), np.zeros(0))

    limit = F.create_map(*[F.lit(x) for lang, most in limits.items() for x in (lang, most)])
    sample = rows.filter(F.col("hash") <= F.element_at(limit, F.col("lang"))).dropDuplicates(["lang", "hash"])

    def vector(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                x = vectors(frame["text"].tolist(), idf).astype(np.float32)
                yield pd.DataFrame({"hash": frame["hash"], "lang": frame["lang"], "x": [v.tobytes() for v in x]})

    def cluster(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("hash")
        c, reach = _clustered(np.stack([np.frombuffer(v, dtype=np.float32) for v in frame["x"]]))
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "c": [v.astype(np.float32).tobytes() for v in c], "reach": reach})

    found = (
        sample.mapInPandas(vector, "hash long, lang string, x binary")
        .groupBy("lang")
        .applyInPandas(cluster, "lang string, c binary, reach double")
        .collect()
    )
    found = sorted(found, key=lambda r: r["lang"])
    centroids = np.stack([np.frombuffer(r["c"], dtype=np.float32) for r in found])
    return Model(idf, [r["lang"] for r in found], centroids, np.array([r["reach"] for r in found]))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, rejected."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            lang, best, rejected = model.predict(frame["text"].tolist())
            yield pd.DataFrame({"doc_id": frame["doc_id"], "held_out": frame["held_out"], "lang_pred": lang, "score": best, "rejected": rejected})

    narrow = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return narrow.mapInPandas(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean")
