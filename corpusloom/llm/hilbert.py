"""Shards whose files can be pruned by several metadata columns at once.

Source, language and size of a document are quantised to 32 steps each (the first two by a hash, so that no
dictionary of their values is needed; the size by its logarithm), the three steps become an index on a
Hilbert curve, and documents are sorted by this index and cut into runs with equal numbers of rows (law
``rows``: counts differ by one at most). Neighbours on the curve are neighbours in every dimension, so a
shard holds few different steps of each; a reader that wants one source skips the shards without its step.

A hot source, language or size doesn't matter: runs are cut by position, and doc_id breaks ties on the curve.
Nulls: a null text has no bytes and no checksum; null source or lang have a step of their own. Repeated rows
get slots of their own. An empty table gives an empty table. Columns other than those named are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from corpusloom.llm.common import numbered, unused

STEPS_BITS = 5


def curve_index(axes: list[np.ndarray], bits: int) -> np.ndarray:
    """Index on the Hilbert curve through a cube of 2**bits steps a side, for arrays of coordinates."""
    x = [np.asarray(a, dtype=np.int64).copy() for a in axes]
    # undo the turns and swaps of each level, from the coarsest one
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for i in range(len(x)):
            turned = (x[i] & bit) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
        bit >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        flip = np.where((x[-1] & bit) != 0, flip ^ (bit - 1), flip)
        bit >>= 1
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in x:
            index = (index << 1) | (((axis ^ flip) >> level) & 1)
    return index


@F.pandas_udf(LongType())
def _index(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
    return pd.Series(curve_index([a.to_numpy(), b.to_numpy(), c.to_numpy()], STEPS_BITS))


def _hashed(name: str) -> Column:
    return F.pmod(F.xxhash64(F.col(name)), F.lit(1 << STEPS_BITS)).cast("int")


def shards(docs: DataFrame, count: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null), and the steps and index it went by."""
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long")
    steps = docs.select(
        "doc_id",
        size.alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        _hashed("source").alias("source_step"),
        _hashed("lang").alias("lang_step"),
        F.least(F.floor(F.log2(size.cast("double"))), F.lit((1 << STEPS_BITS) - 1)).cast("int").alias("size_step"),
    )
    indexed = steps.withColumn("curve", _index("source_step", "lang_step", "size_step"))
    placed, total = numbered(indexed, F.col("curve"), F.col("doc_id"), F.col("text_crc32"))
    # run s holds the positions from ceil(s * total / count) on
    shard = F.expr(f"(position * {count}L) div {max(total, 1)}L")
    first = F.expr(f"(shard * {total}L + {count - 1}L) div {count}L")
    return (
        placed.withColumn("shard", shard)
        .withColumn("slot", F.col("position") - first)
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            F.col("slot").cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "curve",
            "source_step",
            "lang_step",
            "size_step",
        )
    )


def write_shards(docs: DataFrame, path: str, count: int = 40) -> str:
    """Write docs with all their columns as one folder for each shard, rows in the order of their slots. doc_id must be unique here.

    Gives the name of the column that the folders are of: shard, or where docs has columns of such a name, one with more at its end."""
    taken = {c.lower() for c in docs.columns}
    name = unused(docs.columns, "shard")
    names = {c: f"{name}_{c}" if c in taken else c for c in ("slot", "source_step", "lang_step", "size_step")}
    where = shards(docs, count).select(F.col("doc_id").alias(f"{name}_id"), F.col("shard").alias(name), *[F.col(c).alias(x) for c, x in names.items()])
    rows = docs.join(where, F.col("doc_id") == F.col(f"{name}_id")).drop(f"{name}_id")
    rows.repartitionByRange(count, name, names["slot"]).sortWithinPartitions(name, names["slot"]).write.partitionBy(name).parquet(path)
    return name
