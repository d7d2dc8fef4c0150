"""Helpers that the training-data operators share."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.lineage import shared_folder

#: Words as the contracts define them: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run for mapInPandas or mapInArrow, after which the worker, which outlives its task, gives the memory that it no longer uses back."""

    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # another C library than glibc has no such call
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return task


def unused(columns: list[str], base: str) -> str:
    """A name that begins like base and that no column begins with, so that it and all that begin with it are free."""
    while any(c.lower().startswith(base.lower()) for c in columns):
        base += "_"
    return base


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a copy in the shared folder, which outlives any executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage by writing df as a table in the shared folder."""
    path = f"{shared_folder(df.sparkSession)}/corpusloom/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, least: int = 1) -> DataFrame:
    """Cut the lineage by writing df as a table bucketed by key in the warehouse, which joins on key without moving it.

    It has as many buckets as a shuffle has partitions at least, else a join would rather deal out this side anew."""
    name = f"corpusloom_{uuid.uuid4().hex}"
    width = max(shuffle_width(df.sparkSession), least)
    df.write.bucketBy(width, key).option("compression", "zstd").saveAsTable(name)
    _TABLES.append(name)
    return df.sparkSession.table(name)


#: Tables that this process has made.
_TABLES: list[str] = []


def drop_tables(spark: SparkSession) -> int:
    """Drop the bucketed tables that this process has made, once the results that read them are written. How many they were."""
    names = list(_TABLES)
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        _TABLES.remove(name)
    return len(names)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, *keys: Column) -> tuple[DataFrame, int]:
    """Number the rows of df gaplessly from 0 in the order of keys, in a new column ``position``.

    df should be narrow: the range-sorted rows are checkpointed, so that the counts of the partitions and
    the numbers inside them come from one and the same sort. Only one count per partition goes to the driver.
    Rows that tie on all keys get different numbers in no fixed order. Also returns the number of rows.
    """
    spark = df.sparkSession
    width = shuffle_width(spark)
    placed = checkpoint(
        df.repartitionByRange(width, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftright("_at", 33)
    counts = placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()
    starts, total = {}, 0
    for row in sorted(counts):
        starts[row["p"]] = total
        total += row["n"]
    if not total:
        return placed.withColumn("position", F.lit(0).cast("long")).drop("_at"), 0
    # one entry for each partition of the sort, so its size is that of the shuffle's width
    start = F.create_map(*[F.lit(x).cast("long") for pair in starts.items() for x in pair])
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("position", F.element_at(start, part) + inside).drop("_at"), total
