"""Ledgers that grow while they are read: records come as files, each is applied once, the last state wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from corpusloom.operators.ledger import latest


def record_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def overlay(stream: DataFrame, target: str, checkpoint: str, key: Sequence[str], order: Sequence[str], buckets: int = 64) -> StreamingQuery:
    """Keep in ``target`` the last record of each key: a folder of versions, each of which names where the state of each bucket of keys lies.

    A batch writes anew only the buckets that its keys fall into; the others are taken over by their paths, which stand in the
    version's index. A batch that runs again after a failure writes the same version again, so its effect is one. What no index of
    the last two versions names is removed."""

    def upsert(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        last: list[Column] = [F.col(c) for c in order]
        now = latest(batch, key, last).withColumn("_bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
        now.persist()
        try:
            touched = [r["_bucket"] for r in now.select("_bucket").distinct().collect()]
            known = index(spark, target, number - 1) if number else {}
            old = [known[b] for b in touched if b in known]
            if old:
                before = spark.read.schema(now.drop("_bucket").schema).parquet(*old)
                merged = latest(before.unionByName(now.drop("_bucket")), key, last)
                now_ = merged.withColumn("_bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
            else:
                now_ = now
            place = f"{target}/data/version={number}"
            now_.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(place)
            known |= {b: f"{place}/_bucket={b}" for b in touched}
            rows = spark.createDataFrame(sorted(known.items()), "bucket int, path string")
            rows.coalesce(1).write.mode("overwrite").json(f"{target}/index/version={number}")
            _sweep(spark, target, number, known)
        finally:
            now.unpersist()

    return stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def index(spark: SparkSession, target: str, version: int) -> dict[int, str]:
    """Where the state of each bucket lies at a version; one entry for each of the few buckets."""
    return {r["bucket"]: r["path"] for r in spark.read.schema("bucket int, path string").json(f"{target}/index/version={version}").collect()}


def state(spark: SparkSession, target: str, version: int, schema: StructType) -> DataFrame:
    """The last record of each key at a version."""
    paths = list(index(spark, target, version).values())
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _sweep(spark: SparkSession, target: str, number: int, known: dict[int, str]) -> None:
    """Remove the indexes before the last two versions, and data of versions that neither of these two names."""
    named = set(known.values()) | (set(index(spark, target, number - 1).values()) if number else set())
    used = {int(p.rsplit("version=", 1)[1].split("/")[0]) for p in named} | {number, number - 1}
    jvm = spark.sparkContext._jvm
    for part, stay in (("index", {number, number - 1}), ("data", used)):
        folder = jvm.org.apache.hadoop.fs.Path(f"{target}/{part}")
        files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for entry in files.listStatus(folder):
            name = entry.getPath().getName()
            if name.startswith("version=") and int(name[len("version=") :]) not in stay:
                files.delete(entry.getPath(), True)


def distinct_records(stream: DataFrame, time: str, delay: str, key: Sequence[str]) -> DataFrame:
    """Records once for each key within the delay that late ones may have."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(key))
