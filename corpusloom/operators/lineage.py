"""Cutting the lineage of tables that a plan uses several times."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it.

    Where it names none, a local session gets a folder of its own (tests); on a cluster that is an error, as executors don't see it."""
    context = spark.sparkContext
    found = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-")
        context.setCheckpointDir(found)
    return found


def kept(df: DataFrame) -> DataFrame:
    """df from a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
