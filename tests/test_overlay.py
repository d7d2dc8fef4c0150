from __future__ import annotations

import os

from pyspark.sql import functions as F

from corpusloom.streaming.overlay import overlay, record_stream, state


def test_overlay_keeps_the_last_record_and_few_versions(spark, tmp_path):
    rows = [[(1, 10, "a"), (2, 10, "a"), (3, 10, "a")], [(1, 11, "b"), (2, 9, "old")], [(4, 1, "d")], [(1, 12, "c"), (5, 1, "e")], [(3, 10, "again")]]
    schema = "k long, ts long, v string"
    for i, some in enumerate(rows):
        spark.createDataFrame(some, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
        query = overlay(record_stream(spark, str(tmp_path / "in/*"), schema, 1), str(tmp_path / "state"), str(tmp_path / "checkpoint"), ["k"], ["ts", "v"], buckets=4)
        query.awaitTermination()
        assert query.exception() is None
    last = max(int(n.split("=")[1]) for n in os.listdir(tmp_path / "state/index"))
    found = state(spark, str(tmp_path / "state"), last, spark.createDataFrame([], schema).schema)
    assert sorted((r["k"], r["ts"], r["v"]) for r in found.collect()) == [(1, 12, "c"), (2, 10, "a"), (3, 10, "again"), (4, 1, "d"), (5, 1, "e")]
    assert len(os.listdir(tmp_path / "state/index")) == 2
    assert found.select(F.countDistinct("k")).first()[0] == 5
