"""Files by name: all of a write or none, whatever a task or a gate does."""

from __future__ import annotations

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from corpusloom.sources import published, readers, writers


def rows(spark, n=50):
    return spark.range(n).select(F.concat((F.col("id") % 7).cast("string"), F.lit(".txt")).alias("name"), F.concat(F.lit("line é "), F.col("id").cast("string")).alias("line"), "id").repartition(5)


def files(path):
    return sorted(os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names if not f.startswith("."))


def test_files_are_published_by_name(spark, tmp_path):
    path = f"file://{tmp_path}/a"
    seen = published.publish(rows(spark), path, "name", "line", [F.col("id")], {"some": F.count("*") > 10, "all": F.count("*") == 50})
    assert seen == {"some": True, "all": True}
    found = {r["name"]: r for r in published.manifest(spark, path).collect()}
    assert set(found) == {f"{i}.txt" for i in range(7)}
    for name, r in found.items():
        data = open(r["path"].removeprefix("file://"), "rb").read()
        want = "".join(f"line é {i}\n" for i in range(int(name[0]), 50, 7)).encode()
        assert data == want and (r["lines"], r["bytes"], r["sha256"]) == (len(want.splitlines()), len(want), hashlib.sha256(want).hexdigest())
    text = spark.read.option("recursiveFileLookup", "true").text(published.folders_of(path), wholetext=True)
    assert text.count() == 7
    # another write takes its place; what the first one wrote stays until it is swept
    published.publish(rows(spark, 3), path, "name", "line", [F.col("id")])
    assert published.manifest(spark, path).count() == 3
    assert published.sweep(path) >= 1 and published.manifest(spark, path).agg(F.sum("lines")).first()[0] == 3


def test_gate_that_fails_publishes_nothing(spark, tmp_path):
    path = str(tmp_path / "b")
    published.publish(rows(spark, 7), path, "name", "line", [F.col("id")])
    before = files(path)
    with pytest.raises(published.GateError) as e:
        published.publish(rows(spark), path, "name", "line", [F.col("id")], {"few": F.count("*") < 10, "null": F.max(F.lit(None).cast("boolean")), "good": F.min("id") == 0})
    assert e.value.failed == ["few", "null"] and e.value.observed["good"] is True
    assert files(path) == before and published.manifest(spark, path).count() == 7


def test_task_that_fails_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "c")
    bad = rows(spark).withColumn("line", F.when(F.col("id") == 33, F.raise_error(F.lit("broken"))).otherwise(F.col("line")))
    with pytest.raises(Exception, match="broken"):
        published.publish(bad, path, "name", "line", [F.col("id")])
    assert [f for f in files(path) if f.endswith(".txt")] == [] and published.current(path) == (None, [])
    assert published.manifest(spark, path).collect() == []
    for name in ("", "..", "a/b", "_x", None):
        with pytest.raises(Exception, match="no name for a file"):
            published.publish(rows(spark, 1).withColumn("name", F.lit(name).cast("string")), path, "name", "line", [F.col("id")])


def test_names_in_two_partitions_are_an_error(spark, tmp_path):
    spark.dataSource.register(published.NamedFiles)
    path = str(tmp_path / "d")
    rows(spark).select("name", "line").sortWithinPartitions("name").write.format("corpusloom_files").option("path", path).option("job", "j").mode("append").save()
    with open(tmp_path / "d" / "_commits" / "CURRENT", "w") as f:  # what publish does after the commit
        f.write("j")
    with pytest.raises(Exception, match="written twice"):
        published.manifest(spark, path).collect()


def test_corrections_are_one_document_in_lines(spark, tmp_path):
    given = [(9, "u1", "s", "t"), (10, "u2", "s2", None), (10, "u1", 'a"b', "x\ny"), (9, "u0", None, "z")]
    table = spark.createDataFrame(given, "rank int, unit_id string, source_sha256 string, translation string")
    writers.correction_files(table, str(tmp_path / "e"), "corrections-1")
    path = published.manifest(spark, str(tmp_path / "e")).first()
    assert path["name"] == "corrections-1.json" and path["lines"] == 4
    units = {}
    for r, u, s, t in given:
        units.setdefault(str(r), {})[u] = {k: v for k, v in (("source_sha256", s), ("translation", t)) if v is not None}
    assert json.load(open(path["path"])) == {"corrections": units}
    back = readers.corrections(spark, str(tmp_path / "e"))
    assert sorted((r["rank"], r["unit_id"], r["source_sha256"], r["translation"]) for r in back.collect() if r["source_sha256"]) == sorted(g for g in given if g[2])
    writers.correction_files(table.limit(0), str(tmp_path / "f"), "corrections-1")
    assert json.load(open(published.manifest(spark, str(tmp_path / "f")).first()["path"])) == {"corrections": {}}
