"""Readers, writers and landed pages."""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import ledger
from corpusloom.sources import readers, web, writers


def test_alignments_and_longest(spark, tmp_path):
    for name, n in (("x/043_alignment.jsonl", 2), ("y/043_alignment.jsonl", 3), ("y/044_shard_0000_alignment.jsonl", 1), ("y/other.jsonl", 9)):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("\n\n".join(json.dumps({"unit_id": f"u{i}", "source": "s", "translation": name}) for i in range(n)))
    rows = readers.alignments(spark, str(tmp_path))
    assert {(r["rank"], r["n"]) for r in rows.groupBy("rank").agg(F.count("*").alias("n")).collect()} == {(43, 5), (44, 1)}
    assert {r["rank"]: r["n"] for r in ledger.longest(rows).groupBy("rank").agg(F.count("*").alias("n")).collect()} == {43: 3, 44: 1}


def test_gzipped_base64(spark, tmp_path):
    (tmp_path / "a.b64").write_bytes(base64.encodebytes(gzip.compress(json.dumps({"records": [{"rank": "054"}, {"rank": "091"}]}).encode())))
    found = readers.gzipped_base64_json(spark, str(tmp_path), "records ARRAY<STRUCT<rank: STRING>>").select(F.explode("document.records.rank")).collect()
    assert [r[0] for r in found] == ["054", "091"]


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "book.epub", "w") as z:
        z.writestr("mimetype", "application/epub+zip")
        z.writestr("../evil", "x")
    rows = readers.archive_members(spark, str(tmp_path)).orderBy("position").collect()
    assert [(r.path, r.stored, r.safe) for r in rows] == [("mimetype", True, True), ("../evil", True, False)]
    assert rows[0].sha256 == hashlib.sha256(b"application/epub+zip").hexdigest()


def test_verified(spark):
    sha = hashlib.sha256(b"abc").hexdigest()
    files = spark.createDataFrame([("a", b"abc"), ("b", b"abc"), ("c", b"abc"), ("d", b"abc")], "asset string, content binary")
    manifest = spark.createDataFrame([("a", 3, sha), ("b", 4, sha), ("c", 3, "0" * 64), ("d", 3, "XY"), ("e", 3, sha)], "asset string, size long, sha256 string")
    assert {tuple(r) for r in readers.verified(files, manifest).collect()} == {("b", "size"), ("c", "hash"), ("d", "malformed_hash"), ("e", "absent")}


def test_round_trip_of_ledgers_and_bundles(spark, tmp_path):
    units = spark.createDataFrame([(1, i, f"c{1 + i // 2:02d}-u{i:04d}", 1 + i // 2, "paragraph", f"s{i}", f"t{i}") for i in range(5)], "rank int, ordinal int, unit_id string, chapter int, kind string, source string, translation string")
    writers.write_alignment(units, str(tmp_path / "ledger"))
    back = spark.read.json(str(tmp_path / "ledger"))
    assert back.count() == 5 and back.filter(F.sha2("source", 256) != F.col("source_sha256")).count() == 0
    writers.bundles(units).select("document").coalesce(1).write.text(str(tmp_path / "bundle"))
    again = readers.source_bundle(spark, str(tmp_path / "bundle")).orderBy("ordinal")
    assert [(r.unit_id, r.source) for r in again.collect()] == [(r.unit_id, r.source) for r in units.orderBy("ordinal").collect()]


def test_matrix(spark):
    jobs = ledger.shard_jobs(spark.createDataFrame([(1, 3)], "rank int, shard_count int"))
    assert json.loads(writers.job_matrix(jobs).first()["document"])["include"][2]["shard"] == 2
    with pytest.raises(Exception, match="more than 2 jobs"):
        writers.job_matrix(jobs, limit=2).collect()


def test_fetching():
    answers = iter([(429, {"Retry-After": "3"}, b""), (503, {}, b""), (200, {}, b"ok")])
    slept = []
    assert web.fetched(lambda url: next(answers), "u", sleep=slept.append) == b"ok"
    assert slept == [12.0, 4.0]
    assert web.wait_for(429, {"Retry-After": "soon"}, 2) == 40.0
    with pytest.raises(RuntimeError, match="404 at try 1"):
        web.fetched(lambda url: (404, {}, b""), "u", sleep=slept.append)


def test_listing(spark):
    spark.dataSource.register(web.Listing)
    rows = spark.read.format("corpusloom_listing").options(url="http://x?page={page}", fetch="tests.stub_fetch:listing", pages=2).load()
    found = {(r.name, r.size, r.times) for r in web.assets(rows).collect()}
    assert found == {("a.zip", 1, 2), ("a.zip", 2, 2), ("b.zip", 1, 1)}


def test_wiki(spark):
    parsed = json.dumps({"parse": {"links": [{"ns": 0, "title": "A/1", "exists": True}, {"ns": 4, "title": "T"}, {"ns": 0, "title": "A/1"}, {"ns": 0, "title": "B", "exists": False}]}})
    row = spark.createDataFrame([("A b/ç", parsed)], "title string, parsed string").select(web.page_links(F.col("parsed")).alias("l"), "title")
    assert row.first()["l"] == ["A/1"]
    assert web.wiki_candidates(row.select("title"), "https://w").first()["page_url"] == "https://w/wiki/A_b/%C3%A7"
    names = spark.createDataFrame([("a.zip",), ("..",), ("a/b",), ("",)], "n string").select(web.safe_name(F.col("n"))).collect()
    assert [r[0] for r in names] == [True, False, False, False]
