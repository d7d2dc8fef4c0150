"""Landing as a stream: rate limits, failures, restarts in the middle, and listings that grow."""

from __future__ import annotations

import json
from collections import Counter

import pytest

from corpusloom.sources import landing
from tests import stub_landing


@pytest.fixture
def service(tmp_path):
    folder = tmp_path / "service"
    folder.mkdir()
    (folder / "clock").write_text("1000")
    (folder / "items").write_text(json.dumps(list(range(26))))
    return folder


class Run:
    def __init__(self, spark, path, folder):
        self.spark, self.path, self.folder = spark, path, folder

    def go(self, **options):
        """A query of its own that runs until there is nothing more to be asked for."""
        stream = landing.landed(self.spark, f"stub:{self.folder}?page={{page}}", "tests.stub_landing:fetch", f"{self.path}/state", stub_landing.SIZE, clock="tests.stub_landing:clock", **options)
        query = stream.writeStream.format("parquet").option("path", f"{self.path}/rows").option("checkpointLocation", f"{self.path}/checkpoint").trigger(processingTime="0 seconds").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    def rows(self):
        return self.spark.read.schema(landing.SCHEMA).parquet(f"{self.path}/rows").collect()

    def at(self, seconds):
        (self.folder / "clock").write_text(str(seconds))


def items_of(rows):
    return sorted(int(r["item"]) for r in rows if r["item"])


def test_waits():
    assert [landing.asked_wait(h) for h in ({}, {"Retry-After": "5"}, {"retry-after": "120"}, {"Retry-After": "9999"}, {"Retry-After": "Wed"})] == [60, 60, 120, 300, 60]


def test_pages_come_again_and_restarts_lose_nothing(spark, service, tmp_path):
    folder = service
    run = Run(spark, tmp_path, folder)
    run.go(per_batch=3, tries=3)
    # the service has asked for quiet: pages 1 to 3 were asked for, and no other
    assert items_of(run.rows()) == [0, 1, 2, 3]
    assert {(r["page"], r["status"]) for r in run.rows() if not r["item"]} == {(2, "RETRY"), (3, "RETRY")}
    run.at(1059)
    run.go(per_batch=3, tries=3)
    assert len(run.rows()) == 6
    run.at(1061)
    run.go(per_batch=3, tries=3)
    # page 2 is there; page 3 was limited again, for 300 seconds at most; each run was a restart
    assert items_of(run.rows()) == list(range(8))
    run.at(1360)
    run.go(per_batch=3, tries=3)
    assert items_of(run.rows()) == list(range(8))
    run.at(1362)
    run.go(per_batch=3, tries=3)
    for now in (1365, 1375, 1400):
        run.at(now)
        run.go(per_batch=3, tries=3)
    assert items_of(run.rows()) == [i for i in range(26) if i // 4 not in (3, 4)]
    book = {r["page"]: (r["status"], r["tries"], r["items"]) for r in landing.ledger(spark.createDataFrame(run.rows(), landing.SCHEMA)).collect()}
    assert book[2] == ("RECOVERED", 2, 4) and book[3] == ("RECOVERED", 3, 4) and book[4] == ("FAILED", 1, 0) and book[5] == ("FAILED", 3, 0) and book[7] == ("RECOVERED", 1, 2)
    assert len((folder / "asked-1").read_text()) == 1
    assert all(n == 1 for n in Counter((r["page"], r["place"]) for r in run.rows() if r["item"]).values())


def test_batch_that_runs_again_asks_for_the_same_pages(service, tmp_path):
    options = {"url": f"stub:{service}?page={{page}}", "fetch": "tests.stub_landing:fetch", "state": str(tmp_path / "state"), "full": "4", "per_batch": "2", "clock": "tests.stub_landing:clock"}
    first = landing._Reader(options)
    end = first.latestOffset()
    assert end == {"plan": 1, "next": 3, "retry_at": 0, "etag": ""} and landing._Reader(options).latestOffset() == end
    pages = first.partitions(first.initialOffset(), end)
    assert [p.page for p in pages] == [1, 2] and first.partitions(end, end) == []
    list(first.read(pages[0]))
    # one page of the plan hasn't been asked for, so there is no other plan, whoever asks
    assert landing._Reader(options).latestOffset() == end
    again = [r for p in landing._Reader(options).partitions(first.initialOffset(), end) for r in landing._Reader(options).read(p)]
    assert [r[0] for r in again] == [1, 1, 1, 1, 2, 2, 2, 2] or [r[3] for r in again][-1] == "RETRY"
    assert landing._Reader(options).latestOffset()["plan"] == 2


def test_listing_that_grows(service, tmp_path):
    (service / "items").write_text(json.dumps(list(range(2))))
    options = {"url": f"stub:{service}?page={{page}}", "fetch": "tests.stub_landing:fetch", "state": str(tmp_path / "state"), "full": "4", "per_batch": "1", "poll": "30", "clock": "tests.stub_landing:clock"}
    reader, at, got = landing._Reader(options), landing._Reader(options).initialOffset(), []

    def step():
        nonlocal at
        end = reader.latestOffset()
        for p in reader.partitions(at, end):
            got.extend(r[2] for r in reader.read(p) if r[2])
        moved, at = end != at, end
        return moved

    assert step() and not step() and got == ["0", "1"]
    (service / "clock").write_text("1031")
    assert step() and not step() and got == ["0", "1"] and at["etag"] == '"1-2"'
    (service / "items").write_text(json.dumps(list(range(3))))
    (service / "clock").write_text("1062")
    assert step() and got == ["0", "1", "2"]
    (service / "items").write_text(json.dumps(list(range(6))))
    (service / "clock").write_text("1100")
    while step():
        (service / "clock").write_text(str(float((service / "clock").read_text()) + 10))
    assert got == [str(i) for i in range(6)]
