"""Units as state of a stream: over batches and a restart the rows are those of a pass over all records."""

from __future__ import annotations

import json
import os
import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from corpusloom.streaming import units

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def made(seed, n=60):
    """Records of n units, in the order in which they come: sources may come late, corrections and repetitions at any time."""
    rng = random.Random(seed)
    records = []
    for u in range(n):
        key = {"rank": u % 7, "unit_id": f"u{u}"}
        records.append(key | {"kind": "unit", "source_sha256": f"s{u}", "when": rng.random()})
        for k in range(rng.choice([0, 1, 1, 2, 3])):
            kind = rng.choice(["translation", "translation", "correction"])
            source = f"s{u}" if rng.random() < 0.85 else "other"
            records.append(key | {"kind": kind, "source_sha256": source, "translation": rng.choice(["x", "y", f"t{k}"]), "seq": rng.randint(1, 5), "when": rng.random()})
            if rng.random() < 0.2:
                records.append(dict(records[-1], when=rng.random()))
    records.sort(key=lambda r: r["when"])
    return [{k: v for k, v in r.items() if k != "when"} | {"at": (START + timedelta(seconds=10 * i)).isoformat()} for i, r in enumerate(records)]


def of_all(records):
    """Newest translation of each unit, units with several different ones, and records of other sources."""
    best, hashes, stale = {}, {}, 0
    for r in records:
        if r["kind"] == "unit":
            continue
        key = (r["rank"], r["unit_id"])
        if r["source_sha256"] == "other":
            stale += 1
            continue
        now = (r["seq"], r["translation"])
        best[key] = max(best.get(key, now), now)
        if r["kind"] == "translation":
            hashes.setdefault(key, set()).add(r["translation"])
    return best, {k: len(v) for k, v in hashes.items() if len(v) > 1}, stale


def test_stream_with_a_restart_is_a_pass_over_all_records(spark, tmp_path):
    records = made(11)
    folder = tmp_path / "in"
    folder.mkdir()
    parts = [records[i : i + 30] for i in range(0, len(records), 30)]

    def land(some):
        for i, part in some:
            path = folder / f"part-{i:03}.json"
            path.write_text("\n".join(json.dumps(r) for r in part))
            os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))  # files are read in the order in which they came

    def run():
        events = units.unit_events(units.record_files(spark, str(folder)), 300)
        query = events.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
        query.awaitTermination()

    numbered = list(enumerate(parts))
    land(numbered[:2])
    run()
    land(numbered[2:])
    # long after all others, so that whatever waits is over
    land([(999, [{"rank": 99, "unit_id": "end", "kind": "unit", "source_sha256": "z", "at": (START + timedelta(days=9)).isoformat()}])])
    run()
    land([(1000, [{"rank": 99, "unit_id": "after", "kind": "unit", "source_sha256": "z", "at": (START + timedelta(days=10)).isoformat()}])])
    run()
    found = spark.read.parquet(str(tmp_path / "out"))
    best, several, stale = of_all(records)
    assert {(r["rank"], r["unit_id"]): (r["seq"], r["translation"]) for r in units.settled(found).collect()} == best
    conflicts = found.filter("event = 'CONFLICT'").groupBy("rank", "unit_id").agg(F.max("n_translations").alias("n"), F.count("*").alias("rows")).collect()
    assert {(r["rank"], r["unit_id"]): r["n"] for r in conflicts} == several and all(r["rows"] == r["n"] - 1 for r in conflicts)
    assert found.filter("event = 'STALE'").count() == stale
    late = {(r["rank"], r["unit_id"]) for r in found.filter("event = 'TIMED_OUT'").collect()}
    never = {(r["rank"], r["unit_id"]) for r in records} - set(best)
    assert never <= late and found.filter("event = 'TIMED_OUT'").count() == len(late)
    waited = {}
    for r in records:
        key = (r["rank"], r["unit_id"])
        if r["kind"] == "unit":
            waited[key] = r["at"]
    # who was told as late had no translation within the time
    for r in found.filter("event = 'TIMED_OUT' and rank < 99").collect():
        in_time = [x for x in records if (x["rank"], x["unit_id"]) == (r["rank"], r["unit_id"]) and x["kind"] != "unit" and x["source_sha256"] != "other" and datetime.fromisoformat(x["at"]) <= datetime.fromisoformat(waited[r["rank"], r["unit_id"]])]
        assert not in_time
