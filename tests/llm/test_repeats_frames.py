"""Repeated passages: what packs send to buckets and shards goes in frames whose number doesn't grow with packs times buckets."""

from __future__ import annotations

import random

import numpy as np

from corpusloom.llm import repeats
from tests.llm.test_operators import cut, repeated_rows


def test_a_frame_is_for_all_buckets(spark, monkeypatch):
    frames = {name: spark.sparkContext.accumulator(0) for name in ("contexts", "judge", "edges", "compare")}

    def counting(run):
        counter = frames.get(run.__name__)

        def task(batches):
            for x in run(batches):
                if counter is not None:
                    counter.add(1)
                yield x

        return task

    buckets, parts = 60, 6
    monkeypatch.setattr(repeats, "lean", counting)
    monkeypatch.setattr(repeats, "buckets_for", lambda size: buckets)
    monkeypatch.setattr(repeats, "SHARD_BYTES", 200)
    rows = repeated_rows(300)
    want = cut([(i, t.encode()) for i, t in rows])
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in repeats.repeats(table).collect()}
    assert got == want
    sent = {name: counter.value for name, counter in frames.items()}
    assert 0 < sent["contexts"] <= parts and 0 < sent["judge"] <= buckets and 0 < sent["edges"] <= parts, sent
    assert sent["compare"] > 0


def test_least_of_shards_is_found_for_windows_that_others_share():
    rng = random.Random(5)
    words = sorted({bytes(rng.choices(b"ab\0", k=50)) for _ in range(400)})
    shards = []
    for _ in range(4):
        some = sorted(rng.sample(words, 150))
        windows = np.array([w + b"\1" for w in some], dtype=f"S{repeats.LENGTH + 1}")
        shards.append((windows, np.array([rng.randrange(100) for _ in some])))
    least = {}
    for windows, ids in shards:
        for w, i in zip(windows.tolist(), ids.tolist(), strict=True):
            least[w] = min(i, least.get(w, i))
    for (windows, _), found in zip(shards, repeats.merged_least(shards), strict=True):
        assert found.tolist() == [least[w] for w in windows.tolist()]
