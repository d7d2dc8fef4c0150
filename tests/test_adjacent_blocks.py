"""Blocks said again at once, over whole batches, are those that a loop over each row finds; their lists never become Python objects."""

from __future__ import annotations

import random

import pyarrow as pa

from corpusloom.operators import similarity


def by_loop(t):
    best = (0, 0, 0, None)
    for size in range(1, min(32, len(t) // 2) + 1):
        same = 0
        for i in range(len(t) - 1, size - 1, -1):
            same = same + 1 if t[i] == t[i - size] else 0
            count = same // size + 1
            if count >= (3 if size == 1 else 2) and (size * count, size, count) >= best[:3]:
                best = (size * count, size, count, " ".join(t[i - size : i]))
    return {"size": best[1], "count": best[2], "score": best[0], "phrase": best[3]}


def test_batches_are_as_loops():
    rng = random.Random(5)
    rows = [None, [], ["a"], ["a", "a"], ["a"] * 3, list("abab"), ["x"] * 80]
    rows += [[rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(0, 90))] for _ in range(1500)]
    got = similarity._adjacent.func(pa.array(rows, pa.list_(pa.string())))
    assert got.to_pylist() == [by_loop(r or []) for r in rows]
    assert similarity._adjacent.func(pa.array([], pa.list_(pa.string()))).to_pylist() == []
