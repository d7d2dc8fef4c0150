"""Admission by quota against a loop over the units."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from corpusloom.operators import admission

SHAPE = "account string, at int, chars long, bytes long, _one string"


def by_loop(units, quotas, most_bytes, most_texts):
    states = {}
    for account in {u[0] for u in units}:
        chars = size = n = 0
        for _, at, c, b, _ in sorted((u for u in units if u[0] == account), key=lambda u: u[1]):
            c, b = c or 0, b or 0
            if b > most_bytes:
                states[account, at] = ("TOO_LARGE", None)
                continue
            if account not in quotas:
                state = "NO_ACCOUNT"
            else:
                used, limit = quotas[account]
                state = "SENT" if limit is None or (used or 0) + chars + c <= limit else "BLOCKED_QUOTA"
            half = most_bytes // 2
            states[account, at] = (state, (size // half, n // most_texts, n + 1 if b > half else 0) if state == "SENT" else None)
            chars, size, n = chars + c, size + b, n + 1
    return states


@pytest.mark.parametrize("seed", range(4))
def test_admission_is_a_loop(spark, seed):
    rng = random.Random(seed)
    units = []
    for account in ("a", "b", None, "c", "nobody"):
        for at in range(rng.choice([0, 1, 40, 300])):
            units.append((account, at, rng.choice([None, 0, rng.randint(1, 90)]), rng.choice([0, rng.randint(1, 300), 700, 1001]), "x"))
    quotas = {"a": (10, 900), "b": (None, 100_000), None: (0, None), "c": (50, 20), "unused": (0, 1)}
    table = spark.createDataFrame(units, SHAPE).repartition(5)
    sent = admission.admitted(table, spark.createDataFrame([(k, *v) for k, v in quotas.items()], "account string, used long, limit long"), "account", ["at"], most_bytes=1000, most_texts=7)
    assert sent.columns == [*table.columns, "state", "request"]
    got = {(r["account"], r["at"]): (r["state"], tuple(r["request"]) if r["request"] else None) for r in sent.collect()}
    assert got == by_loop(units, quotas, 1000, 7)
    for r in admission.requests(sent, "account").collect():
        assert r["bytes"] <= 1000 and r["texts"] <= 7
    states = {r["account"]: r for r in admission.account_states(sent, "account").collect()}
    counts = Counter((a, s) for (a, _), (s, _) in got.items())
    for account, r in states.items():
        assert (r["sent"], r["blocked"], r["too_large"]) == tuple(counts[account, s] for s in ("SENT", "BLOCKED_QUOTA", "TOO_LARGE"))


def test_sums_before(spark):
    rows = spark.createDataFrame([(i, i % 5 if i % 7 else None, "x") for i in range(500)], "i int, v int, w string").repartition(6)
    found = {r["i"]: r["v_before"] for r in admission.with_sums_before(rows, ["i"], ["v"]).collect()}
    total = 0
    for i in range(500):
        assert found[i] == total
        total += i % 5 if i % 7 else 0
    assert admission.with_sums_before(rows.limit(0), ["i"], ["v"]).collect() == []
