"""Rosters by bitmaps against anti joins; first values of groups; titles in order."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import gates, ledger, pages


def ids(spark, values):
    return spark.createDataFrame([(v, "x") for v in values], "id long, bucket string").repartition(3)


@pytest.mark.parametrize("seed", range(5))
def test_bitmaps_are_anti_joins(spark, seed):
    rng = random.Random(seed)
    pool = [rng.choice([rng.randint(-90_000, 90_000), rng.randint(0, 40), 1 << 40]) for _ in range(400)] + [None]
    every, selected, excluded = ([rng.choice(pool) for _ in range(n)] for n in (300, 80, 80))
    if not seed:  # nothing is wrong
        selected, excluded = every[:100], [v for v in every if v not in every[:100]]
    tables = [ids(spark, [v for v in t if v is not None] if not seed else t) for t in (every, selected, excluded)]
    rows = lambda f: sorted(map(tuple, f(*tables, "id").filter("id is not null").collect()))
    got = rows(gates.partition_violations_by_bitmaps)
    assert got == rows(gates.partition_violations) and bool(got) == bool(seed)
    sums = gates.partition_counts(*tables, "id").agg(F.sum("in_both"), F.sum("in_none"), F.sum("unknown")).first()
    assert tuple(sums) == tuple(sum(v == kind for _, v in got) for kind in ("in_both", "in_none", "unknown"))


def test_first_of_groups(spark):
    rows = [(g, f"n{i:03}") for i in range(200) for g in ("a", None, "b")] + [("c", None), ("b", "n000")]
    found = ledger.first_of(spark.createDataFrame(rows, "g string, name string").repartition(5), ["g"], "name", 3).collect()
    assert {r["g"]: (r["n"], r["first"]) for r in found} == {"a": (200, ["n000", "n001", "n002"]), None: (200, ["n000", "n001", "n002"]), "b": (201, ["n000", "n000", "n001"]), "c": (1, [])}


def test_titles_in_order_by_group(spark):
    rows = [("g", f"g/{i}", i) for i in (10, 9, 100)] + [(None, "x/b", 1), (None, "x/a", 2), ("g", "g/9", 0), ("h", "h", 5)]
    table = spark.createDataFrame(rows, "g string, title string, id int").repartition(3)
    found = pages.in_title_order(table, "title", "g", ("id",))
    assert found.columns == ["g", "title", "id", "place"]
    assert sorted((r["g"] or "", r["place"], r["title"], r["id"]) for r in found.collect()) == [("", 1, "x/a", 2), ("", 2, "x/b", 1), ("g", 1, "g/9", 0), ("g", 2, "g/9", 9), ("g", 3, "g/10", 10), ("g", 4, "g/100", 100), ("h", 1, "h", 5)]
