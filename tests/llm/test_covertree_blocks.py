"""Links of vectors that lie in all directions: blocks meet where their table lies, and no visitor is copied to disk."""

from __future__ import annotations

import numpy as np
import pytest

from corpusloom.llm import covertree
from corpusloom.llm.components import local_roots


@pytest.mark.parametrize("kind", ["float", "double"])
def test_visits_move_nothing(spark, monkeypatch, kind):
    plans = []

    def written(df, write=covertree.written):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df)

    monkeypatch.setattr(covertree, "written", written)
    monkeypatch.setattr(covertree, "PART", 40)
    rng = np.random.default_rng(11)
    x = rng.normal(size=(700, 24))
    # some have neighbours, and one group is larger than a block
    x[300:400] = x[:100] + 0.2 * rng.normal(size=(100, 24))
    x[500:600] = x[7] + 0.05 * rng.normal(size=(100, 24))
    x = x.astype(np.float32).astype(np.float64)
    table = spark.createDataFrame(list(enumerate(x.tolist())), f"vec_id long, embedding array<{kind}>").repartition(5)
    got = covertree.near_duplicates(table).toPandas().sort_values("vec_id")
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    assert (got["n_links"].to_numpy() == near.sum(1)).all() and near.sum() > 10_000
    assert (got["component_id"].to_numpy() == local_roots(700, *np.nonzero(near))).all()
    assert "MapInPandas" in plans[-1] and "Exchange" not in plans[-1]


def test_blocks_held_in_parts_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(12)
    base = rng.normal(size=(30, 12))
    x = [(base[rng.integers(30)] + 0.15 * rng.normal(size=12)).tolist() for _ in range(500)]
    table = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    monkeypatch.setattr(covertree, "PART", 35)
    whole = sorted(covertree.near_duplicates(table).collect())
    monkeypatch.setattr(covertree, "GUEST_BYTES", 6000)
    assert sorted(covertree.near_duplicates(table).collect()) == whole and sum(r["n_links"] for r in whole)
