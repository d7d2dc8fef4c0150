"""Every query with a twin in SQL gives the same rows; the others run."""

from __future__ import annotations

import duckdb
import pytest

from corpusloom.plans import catalog, oracle, repair, workflow

QUERIES = catalog.QUERIES | workflow.QUERIES | repair.QUERIES
ORACLES = oracle.ORACLES | workflow.ORACLES | repair.ORACLES
DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(tuple(map(str, r)) for r in frame[columns].astype(object).where(frame[columns].notna(), None).values.tolist())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, DATA).toPandas()
    if name in ORACLES:
        assert rows(found) == rows(duck.execute(ORACLES[name]).df())
    else:
        assert len(found)


def test_twins_have_queries():
    assert set(ORACLES) <= set(QUERIES)
