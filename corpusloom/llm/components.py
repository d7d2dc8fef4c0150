"""Connected components of links between rows, for links in a DataFrame of any size."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import checkpoint


def _least(edges: DataFrame) -> DataFrame:
    """For each node u of edges (u, v) the least of it and its neighbours."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) with the least node of each component, for the nodes of edges (u, v), both long.

    Large stars and small stars in turn (each node's neighbours are hung on the least of them) until nothing changes. A
    node with very many neighbours is summed up by a partial aggregation and met again in a join that may split it,
    so that it isn't one task's. Each round's links, no more than the first ones, are checkpointed.
    """
    now = checkpoint(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .filter("u <> v")
            .distinct()
        )
        now = checkpoint(small)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0 to n - 1 with links a[i] - b[i], the least node of each one's component."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(nearer := root[root], root):
            root = nearer
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root
