"""All pairs of vectors with a cosine of at least a threshold, by traversing pairs of cover trees.

Vectors of length 1 are points; a cosine of t is a distance of sqrt(2 - 2t). Equal vectors are one point with a weight.
The top nodes of the tree are pivots, a sample of the points by hash; each point belongs to its nearest pivot, and the points
of one pivot, or one part of them, are a block: one row of a table, and a tree of nested levels with halving radii. Blocks meet
each other in a product of the table with itself, whose tasks read it where it lies: points that visit a block aren't
copied to disk for that, however many blocks they visit. Points of another block count as visitors if they can lie within the
threshold of one of the block's points by the triangle inequality: by the pivot's covering radius, and as their own pivot is the
nearest to them. Each pair of pivots meets in one of its two places, chosen so that no place is visited by all. Visitors
come in batches, each a tree of its own. Two trees are traversed together, level by level: a pair of nodes is left if
their centres are farther apart than the threshold and both covering radii, counted as a whole if all of one must be linked
with all of the other, and else replaced by the pairs of their children.

A task returns sums of links and a spanning forest of its links, no more than a row or two for each point that it saw.

Vectors that are null, empty, zero, or hold nulls or non-finite values link with nothing, and so do vectors of different
lengths. Equal vectors are linked. Rows that repeat a vec_id are vectors of their own. An empty table gives an empty table.
Columns other than vec_id and embedding are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.common import lean, shuffle_width, written
from corpusloom.llm.components import components, local_roots

#: Points of a tree; visitors are handled in batches of as many.
PART = 3000
#: Pivots, and their bytes, at most: what is broadcast is no more than these.
PIVOTS, PIVOT_BYTES = 8192, 32 << 20
#: Bytes of blocks that a task holds at most, to go through them once for each block that they visit.
GUEST_BYTES = 48 << 20
RADII = (1.0, 0.5, 0.25, 0.125, 0.0625)
#: What a block's row holds of its points.
PACKED = ("ids", "weights", "offs", "x")
#: The level at which visitors are told apart.
NEAR_LEVEL = 2
#: Distances carry rounding errors, so bounds give way by so much; pairs in between are decided by their cosine.
SLIP = 1e-7
#: As much for products in single precision.
ROUGH = 1e-4


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = a @ b.T
    out *= -2
    out += 2
    return np.sqrt(np.maximum(out, 0, out=out), out=out)


def _outline(x: np.ndarray) -> np.ndarray:
    """The first half of each point, and the length of the rest: products of outlines are no smaller than cosines."""
    half = max(1, x.shape[1] // 2)
    return np.concatenate((x[:, :half], np.linalg.norm(x[:, half:], axis=1, keepdims=True)), 1).astype(np.float32)


class Tree:
    """Nested levels over points x: label[l][i] is the centre at level l of point i; the last level is the points."""

    def __init__(self, x: np.ndarray, weight: np.ndarray):
        self.x, self.weight, n = x, weight, len(x)
        self.tops: tuple | None = None
        apart = _apart(x, x)
        parent = np.zeros(n, dtype=np.int64)
        self.label, self.reach, self.sum = [], [], []
        for radius in RADII:
            label = np.full(n, -1)
            alone = np.bincount(parent, minlength=n)[parent] == 1
            label[alone] = np.flatnonzero(alone)
            # a parent's centre comes first, so it is a centre again
            for i in [*np.unique(parent), *range(n)] if self.label else range(n):
                if label[i] < 0:
                    near = (label < 0) & (apart[i] <= radius) & (parent == parent[i])
                    label[near] = i
                    label[i] = i
            self._level(label, apart)
            parent = label
        self._level(np.arange(n), apart)

    def _level(self, label: np.ndarray, apart: np.ndarray) -> None:
        reach, total = np.zeros(len(label)), np.zeros(len(label), dtype=np.int64)
        np.maximum.at(reach, label, apart[label, np.arange(len(label))])
        np.add.at(total, label, self.weight)
        self.label.append(label)
        self.reach.append(reach)
        self.sum.append(total)

    def near(self, x: np.ndarray, limit: float) -> np.ndarray:
        """Which of the points x may be within limit of a point of this tree."""
        if self.tops is None:
            # a level whose nodes reach less far than limit, so that few points seem near that aren't
            top = np.unique(self.label[NEAR_LEVEL])
            bound = 1 - (limit + 2 * SLIP + self.reach[NEAR_LEVEL][top]) ** 2 / 2
            self.tops = top, bound, _outline(self.x[top]), (bound - ROUGH).astype(np.float32)
        top, bound, outline, rough = self.tops
        may = (_outline(x) @ outline.T >= rough).any(axis=1)
        at = np.flatnonzero(may)
        may[at] = (x[at] @ self.x[top].T >= bound).any(axis=1)
        return may

    def children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The centres at the next level below nodes, and how many each node has."""
        below = np.unique(self.label[level + 1])
        above = self.label[level][below]
        order = np.argsort(above, kind="stable")
        below, above = below[order], above[order]
        start, end = np.searchsorted(above, nodes), np.searchsorted(above, nodes, side="right")
        many = end - start
        at = np.repeat(start - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
        return below[at], many


def linked(a: Tree, b: Tree, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Weights linked to each point of a and of b, and links (of a, of b) that connect all that is linked.

    With b the same tree as a, pairs inside it, and all sums are in the first result."""
    same, limit = a is b, float(np.sqrt(2 - 2 * threshold))
    links_a, links_b = np.zeros(len(a.x), dtype=np.int64), np.zeros(len(b.x), dtype=np.int64)
    edges: list[tuple[np.ndarray, np.ndarray]] = []
    inner: list[tuple[np.ndarray, np.ndarray]] = []  # of a, and of b further down, among themselves
    u, v = np.unique(a.label[0]), np.unique(b.label[0])
    # the tops are many in many dimensions: one matrix product leaves out nearly all of their pairs
    near = a.x[u] @ b.x[v].T >= 1 - (limit + 2 * SLIP + a.reach[0][u][:, None] + b.reach[0][v][None, :]) ** 2 / 2
    if same:
        near &= u[:, None] <= v[None, :]
    at = np.nonzero(near)
    u, v = u[at[0]], v[at[1]]
    last = len(RADII)
    for level in range(last + 1):
        if same:
            u, v = u[u <= v], v[u <= v]
        left_u, left_v = [], []
        for at in range(0, len(u), 1 << 18):
            p, q = u[at : at + (1 << 18)], v[at : at + (1 << 18)]
            cos = np.einsum("ij,ij->i", a.x[p], b.x[q])
            if level == last:
                hit = cos >= threshold
                if same:
                    hit &= p != q
                p, q = p[hit], q[hit]
                np.add.at(links_a, p, b.weight[q])
                np.add.at(links_a if same else links_b, q, a.weight[p])
                edges.append((p, q))
                continue
            apart = np.sqrt(np.maximum(0, 2 - 2 * cos))
            wide = a.reach[level][p] + b.reach[level][q]
            within = apart + wide <= limit - SLIP
            if same:
                # a node with itself: any two of its points are at most twice its reach apart
                within &= (p != q) | (a.sum[level][p] > 0)
            if within.any():
                for x, y in ((p[within], q[within]),):
                    self_ = (x == y) if same else np.zeros(len(x), dtype=bool)
                    got_a, got_b = np.zeros(len(a.x), dtype=np.int64), np.zeros(len(b.x), dtype=np.int64)
                    np.add.at(got_a, x, b.sum[level][y])
                    np.add.at(got_a if same else got_b, y[~self_], a.sum[level][x[~self_]])
                    links_a += got_a[a.label[level]]
                    links_b += got_b[b.label[level]]
                    if self_.any():  # a point isn't linked with itself
                        mine = np.zeros(len(a.x), dtype=bool)
                        mine[x[self_]] = True
                        links_a -= np.where(mine[a.label[level]], a.weight, 0)
                    edges.append((x, y))
                    for tree, nodes, side in ((a, x, 0), (b, y, 1)):
                        under = np.flatnonzero(np.isin(tree.label[level], nodes))
                        inner.append((under + side * (0 if same else len(a.x)), tree.label[level][under] + side * (0 if same else len(a.x))))
            rest = ~within & (apart <= limit + wide + SLIP)
            left_u.append(p[rest])
            left_v.append(q[rest])
        if level == last:
            break
        u, v = np.concatenate(left_u or [u[:0]]), np.concatenate(left_v or [v[:0]])
        if len(u):
            cu, nu = a.children(level, u)
            cv, nv = b.children(level, v)
            # every child of u with every child of v
            first_u, first_v = np.cumsum(nu) - nu, np.cumsum(nv) - nv
            pairs = nu * nv
            k = np.arange(pairs.sum()) - np.repeat(np.cumsum(pairs) - pairs, pairs)
            wide_v = np.repeat(nv, pairs)
            own = np.repeat(u == v, pairs) if same else None
            u, v = cu[np.repeat(first_u, pairs) + k // wide_v], cv[np.repeat(first_v, pairs) + k % wide_v]
            if same:
                u, v = np.where(own, u, np.minimum(u, v)), np.where(own, v, np.maximum(u, v))
    offset = 0 if same else len(a.x)
    start = np.concatenate([x for x, _ in edges] + [x for x, _ in inner] or [np.zeros(0, dtype=np.int64)])
    end = np.concatenate([y + offset for _, y in edges] + [y for _, y in inner] or [np.zeros(0, dtype=np.int64)])
    return links_a, links_b, start.astype(np.int64), end.astype(np.int64)


def _unit(vectors: pd.Series) -> np.ndarray:
    return _scaled(np.stack([np.asarray(v, dtype=np.float64) for v in vectors]))


def _scaled(x: np.ndarray) -> np.ndarray:
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that no square is lost or endless
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def near_duplicates(vectors: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    value = F.transform("embedding", lambda v: v.cast("double"))
    sound = F.coalesce(
        F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))) & F.exists(value, lambda v: v != 0),
        F.lit(False),
    )
    key = F.when(sound, F.xxhash64("embedding")), F.when(sound, F.xxhash64(F.lit(7), "embedding"))
    keyed = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", key[0].alias("h1"), key[1].alias("h2"))
    points = written(
        keyed.filter(F.col("h1").isNotNull() & F.col("vec_id").isNotNull())
        .groupBy("h1", "h2")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"), F.first("embedding").alias("embedding"))
        .withColumn("dim", F.size("embedding"))
    )
    per_dim = {r["dim"]: r["n"] for r in points.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    found = [_linked_points(points.filter(F.col("dim") == dim), n, dim, threshold) for dim, n in sorted(per_dim.items())]
    rows = keyed.select("vec_id", "h1", "h2")
    if not found:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    out = written(out)
    sums = out.filter("v is null").groupBy(F.col("u").alias("id")).agg(F.sum("n").alias("n"))
    groups = components(out.filter("v is not null").select("u", "v")).withColumnRenamed("node", "id")
    classes = points.select("h1", "h2", "id", "weight").join(sums, "id", "left").join(groups, "id", "left")
    component = F.coalesce("component", "id", "vec_id")
    return (
        rows.join(classes, ["h1", "h2"], "left")
        .select("vec_id", F.coalesce(F.col("weight") - 1 + F.coalesce("n", F.lit(0)), F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )


def _linked_points(points: DataFrame, n: int, dim: int, threshold: float) -> DataFrame:
    """(u, null, n): so much weight is linked to point u; (u, v, null): u and v are in one component."""
    spark = points.sparkSession
    limit = float(np.sqrt(2 - 2 * threshold))
    many = int(min(PIVOTS, max(1, PIVOT_BYTES // (8 * dim)), max(1, -(-n // PART))))
    pivots = _unit(pd.Series([r["embedding"] for r in points.orderBy(F.xxhash64("id"), "id").limit(many).collect()]))

    kind = "<f4" if isinstance(points.schema["embedding"].dataType.elementType, T.FloatType) else "<f8"

    def nearest(vectors: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each vector, and how far its pivot is."""
        apart = _apart(_unit(vectors), pivots)
        cell = apart.argmin(1)
        return cell, apart[np.arange(len(cell)), cell]

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                cell, n = np.unique(nearest(frame["embedding"])[0], return_counts=True)
                yield pd.DataFrame({"cell": cell, "n": n})

    parts = np.ones(many, dtype=np.int64)
    for r in points.select("embedding").mapInPandas(lean(count), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        parts[r["cell"]] = -(-r["n"] // PART)

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                cell, off = nearest(frame["embedding"])
                x = np.stack([np.asarray(v, dtype=kind) for v in frame["embedding"]])
                ids, weight = frame["id"].to_numpy(), frame["weight"].to_numpy()
                part = (ids * 0x9E3779B1 & 0x7FFFFFFF) % parts[cell]
                order = np.lexsort((part, cell))
                cell, part = cell[order], part[order]
                cut = np.concatenate(([0], np.flatnonzero((cell[1:] != cell[:-1]) | (part[1:] != part[:-1])) + 1, [len(cell)]))
                packed = [[v[order[i:j]].tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)] for v in (ids, weight, off, x)]
                yield pd.DataFrame({"cell": cell[cut[:-1]], "part": part[cut[:-1]], **dict(zip(PACKED, packed, strict=True))})

    def gather(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One row for each block, of rows sorted by block."""
        place, held = None, []

        def block() -> pd.DataFrame:
            return pd.DataFrame({"cell": [place[0]], "part": [place[1]], **{c: [b"".join(getattr(r, c) for r in held)] for c in PACKED}})

        for frame in frames:
            for row in frame.itertuples():
                if (row.cell, row.part) != place and held:
                    yield block()
                    held = []
                place = row.cell, row.part
                held.append(row)
        if held:
            yield block()

    shape = "cell int, part long, ids binary, weights binary, offs binary, x binary"
    blocks = written(
        points.select("id", "weight", "embedding")
        .mapInPandas(lean(deal), shape)
        .repartition(max(shuffle_width(spark), min(int(parts.sum()), 4096)), "cell", "part")
        .sortWithinPartitions("cell", "part")
        .mapInPandas(lean(gather), shape)
    )

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, home, ids, held = None, None, None, []

        def result(ids_: np.ndarray, links: np.ndarray, u: np.ndarray, v: np.ndarray) -> pd.DataFrame:
            roots = local_roots(len(ids_), u, v)
            hung = np.flatnonzero(roots != np.arange(len(ids_)))
            some = np.flatnonzero(links)
            return pd.DataFrame(
                {
                    "u": np.concatenate((ids_[some], ids_[hung])),
                    "v": pd.array(np.concatenate((np.zeros(len(some), dtype=np.int64), ids_[roots[hung]])), dtype="Int64"),
                    "n": pd.array(np.concatenate((links[some], np.zeros(len(hung), dtype=np.int64))), dtype="Int64"),
                }
            ).assign(v=lambda d: d["v"].mask(np.arange(len(d)) < len(some)), n=lambda d: d["n"].mask(np.arange(len(d)) >= len(some)))

        def unit(x: bytes) -> np.ndarray:
            return _scaled(np.frombuffer(x, dtype=kind).reshape(-1, dim).astype(np.float64))

        def visited() -> pd.DataFrame:
            """Links between the block and the visitors held."""
            guests, weight, x = (np.concatenate(some) for some in zip(*held, strict=True))
            held.clear()
            links, more, u, v = linked(home, Tree(x, weight), threshold)
            return result(np.concatenate((ids, guests)), np.concatenate((links, more)), u, v)

        for frame in frames:
            for row in frame.itertuples():
                if (row.cell, row.part) != place:
                    if held:
                        yield visited()
                    place, home = (row.cell, row.part), None
                    reach = np.frombuffer(row.offs, dtype=np.float64).max()
                own = (row.guest_cell, row.guest_part) == place
                if not own:
                    x, off = unit(row.guest_x), np.frombuffer(row.guest_offs, dtype=np.float64)
                    apart = _apart(x, pivots[row.cell : row.cell + 1])[:, 0]
                    near = np.flatnonzero((apart <= reach + limit + SLIP) & (apart <= off + 2 * limit + SLIP))
                    if not len(near):
                        continue
                if home is None:
                    ids, home = np.frombuffer(row.ids, dtype=np.int64), Tree(unit(row.x), np.frombuffer(row.weights, dtype=np.int64))
                if own:
                    links, _, u, v = linked(home, home, threshold)
                    yield result(ids, links, u, v)
                    continue
                # most guests are far from all top nodes of the tree, and need no tree of their own
                near = near[home.near(x[near], limit)]
                for at in range(0, len(near), PART):
                    some = near[at : at + PART]
                    if sum(len(g) for g, _, _ in held) + len(some) > PART:
                        yield visited()
                    held.append((np.frombuffer(row.guest_ids, dtype=np.int64)[some], np.frombuffer(row.guest_weights, dtype=np.int64)[some], x[some]))
        if held:
            yield visited()

    guests = blocks.select(*[F.col(c).alias(f"guest_{c}") for c in blocks.columns]).coalesce(max(1, -(-n * (dim * np.dtype(kind).itemsize + 24) // GUEST_BYTES)))
    # how far the block's cell is round from the guest's
    turn, circle = F.pmod(F.col("cell") - F.col("guest_cell"), F.lit(many)) * 2, F.lit(many)
    meets = F.when(turn == 0, F.col("guest_part") <= F.col("part")).otherwise((turn < circle) | ((turn == circle) & (F.col("guest_cell") < F.col("cell"))))
    return blocks.hint("shuffle_replicate_nl").join(guests, meets).mapInPandas(lean(compare), "u long, v long, n long")
