"""Documents that share most of their five-word shingles, by prefix filters under several token orders.

Two documents link if 100 * common >= share * (all of either). A document of n shingles that links with another one has at least
need = ceil(n * share / 100) of its shingles in common with it, so it lacks at most n - need.

1. Shingles that no other document has are counted, among a fixed part of all shingle hashes (``PART`` of them, the same for
   each document, so the count is exact for these). A document with more than n - need of them links with nothing.
2. The rest is grouped by equal sets; one document stands for each.
3. Among these, all shingles are counted, and each document's shingles are put in order several times: rare ones first, and those
   of like rarity by another hash each time. Under any order two linked documents share a token among their first
   n - need + 1, so candidates are the pairs that share one under every order.
4. Pairs meet where documents are connected, under every order, by tokens among their first ones. Such a block is cut into tiles of
   bounded size; each two tiles meet in a place of their own, so that a block of any size is dealt out evenly. There the pairs that
   share a first token are found for each order, these sets of pairs are intersected, and what is left is verified by exact overlap.

Pairs are never written down, only sums of links and a spanning forest of them; a token that very many documents hold connects each
of them with the least one only. A block whose documents all link costs as much work as it has pairs, as links are counted.

Null texts and texts without words have no shingles and no links. Each row is a document of its own, whatever its doc_id: rows that
repeat one link like any others, and so do rows with a null doc_id, which are the last of their group and name it only if it has
no other (component_id null). An empty table gives an empty table. Columns other than doc_id and text are ignored;
``first_of_each`` gives all of them back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import bucketed, checkpoint, lean, shuffle_width, written
from corpusloom.llm.components import components, local_roots
from corpusloom.llm.exchange import bucket_of, buckets_for, placed, token_counts
from corpusloom.llm.packs import known_column, longs, packed, texts_of
from corpusloom.llm.shingles import mixed, shingle_sets, signature

SHARE = 80
#: The part of all hashes, of 256, in which shingles without a second document are counted.
PART = 104
#: Bits of a row's number in its pack, more than PACK_ROWS has.
AT_BITS = 18
#: Places in which a group's first document meets the others.
SALTS = 64
#: Seeds of the token orders.
ORDERS = (1, 2)
#: Documents and shingles of a tile, at most; a smaller block has tiles of SMALL_TILE until they are SPREAD, so that it is dealt out, too.
TILE, TILE_SHINGLES, SMALL_TILE, SPREAD = 1500, 1 << 19, 150, 24


def lacking(n: np.ndarray, share: int) -> np.ndarray:
    """How many of its n shingles a document may lack in one that it links with."""
    return n - -(-n * share // 100)


def _sets_of(texts: list[bytes]) -> list[np.ndarray]:
    return [found for at in range(0, len(texts), 200) for found in shingle_sets(texts[at : at + 200])]


def _in_part(row: object) -> list[np.ndarray]:
    return [found[(found & np.uint64(255)) < PART] for found in _sets_of(texts_of(row))]


def linked_components(docs: DataFrame, share: int = SHARE) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, n_links (other documents linked directly)."""
    _, found = _grouped(docs.select("doc_id", "text"), share)
    return found.select("doc_id", "n_shingles", "component_id", "n_links")


def first_of_each(docs: DataFrame, share: int = SHARE) -> DataFrame:
    """The rows of docs, with all their columns, that are the first of their component: by doc_id (null last), of equal ones any one."""
    columns = docs.columns
    packs, found = _grouped(docs, share)
    stay = found.filter("first").groupBy("pack").agg(F.sort_array(F.collect_list("at")).alias("stay"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in pd.DataFrame(batch.to_pydict()).itertuples():
                rest = pa.ipc.open_stream(row.rest).read_all().combine_chunks()
                texts = texts_of(row)
                known = rest.column(known_column(columns)).to_pylist()
                text = pa.array([texts[i].decode("utf-8", "surrogatepass") if known[i] else None for i in row.stay], pa.string())
                arrays = [text if c == "text" else rest.column(c).combine_chunks().take(pa.array(row.stay)) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return packs.select("pack", "lengths", "texts", "rest").join(stay, "pack").mapInArrow(lean(run), docs.schema)


def _grouped(docs: DataFrame, share: int) -> tuple[DataFrame, DataFrame]:
    """The packs of docs, and per row: pack, at, doc_id, n_shingles, component_id, n_links, and whether it is the first of its component."""
    spark = docs.sparkSession

    # 1. who may link at all
    packs, total = packed(docs)
    parts = buckets_for(total * 27 // 100)  # six bytes a word, of which PART travels in four bytes

    def may_link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                found = _sets_of(texts_of(row))
                sent = [x[(x & np.uint64(255)) < PART] for x in found]
                n = np.array([len(x) for x in found], dtype=np.int64)
                held = np.array([len(x) for x in sent], dtype=np.int64)
                a, b = zip(*map(signature, found), strict=True)
                alone = np.concatenate(([0], np.cumsum(placed(np.concatenate(sent), row.back, parts) == 1)))
                ends = np.cumsum(held)
                may = (n > 0) & (alone[ends] - alone[ends - held] <= lacking(n, share))
                yield pd.DataFrame({"doc_id": longs(row.ids), "n": n, "a": a, "b": b, "may": may, "pack": row.pack, "at": np.arange(len(n))})

    counted = packs.select("pack", "lengths", "texts")
    counted = packs.select("pack", "ids", "lengths", "texts").join(token_counts(counted, parts, lambda row: np.concatenate(_in_part(row))), "pack", "left")
    rows = written(counted.mapInPandas(lean(may_link), "doc_id long, n long, a long, b long, may boolean, pack long, at int"))

    # 2. one document for each set
    first = F.min(F.struct("doc_id", "pack", "at")).alias("first")
    members = F.count("*").alias("weight")
    node = (F.shiftleft("first.pack", AT_BITS) + F.col("first.at")).alias("node")
    classes = written(rows.filter("may").groupBy("n", "a", "b").agg(first, members).select("n", "a", "b", node, "first", "first.pack", "first.at", "weight"))
    chosen = classes.groupBy("pack").agg(F.sort_array(F.collect_list(F.struct("at", "weight"))).alias("chosen"))

    def gather(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                texts, at = texts_of(row), np.array([c["at"] for c in row.chosen], dtype=np.int64)
                found = _sets_of([texts[i] for i in at])
                about = np.stack((at + (row.pack << AT_BITS), [len(x) for x in found], [c["weight"] for c in row.chosen])).astype("<i8")
                yield pd.DataFrame({"pack": [row.pack], "about": [about.tobytes()], "tokens": [np.concatenate(found).tobytes()]})

    sets = packs.select("pack", "lengths", "texts").join(chosen, "pack").mapInPandas(lean(gather), "pack long, about binary, tokens binary")
    sets = bucketed(sets, "pack")

    # 3. the first tokens under every order, of those that another document has, too
    buckets = buckets_for(sets.agg(F.coalesce(F.sum(F.octet_length("tokens")), F.lit(0))).first()[0] // 2)
    ranked = sets.join(token_counts(sets.select("pack", "tokens"), buckets), "pack", "left")

    def mark(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """For each token a byte that has the bit of each order under which it is a first one."""
        for frame in frames:
            for row in frame.itertuples():
                _, held, _ = longs(row.about).reshape(3, -1)
                tokens = np.frombuffer(row.tokens, dtype="<u8")
                counts = placed(tokens, row.back, buckets)
                owner = np.repeat(np.arange(len(held)), held)
                first = lacking(held, share) + 1
                rarity = np.frexp(counts.astype(np.float64))[1] * (counts > 1)
                marks = np.zeros(len(tokens), dtype=np.uint8)
                for k, order in enumerate(ORDERS):
                    by = np.lexsort((mixed(tokens * np.uint64(2 * order + 1)), rarity, owner))
                    place = np.arange(len(by)) - np.repeat(np.cumsum(held) - held, held)
                    marks[by[place < first[owner[by]]]] |= np.uint8(1 << k)
                marks[counts < 2] = 0
                yield pd.DataFrame({"pack": [row.pack], "marks": [marks.tobytes()]})

    marked = sets.join(bucketed(ranked.mapInPandas(lean(mark), "pack long, marks binary"), "pack"), "pack")

    def firsts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """(order, bucket, tokens, owners) of all first tokens."""
        for frame in frames:
            for row in frame.itertuples():
                ids, held, _ = longs(row.about).reshape(3, -1)
                tokens, marks = np.frombuffer(row.tokens, dtype="<u8"), np.frombuffer(row.marks, dtype=np.uint8)
                owner = np.repeat(ids, held)
                for k, order in enumerate(ORDERS):
                    kept = np.flatnonzero(marks >> np.uint8(k) & np.uint8(1))
                    bucket = bucket_of(tokens[kept], buckets)
                    at = np.argsort(bucket, kind="stable")
                    cut = np.searchsorted(bucket[at], np.arange(buckets + 1))
                    for b in np.flatnonzero(np.diff(cut)):
                        some = kept[at[cut[b] : cut[b + 1]]]
                        yield pd.DataFrame({"order": [order], "bucket": [b], "tokens": [tokens[some].tobytes()], "owners": [owner[some].tobytes()]})

    def stars(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each document that has a token with the least document that has it."""
        at, tokens, owners = None, [], []

        def out() -> pd.DataFrame:
            t, o = np.frombuffer(b"".join(tokens), dtype="<u8"), np.frombuffer(b"".join(owners), dtype="<i8")
            by = np.lexsort((o, t))
            t, o = t[by], o[by]
            start = np.concatenate(([True], t[1:] != t[:-1]))
            least = o[np.flatnonzero(start)][np.cumsum(start) - 1]
            pairs = np.unique(np.stack((o, least), 1)[o != least], axis=0)
            return pd.DataFrame({"order": at[0], "u": pairs[:, 0], "v": pairs[:, 1]})

        for frame in frames:
            for order, bucket, t, o in zip(frame["order"], frame["bucket"], frame["tokens"], frame["owners"], strict=True):
                if (order, bucket) != at and tokens:
                    yield out()
                    tokens, owners = [], []
                at = (order, bucket)
                tokens.append(t)
                owners.append(o)
        if tokens:
            yield out()

    edges = written(
        marked.mapInPandas(lean(firsts), "order int, bucket int, tokens binary, owners binary")
        .repartition(len(ORDERS) * buckets, "order", "bucket")
        .sortWithinPartitions("order", "bucket")
        .mapInPandas(lean(stars), "order int, u long, v long")
    )
    together = None
    for order in ORDERS:
        found = components(edges.filter(F.col("order") == order).select("u", "v")).select("node", F.col("component").alias(f"c{order}"))
        together = found if together is None else together.join(found, "node")
    keys = [f"c{order}" for order in ORDERS]
    together = checkpoint(together)

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                ids, held, weight = longs(row.about).reshape(3, -1)
                ends = np.cumsum(held).tolist()
                spans = list(zip([0, *ends], ends, strict=False))
                yield pd.DataFrame({"node": ids, "weight": weight, "shingles": [row.tokens[8 * a : 8 * b] for a, b in spans], "marks": [row.marks[a:b] for a, b in spans]})

    # 4. every two tiles of a block in a place of their own
    blocks = together.join(classes.select("node", "n"), "node").groupBy(*keys).agg(F.count("*").alias("members"), F.sum("n").alias("held")).filter("members > 1")
    tiles = F.greatest(F.ceil(F.col("members") / TILE), F.ceil(F.col("held") / TILE_SHINGLES), F.least(F.ceil(F.col("members") / SMALL_TILE), F.lit(SPREAD)))
    tiled = (
        together.join(blocks.withColumn("tiles", tiles.cast("int")), keys)
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(F.xxhash64(*keys).alias("block"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).alias("guest"), "node")
    )

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (_, i, j), rows in _places(frames):
            yield from _links(rows, i == j, share)

    linked = written(
        tiled.join(marked.mapInPandas(lean(unpack), "node long, weight long, shingles binary, marks binary"), "node")
        .repartition(max(shuffle_width(spark), buckets), "block", "i", "j")
        .sortWithinPartitions("block", "i", "j", "guest", "node")
        .mapInPandas(lean(verify), "u long, v long, n long")
    )
    sums = linked.filter("v is null").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("others"))
    groups_of = components(linked.filter("v is not null").select("u", "v"))
    # a group may hold a third of all classes, so what names it is met in SALTS places
    grouped = classes.select("node", "first").join(groups_of, "node")
    leaders = grouped.groupBy("component").agg(F.min("first").alias("leader")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    led = grouped.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(leaders, ["component", "salt"]).select("node", "leader")
    known = classes.join(led, "node", "left").join(sums, "node", "left")
    known = known.select("n", "a", "b", F.coalesce("leader", "first").alias("leader"), (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    leads = F.col("leader").isNull() | ((F.col("leader.pack") == F.col("pack")) & (F.col("leader.at") == F.col("at")))
    # a null id came as the largest long of all
    named = [F.when(c != F.lit((1 << 63) - 1), c) for c in (F.col("doc_id"), F.coalesce("leader.doc_id", "doc_id"))]
    found = rows.join(known, ["n", "a", "b"], "left").select(
        "pack",
        "at",
        named[0].alias("doc_id"),
        F.col("n").alias("n_shingles"),
        named[1].alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        leads.alias("first"),
    )
    return packs, found


def _places(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """The rows of each (block, i, j) of sorted frames; there are no more than two tiles of them."""
    place, held = None, []
    for frame in frames:
        for where, rows in frame.groupby(["block", "i", "j"], sort=False):
            if where != place and held:
                yield place, pd.concat(held)
                held = []
            place = where
            held.append(rows)
    if held:
        yield place, pd.concat(held)


def _index(tokens: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    by = np.argsort(tokens, kind="stable")
    return tokens[by], owner[by]


def _holders(index: tuple[np.ndarray, np.ndarray], tokens: np.ndarray) -> np.ndarray:
    """The documents of index that have each of tokens, one entry for each."""
    low, high = np.searchsorted(index[0], tokens), np.searchsorted(index[0], tokens, side="right")
    many = high - low
    return index[1][np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())]


def _links(rows: pd.DataFrame, inner: bool, share: int) -> Iterator[pd.DataFrame]:
    """Links between the hosts of a place and its guests, or (inner) among the hosts: (u, null, n), so much weight is linked to u; (u, v, null)."""
    ids, weight, guest = rows["node"].to_numpy(), rows["weight"].to_numpy(), rows["guest"].to_numpy()
    tokens = [np.frombuffer(x, dtype="<u8") for x in rows["shingles"]]
    marks = [np.frombuffer(x, dtype=np.uint8) for x in rows["marks"]]
    hosts = np.flatnonzero(~guest)
    if not len(hosts):
        return
    sizes = np.array([len(tokens[h]) for h in hosts], dtype=np.int64)
    all_tokens, owner = np.concatenate([tokens[h] for h in hosts]), np.repeat(np.arange(len(hosts)), sizes)
    all_marks = np.concatenate([marks[h] for h in hosts])
    whole = _index(all_tokens, owner)
    first = [_index(all_tokens[some], owner[some]) for k in range(len(ORDERS)) for some in [np.flatnonzero(all_marks >> np.uint8(k) & np.uint8(1))]]
    links = np.zeros(len(ids), dtype=np.int64)
    u, v = [], []
    for place, g in enumerate(hosts if inner else np.flatnonzero(guest)):
        # pairs that share a first token, under one order after the other
        may = np.ones(len(hosts), dtype=bool)
        may[place if inner else len(hosts) :] = False
        for k in range(len(ORDERS)):
            seen = np.zeros(len(hosts), dtype=bool)
            seen[_holders(first[k], tokens[g][(marks[g] >> np.uint8(k) & np.uint8(1)) > 0])] = True
            may &= seen
        if not may.any():
            continue
        common = np.bincount(_holders(whole, tokens[g]), minlength=len(hosts))
        hit = hosts[may & (100 * common >= share * (sizes + len(tokens[g]) - common))]
        links[hit] += weight[g]
        links[g] += weight[hit].sum()
        u.append(np.full(len(hit), g))
        v.append(hit)
    if u:
        roots = local_roots(len(ids), np.concatenate(u), np.concatenate(v))
        hung, some = np.flatnonzero(roots != np.arange(len(ids))), np.flatnonzero(links)
        if len(some):
            none = pd.Series([None], dtype="Int64")
            yield pd.DataFrame({"u": ids[some], "v": none.repeat(len(some)).to_numpy(), "n": links[some]})
            yield pd.DataFrame({"u": ids[hung], "v": ids[roots[hung]], "n": none.repeat(len(hung)).to_numpy()})
