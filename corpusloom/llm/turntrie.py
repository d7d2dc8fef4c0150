"""The trie of conversations' turns: every prefix that conversations share, with what sharing it saves.

A turn is its role and text, null ones empty. Turns are told apart by SHA-256 and get a number each in a dictionary; from then on conversations are sequences of
numbers, and texts don't move at all. Conversations that are equal turn by turn are summed up to one sequence first, with the least
conv_id of them, which names it.

Sequences are partitioned from the first turn on (MSD radix): all of them are the root's bucket, and a bucket that is too large for a
task is cut by the next turn into buckets of its own, after the turns that all of it shares, as long as there are large ones. What a
large bucket's rounds find (the nodes of its shared turns, one under the other) is emitted by the recursion. Sequences stay in place
until their bucket is small enough; then each bucket goes to one task, where multikey quicksort sorts it and emits its nodes. Counts of subtrees
are summed in the tasks, and over the large buckets by each one's path, of which there are at most four times the shuffle's width a level.

Turns are in the order of turn, null first, then by their SHA-256. Repeated rows are repeated turns. Rows without a conv_id belong to no conversation. A table without conversations has
no nodes. Other columns aren't read. A round is needed for each level at which large buckets part, however many turns lie between; a
conversation's numbers are one row (12 bytes a turn).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import WORD, checkpoint, shuffle_width, written

#: Sequences that a task sorts in any case. A larger bucket does too if it is at most a quarter of a task's even share.
LOCAL = 256
#: Conversations of one sequence whose ids are put together at once: those with the same conv_id >> ID_BITS.
ID_BITS = 10
#: Every conversation whose conv_id this divides gives its first turns to those that follow it.
FAMILY, HEADS = 20, 4
NO_ENDS = hashlib.sha256(b"").hexdigest()


# ---------------------------------------------------------------- sequences


def sequences_of(conversations: DataFrame) -> DataFrame:
    """Per conversation: conv_id, codes (array<long>, its turns' numbers) and words (array<int>, words of each turn)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = written(
        conversations.filter(F.col("conv_id").isNotNull()).select(
            F.col("conv_id").cast("long").alias("conv_id"),
            "turn",
            F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)).alias("key"),
            F.regexp_count(text, F.lit(WORD)).alias("words"),
        )
    )
    # numbers differ from run to run, so they are written before they are used
    dictionary = written(turns.select("key").distinct().select("key", F.monotonically_increasing_id().alias("code")))
    listed = turns.join(dictionary, "key").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "key", "code", "words"))).alias("turns"))
    return listed.select("conv_id", F.transform("turns", lambda t: t["code"]).alias("codes"), F.transform("turns", lambda t: t["words"]).alias("words"))


def rebuilt(sequences: DataFrame) -> DataFrame:
    """Conversations after the first turns of their family's first one: those of conv_id - conv_id % FAMILY, h = crc32(conv_id) % HEADS of them."""
    own = written(sequences)
    heads = own.filter(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("family"), F.slice("codes", 1, HEADS - 1).alias("head_codes"), F.slice("words", 1, HEADS - 1).alias("head_words")
    )
    many = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    joined = own.withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY).withColumn("h", many).join(heads, "family", "left")

    def put(column: str) -> F.Column:
        none = F.array().cast("array<long>" if column == "codes" else "array<int>")
        return F.concat(F.slice(F.coalesce(f"head_{column}", none), F.lit(1), F.col("h")), F.slice(column, F.col("h") + 1, F.size(column))).alias(column)

    return joined.select("conv_id", put("codes"), put("words"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the lists of ids of each rep, whose parts come one after another."""
    at = found = None
    for batch in batches:
        done = []
        for rep, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if rep != at:
                if found:
                    done.append((at, found.hexdigest()))
                at, found = rep, hashlib.sha256(ids.encode())
            else:
                found.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_pydict({"rep": [r for r, _ in done], "long_ends": [h for _, h in done]})
    if found:
        yield pa.RecordBatch.from_pydict({"rep": [at], "long_ends": [found.hexdigest()]})


def distinct_sequences(conversations: DataFrame) -> DataFrame:
    """Per different sequence: rep (its least conv_id), n (conversations), ends (SHA-256 of their conv_ids), codes, words.

    The ids of a sequence that very many conversations have are put together in lists of 1 << ID_BITS at most, and hashed as a stream of lists."""
    lists = written(
        conversations.groupBy("codes", F.shiftright("conv_id", ID_BITS).alias("block"))
        .agg(F.first("words").alias("words"), F.sort_array(F.collect_list("conv_id")).alias("ids"))
        .select("codes", "words", "block", F.size("ids").cast("long").alias("n"), F.element_at("ids", 1).alias("least"), F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))
    )
    one = lists.groupBy("codes").agg(F.min("least").alias("rep"), F.sum("n").alias("n"), F.first("words").alias("words"), F.count("*").alias("blocks"), F.first("ids").alias("ids"))
    short = written(one.select("rep", "n", F.when(F.col("blocks") == 1, F.sha2("ids", 256)).alias("ends"), "codes", "words"))
    parts = short.filter("ends is null").select("rep", "codes").join(lists.select("codes", "block", "ids"), "codes")
    width = shuffle_width(conversations.sparkSession)
    long_ = parts.select("rep", "ids", "block").repartition(width, "rep").sortWithinPartitions("rep", "block").mapInArrow(_hashed, "rep long, long_ends string")
    return short.join(long_, "rep", "left").select("rep", "n", F.coalesce("ends", "long_ends").alias("ends"), "codes", "words")


# ---------------------------------------------------------------- a bucket in one task

_NODES = pa.schema(
    [("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("up", pa.int64()), ("at", pa.int32())]
)


def bucket_nodes(rows: list[tuple[int, int, str, list[int], list[int]]], shared: int) -> list[list]:
    """The nodes of a bucket by multikey quicksort: [conv_id, depth, parent's place or -1, n_convs, n_children, n_leaves, saved_tokens, ends].

    rows are (rep, n, ends, codes, words) of different sequences, the first ``shared`` codes of which are equal; the node of these is
    the first one, and each node stands after its parent. Depths count from the bucket's first code."""
    out: list[list] = []
    # (rows, codes that they share, the place of the node above, whether these rows are a node)
    stack = [(rows, shared, -1, True)]
    while stack:
        some, depth, above, whole = stack.pop()
        if whole:
            n = sum(r[1] for r in some)
            words = some[0][4][depth - 1] if depth else 0
            ends = next((r[2] for r in some if len(r[3]) == depth), NO_ENDS)
            if above >= 0:
                out[above][4] += 1
            out.append([min(r[0] for r in some), depth, above, n, 0, 0, (n - 1) * words, ends])
            above = len(out) - 1
            some = [r for r in some if len(r[3]) > depth]
        if not some:
            continue
        pivot = some[len(some) // 2][3][depth]
        less, greater = [r for r in some if r[3][depth] < pivot], [r for r in some if r[3][depth] > pivot]
        equal = [r for r in some if r[3][depth] == pivot] if less or greater else some
        stack += [(x, depth, above, False) for x in (less, greater) if x]
        stack.append((equal, depth + 1, above, True))
    for node in reversed(out):
        node[5] = node[5] or 1
        if node[2] >= 0:
            out[node[2]][5] += node[5]
            out[node[2]][6] += node[6]
    return out


def _sorted_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of all buckets of a task; up and at, which say what the bucket hangs on, only for its first node."""
    at, held, out = None, [], []

    def emit() -> None:
        up, base, _ = at
        nodes = bucket_nodes(held, 0 if up is None else 1)
        for k, (conv, depth, above, *figures) in enumerate(nodes):
            parent = nodes[above][0] if above >= 0 else up
            out.append((conv, depth + (base or 0), parent, *figures, up if not k else None, base if not k else None))

    def batch_of() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), _NODES.types, strict=True)], schema=_NODES)
        out.clear()
        return made

    for batch in batches:
        for up, base, digit, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (up, base, digit) != at and held:
                emit()
                held = []
                if len(out) > 50_000:
                    yield batch_of()
            at = up, base, digit
            held.append(row)
    if held:
        emit()
        yield batch_of()


# ---------------------------------------------------------------- the recursion


def _shared(low: F.Column, high: F.Column) -> F.Column:
    """Turns that the first and the last of different sequences, and so all between them, have in common."""
    return (F.array_position(F.zip_with(low, high, lambda a, b: a.eqNullSafe(b)), F.lit(False)) - 1).cast("int")


def _reach() -> list[F.Column]:
    return [F.min("rep").alias("node"), F.sum("n").alias("n"), F.min("codes").alias("low"), F.max("codes").alias("high"), F.min_by("words", "codes").alias("words")]


def trie(sequences: DataFrame, local: int | None = None) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    sequences has rep, n, ends, codes, words, codes once each. ``local``: sequences that a task sorts at once (LOCAL or its share)."""
    spark = sequences.sparkSession
    width = shuffle_width(spark)
    sequences = written(sequences)
    total = sequences.count()
    limit = local or max(LOCAL, total // (4 * width))
    shape = ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'int' if f.type == pa.int32() else 'string'}" for f in _NODES)

    def finished(rows: DataFrame) -> DataFrame:
        keys = ["up", "at", "digit"]
        return rows.select(*keys, "rep", "n", "ends", "codes", "words").repartition(width, *keys).sortWithinPartitions(*keys).mapInArrow(_sorted_buckets, shape)

    final = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    none = F.lit(None).cast("long")
    if total <= limit:
        return finished(sequences.select(none.alias("up"), F.lit(0).alias("at"), none.alias("digit"), "rep", "n", "ends", "codes", "words")).select(*final)

    rest = lambda c: F.slice(c, F.col("shared") + 1, F.size(c)).alias(c)
    # over, over_at: the large bucket above; path: all of them; chain: words of the nodes from this bucket's first (depth top) to where it parts (at)
    level = checkpoint(
        sequences.agg(*_reach()).select(
            none.alias("over"), F.lit(0).alias("over_at"), none.alias("digit"), "node", "n", _shared(F.col("low"), F.col("high")).alias("shared"), F.lit(0).alias("top"),
            F.concat(F.array(F.lit(0)), F.slice("words", F.lit(1), _shared(F.col("low"), F.col("high")))).alias("chain"), F.array().cast("array<struct<node:bigint,at:int>>").alias("path"),
        ).withColumn("at", F.col("shared"))
    )
    # the only row of the first level, known by no key
    root = level.select("node", "shared").first()
    active = sequences.select(F.lit(root["node"]).alias("up"), F.lit(root["shared"]).alias("at"), "rep", "n", "ends", *[F.slice(c, F.lit(root["shared"] + 1), F.greatest(F.size(c), F.lit(1))).alias(c) for c in ("codes", "words")])
    levels, small = [level], []
    while True:
        active = active.withColumn("digit", F.try_element_at("codes", F.lit(1)))
        keys = ["up", "at", "digit"]
        counts = active.filter("digit is not null").groupBy(*keys).agg(F.count("*").alias("k"))
        # each of them is more than limit of all sequences, so they are at most 4 * width
        large = checkpoint(counts.filter(F.col("k") > limit).select(*keys, F.lit(True).alias("large")))
        if large.isEmpty():
            small.append(active)
            break
        tagged = written(active.join(F.broadcast(large), keys, "left"))
        small.append(tagged.filter("large is null").drop("large"))
        deeper = tagged.filter("large").drop("large")
        above = level.select(F.col("node").alias("up"), "at", F.concat("path", F.array(F.struct("node", "at"))).alias("path"))
        level = checkpoint(
            deeper.groupBy(*keys).agg(*_reach()).withColumn("shared", _shared(F.col("low"), F.col("high"))).join(F.broadcast(above), ["up", "at"]).select(
                F.col("up").alias("over"), F.col("at").alias("over_at"), "digit", "node", "n", "shared", (F.col("at") + 1).alias("top"),
                F.slice("words", F.lit(1), F.col("shared")).alias("chain"), "path", (F.col("at") + F.col("shared")).alias("at"),
            )
        )
        levels.append(level)
        reached = level.select(F.col("over").alias("up"), F.col("over_at").alias("at"), "digit", "node", "shared", F.col("at").alias("node_at"))
        active = deeper.join(F.broadcast(reached), keys).select(F.col("node").alias("up"), F.col("node_at").alias("at"), "rep", "n", "ends", rest("codes"), rest("words"))

    rows = reduce(DataFrame.unionByName, small)
    nodes = written(finished(rows.filter("digit is not null")))
    ends = rows.filter("digit is null").select(F.col("up").alias("node"), "at", "ends")
    tops = nodes.filter("up is not null").groupBy(F.col("up").alias("node"), "at").agg(F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.count("*").alias("kids"))
    uppers = reduce(DataFrame.unionByName, levels)
    deeper = uppers.filter("over is not null").groupBy(F.col("over").alias("node"), F.col("over_at").alias("at")).agg(F.count("*").alias("large_kids"))
    own = (F.col("n") - 1) * F.aggregate("chain", F.lit(0).cast("long"), lambda a, w: a + w) + F.coalesce("saved", F.lit(0))
    sums = (
        uppers.join(tops, ["node", "at"], "left")
        .select(F.explode(F.concat("path", F.array(F.struct("node", "at")))).alias("to"), F.coalesce("leaves", F.lit(0)).alias("leaves"), own.alias("saved"))
        .groupBy(F.col("to.node").alias("node"), F.col("to.at").alias("at"))
        .agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    )
    zero = F.lit(0)
    chains = (
        uppers.join(sums, ["node", "at"])
        .join(tops.select("node", "at", "kids"), ["node", "at"], "left")
        .join(deeper, ["node", "at"], "left")
        .join(ends, ["node", "at"], "left")
        .select("*", F.posexplode("chain").alias("i", "w"))
        .withColumn("above", F.coalesce(F.sum("w").over(Window.partitionBy("node", "at").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)), zero))
    )
    last = F.col("i") == F.size("chain") - 1
    upper_nodes = chains.select(
        F.col("node").alias("conv_id"),
        (F.col("top") + F.col("i")).cast("long").alias("depth"),
        F.when(F.col("i") > 0, F.col("node")).otherwise(F.col("over")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(last, F.coalesce("kids", zero) + F.coalesce("large_kids", zero)).otherwise(1).cast("long").alias("n_children"),
        "n_leaves",
        (F.col("saved") - (F.col("n") - 1) * F.col("above")).alias("saved_tokens"),
        F.when(last, F.coalesce("ends", F.lit(NO_ENDS))).otherwise(F.lit(NO_ENDS)).alias("ends_sha256"),
    )
    return nodes.select(*final).unionByName(upper_nodes)


def conversation_trie(conversations: DataFrame, local: int | None = None) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(distinct_sequences(rebuilt(sequences_of(conversations))), local)


#: CRC-32 bit by bit over the decimal digits: a number for each byte is mixed in, and seven zeros shift it out.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
  lambda x, e: xor(xor(x, e) >> 1, 3988292384::BIGINT * (xor(x, e) & 1))), 4294967295::BIGINT)"""

ORACLE = f"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
keyed AS (SELECT *, dense_rank() OVER (ORDER BY role, text) AS code, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words, sha256(strlen(role)::VARCHAR || ':' || role || text) AS mark FROM t),
own AS (SELECT conv_id, list(code ORDER BY turn NULLS FIRST, mark) AS codes, {_CRC} % 4 AS h FROM keyed GROUP BY conv_id),
said AS (SELECT code, any_value(words) AS words FROM keyed GROUP BY code),
full_ AS (SELECT o.conv_id, list_concat(coalesce(p.codes, [])[1:o.h], o.codes[o.h + 1:]) AS codes FROM own o LEFT JOIN own p ON p.conv_id = o.conv_id - o.conv_id % 20),
prefixes AS (SELECT conv_id, codes, unnest(generate_series(0, len(codes))) AS depth FROM full_),
nodes AS (SELECT codes[1:depth] AS p, depth, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (WHERE len(codes) = depth), '') AS ends FROM prefixes GROUP BY 1, 2),
kids AS (SELECT p[1:depth - 1] AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
figures AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children, (n_convs - 1) * coalesce(words, 0) AS own FROM nodes LEFT JOIN kids ON kids.p = nodes.p LEFT JOIN said ON code = nodes.p[depth]),
above AS (SELECT p[1:k] AS p, sum(own) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves FROM (SELECT p, own, n_children, unnest(generate_series(0, depth)) AS k FROM figures) GROUP BY 1)
SELECT f.conv_id, f.depth, o.conv_id AS parent_conv_id, f.n_convs, f.n_children, leaves AS n_leaves, saved::BIGINT AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM figures f JOIN above a ON a.p = f.p LEFT JOIN nodes o ON f.depth > 0 AND o.p = f.p[1:f.depth - 1]"""
