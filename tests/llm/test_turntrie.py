"""The trie of conversations against its definition, with buckets of any size."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import turntrie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def of_definition(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn, role or "", text or ""))
    mark = lambda t: hashlib.sha256(f"{len(t[1].encode())}:{t[1]}{t[2]}".encode()).digest()
    turns = {c: [x[1:] for x in sorted(v, key=lambda t: (t[0] is not None, t[0] or 0, mark(t)))] for c, v in own.items()}
    whole = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        family = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        whole[c] = tuple(turns.get(family, [])[:h] + mine[h:])
    members = defaultdict(list)
    for c, t in whole.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    words = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * words(p)
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if whole[c] == p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, local=None, schema=SCHEMA):
    table = spark.createDataFrame(rows, schema).repartition(3)
    got = turntrie.conversation_trie(table, local)
    assert got.columns == COLUMNS and all(t == ("string" if c == "ends_sha256" else "bigint") for c, t in got.dtypes)
    return sorted((tuple(r) for r in got.collect()), key=str)


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    texts = [None, "", "a", "a b", "ein Wort mehr", "é  日本\x1cx", "long " * 500]
    for c in rng.sample(range(-60, 200), 60):
        for turn in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, rng.choice([turn, turn, turn, None, 2]), rng.choice(["user", "user", None, ""]), rng.choice(texts[: rng.randint(1, 7)])))
    rows += rows[:5] + [(None, 1, "user", "nobody's")]
    # copies of one conversation, and a long one that others share ever more of
    rows += [(c, t, "user", f"turn {t}") for c in range(1000, 1040) for t in range(6)]
    rows += [(c, t, "user", f"trunk {t}" if t < c - 2000 else f"branch {c} {t}") for c in range(2000, 2030) for t in range(c - 2000 + 2)]
    return rows


@pytest.mark.parametrize(("seed", "local"), [(1, None), (2, 1), (3, 4), (4, 25)])
def test_trie_is_its_definition(spark, seed, local):
    rows = random_rows(seed)
    assert found(spark, rows, local) == of_definition(rows)


def test_trie_of_one_common_beginning(spark):
    """All conversations share their first turns, so that the root isn't where they part."""
    rows = [(20 * c, t, "user", "shared" if t < 4 else f"{c % 7} {t}") for c in range(30) for t in range(4 + c % 5)]
    for local in (None, 1, 5):
        assert found(spark, rows, local) == of_definition(rows)


def test_trie_of_few_and_no_conversations(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "x")]) == []
    one = [(5, None, None, None)]
    assert found(spark, one, 1) == of_definition(one)
    wide = [(*r, 1, "x", 2) for r in [(5, 1, "user", "a b"), (6, 1, "user", "a b"), (25, 1, "u", "ser"), (7, 1, "us", "er")]]
    assert found(spark, wide, None, SCHEMA + ", codes int, ends string, up int") == of_definition([r[:4] for r in wide])


def test_ids_of_very_many_equal_conversations(spark):
    """More conversations of one sequence than are put together at once: their ids are hashed as a stream."""
    many = spark.range(-3000, 6000).select((F.col("id") * 20).alias("conv_id"), F.lit(1).alias("turn"), F.lit("user").alias("role"), F.lit("hello there").alias("text"))
    got = {r["depth"]: r for r in turntrie.conversation_trie(many).collect()}
    ids = ",".join(str(20 * i) for i in range(-3000, 6000))
    assert len(got) == 2 and got[1]["ends_sha256"] == hashlib.sha256(ids.encode()).hexdigest()
    assert (got[0]["conv_id"], got[1]["n_convs"], got[0]["saved_tokens"]) == (-60_000, 9000, 2 * 8999)


def test_bucket_nodes_of_a_very_long_conversation():
    """No recursion of Python's, and time in proportion to the turns."""
    codes = list(range(200_000))
    nodes = turntrie.bucket_nodes([(1, 1, "e", codes, [1] * len(codes)), (2, 1, "f", codes[:-1], [1] * (len(codes) - 1))], 1)
    assert len(nodes) == 200_000 and nodes[0][5:7] == [1, 199_999]
