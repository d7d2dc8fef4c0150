"""The training-data operators against brute force, held-out accuracy, or exact round trips; and on odd tables."""

from __future__ import annotations

import hashlib
import random
import time
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.llm import covertree, curriculum, hilbert, jaccard, labelled, langid, mainhtml, orderhash, pieces, repeats, toxicity
from corpusloom.llm.components import components, local_roots
from corpusloom.llm.queries import MODEL, ORACLES, QUERIES
from corpusloom.llm.shingles import shingle_sets

SMALL, DATA = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PHRASE = "the committee met again in the old town hall on a cold morning and nobody spoke for a very long time indeed"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").cache()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names operators use inside."""
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (3, " \t\n", "en", None), (4, PHRASE, "en", "a"), (4, PHRASE, "en", "a"), (5, PHRASE + " so", "en", "b"),
        (6, "x" * 300_000, "de", "b"), (7, "é日本 ☃ \x00 𝔘" * 40, "fr", "c"), (8, "word", "en", "a"), (9, " ".join(["again"] * 2000), "es", "a"), (10, PHRASE.upper(), None, "z"),
    ]
    return spark.createDataFrame([(*r[:2], *r[2:], 7, "p", 1.0) for r in rows], "doc_id long, text string, lang string, source string, pack long, size string, position double")


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# 1 ------------------------------------------------------------------------------------------------


def words_found(pages):
    """Over labelled pages: twice the words found over words found and words to be found, on average."""
    model, shares = mainhtml.fitted(), []
    for page in pages:
        want = Counter(w for b in mainhtml.blocks(page, model.weights) if b.label == "main" for w in b.text.split())
        got = Counter(model.extract(page).split())
        shares.append(2 * (got & want).total() / max(1, got.total() + want.total()))
    return sum(shares) / len(shares)


def test_main_text_of_pages_not_learned_from():
    assert words_found(labelled.pages(150, 99)) > 0.95


def test_main_text_of_layouts_not_seen(monkeypatch):
    """Names of classes, elements and layouts that no labelled page has."""
    layouts = ('<body>{a}<div class="qx-lead"><div {label}>{m}</div></div>{z}</body>', "<body><center>{a}<dl><dd {label}>{m}</dd></dl>{z}</center></body>", "<body>{a}<my-story {label}>{m}</my-story>{z}</body>")
    monkeypatch.setattr(labelled, "LAYOUTS", layouts)
    assert words_found(labelled.pages(90, 5)) > 0.85


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("<script>var a='</p>'</script>", ""),
        ("<nav><a>Home</a></nav><article><h1>A &amp; B</h1><p>one<b>two</b>\n three<br>four<p>five</article><footer>end</footer>", "A & B\nonetwo three four\nfive"),
        ("<article><p>before it</p><div class='ad'>buy " + "now " * 400 + "</div><p>after it</p></article>", "before it\nafter it"),
        ("<article><p>before it.</p><form>Subscribe to our newsletter</form><p>after it.</p><aside>More stories</aside></article>", "before it.\nafter it."),
        ("<article><p>open <i>only", "open only"),
        ("<article><p>one</p><button>go<p>five six seven</p></article>", "one\ngo\nfive six seven"),
        ("<article><p>one</p><button>go</button><svg><text>drawn</text></svg><p>two</p></article>", "one\ntwo"),
        ("<article><p>one <!-- never closed</p><p>two</p></article>", "one\ntwo"),
        ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
        ("<article><p title='a > b'>quoted</p><p title=it's>not quoted</p></article>", "quoted\nnot quoted"),
    ],
)
def test_main_text(html, text):
    assert mainhtml.extract(html) == text


PARTS = ["<a ", "<", '<a =">" ', "<a '", "<button>", "<svg><button>", "<!--", "<!--x>", "<!x", "<script>", "<title>", "</", "</x>", "</p>", "<p>x", "<div>", "&amp;", '<div class="a b">', "<br>", "-->", "x "]


def seconds_of(html):
    times = []
    for _ in range(2):
        began = time.process_time()
        mainhtml.extract(html)
        times.append(time.process_time() - began)
    return min(times)


@pytest.mark.parametrize("part", PARTS)
def test_main_text_of_hostile_pages_takes_linear_time(part):
    """Alone, after half a page of another part, and in turn with it: twice the page takes about twice the time."""
    mainhtml.fitted()
    for other in PARTS:
        pages = [part * (n // len(part)) + other * (n // len(other)) for n in (30_000, 60_000)]
        pages += [(part + other) * (n // len(part + other)) for n in (60_000, 120_000)]
        for small, large in (pages[:2], pages[2:]):
            took = seconds_of(large)
            assert took < 0.3 or took < 3 * seconds_of(small), (part, other, took)
    assert seconds_of(part * (1_000_000 // len(part))) < 15


def test_main_text_of_bare_text():
    assert mainhtml.extract("only a few words\n and &lt; more") == "only a few words and < more"


def test_main_text_of_odd_tables(spark):
    rows = [(1, "u", "<article><p>same text</p></article>", 5, "x"), (1, "u", "<article><p>same text</p></article>", 6, None), (None, None, None, 7, "y"), (2, "v", "<article><p>" + "long " * 200_000 + "</p></article>", 8, "z")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int, text string")
    got = sorted(((r["page_id"] or 0, r["text"][:9], r["n_chars"]) for r in mainhtml.main_text(table).collect()))
    assert got == [(0, "", 0), (1, "same text", 9), (1, "same text", 9), (2, "long long", 999_999)]


def test_main_text_query(spark):
    found = QUERIES["op1_html_main_text"](spark, SMALL).toPandas()
    assert len(found) == spark.read.parquet(f"{SMALL}/pages.parquet").count()
    assert (found["n_chars"] == found["text"].str.len()).all()
    assert mainhtml.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# 2 ------------------------------------------------------------------------------------------------


def test_curve_visits_neighbours():
    index = hilbert.curve_index([a.ravel() for a in np.meshgrid(*[range(8)] * 3, indexing="ij")], 3)
    order = np.argsort(index)
    points = np.stack(np.unravel_index(order, (8, 8, 8)), 1)
    assert sorted(index) == list(range(512))
    assert (np.abs(np.diff(points, axis=0)).sum(1) == 1).all()


def test_shards(spark, docs, odd):
    for table, n in ((docs, docs.count()), (odd, 11)):
        found = hilbert.shards(table).toPandas()
        sizes = found.groupby("shard")["slot"].agg(["count", "min", "max"])
        assert len(found) == n and found["shard"].between(0, 39).all()
        counts = found["shard"].value_counts().reindex(range(40), fill_value=0)
        assert counts.max() - counts.min() <= 1
        assert (sizes["min"] == 0).all() and (sizes["max"] == sizes["count"] - 1).all()
    assert hilbert.shards(empty(spark)).count() == 0
    row = hilbert.shards(odd).filter("doc_id = 1").first()
    assert row["size"] == 16 and row["text_crc32"] is None


def test_written_shards_are_pruned_by_their_columns(spark, docs, tmp_path):
    hilbert.write_shards(docs, str(tmp_path / "shards"), 10)
    back = spark.read.parquet(str(tmp_path / "shards"))
    where = {r["doc_id"]: (r["shard"], r["slot"]) for r in hilbert.shards(docs, 10).collect()}
    assert back.count() == docs.count() and {r["doc_id"]: (r["shard"], r["slot"]) for r in back.collect()} == where
    # rows that are alike lie together: a source stands in few shards, so that most of them need not be read
    spread = [r["n"] for r in back.groupBy("source").agg(F.countDistinct("shard").alias("n")).collect()]
    assert sum(spread) / len(spread) < 4


# 3 ------------------------------------------------------------------------------------------------


def test_mix_is_its_sql(spark, docs):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = con.execute(ORACLES["op3_curriculum_mix"]).df().sort_values("doc_id").reset_index(drop=True)
    got = curriculum.taken(curriculum.mix(docs)).toPandas().sort_values("doc_id").reset_index(drop=True)
    for c in want.columns:
        assert (got[c].fillna(-1) == want[c].fillna(-1)).all(), c


def test_mix(spark, odd):
    mixed = curriculum.mix(odd).toPandas()
    assert (mixed["taken"] <= 3 * mixed["size"]).all()
    assert mixed["size"].sum() == pytest.approx(mixed.groupby(mixed["source"].fillna("?"))["target"].first().sum())
    assert all(list(p) == sorted(p) and all(0 <= x <= 1 for x in p) for p in mixed["positions"])
    rows = curriculum.training_rows(odd)
    assert rows.columns == odd.columns and rows.count() == mixed["copies"].sum()
    assert curriculum.training_rows(empty(spark)).count() == 0
    named = odd.withColumn("_row", F.lit("x")).withColumn("_row_split", F.lit(2))
    assert curriculum.training_rows(named).columns == named.columns and curriculum.training_rows(named).filter("`_row` = 'x'").count() == rows.count()
    assert curriculum.taken(curriculum.mix(empty(spark))).count() == 0


def test_training_rows_of_rows_without_names(spark):
    """Null and repeated doc_ids: each row is taken as often as the mix says, in the order of its times."""
    rows = [(None if i % 3 else 7, f"{'w ' * (i % 5)}t{i}", "ab"[i % 2]) for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3).cache()
    mixed = curriculum.mix(table, keep=["text"]).toPandas()
    want = [t for _, t in sorted((p, t) for t, ps in zip(mixed["text"], mixed["positions"], strict=True) for p in ps)]
    got = [r["text"] for r in curriculum.training_rows(table).collect()]
    assert Counter(want).total() == len(got) and set(Counter(got).values()) <= {1, 2, 3}
    words = {t: len(t.split()) for t in set(got)}
    for source in "ab":
        target = mixed.loc[mixed["source"] == source, "target"].iloc[0]
        assert abs(sum(words[t] for t in got if (int(t.split("t")[-1]) % 2 == 1) == (source == "b")) - target) <= 5


# 4 ------------------------------------------------------------------------------------------------


def test_language(spark, odd):
    table = spark.read.parquet(f"{DATA}/documents.parquet")
    found = langid.predict(table, langid.fit(table)).join(table.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (found["lang"] == found["lang_pred"]).mean() > 0.98
    model = langid.fit(table)
    rows = {r["doc_id"]: r for r in langid.predict(odd, model).collect()}
    assert [rows[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and rows[1]["score"] == 0
    assert 0 < rows[4]["score"] <= 1 and rows[4]["lang_pred"] == "en"
    nothing = langid.fit(empty(spark))
    assert {r["lang_pred"] for r in langid.predict(odd, nothing).collect()} == {"und"}


# 5 ------------------------------------------------------------------------------------------------


def cut(rows, length=50):
    """By brute force: doc_id -> (bytes removed, spans, kept), for distinct doc_ids."""
    first = {}
    for doc_id, text in sorted(rows):
        for s in range(len(text) - length + 1):
            first.setdefault(text[s : s + length], doc_id)
    out = {}
    for doc_id, text in rows:
        gone = bytearray(len(text))
        for s in range(len(text) - length + 1):
            if first[text[s : s + length]] < doc_id:
                gone[s : s + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc_id] = (sum(gone), spans, bytes(b for b, g in zip(text, gone, strict=True) if not g))
    return out


def repeated_rows(n):
    rng = random.Random(n)
    words = ["".join(rng.choices("abcde", k=rng.randint(1, 6))) for _ in range(60)]
    passages = [" ".join(rng.choices(words, k=rng.randint(8, 30))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [" ".join(rng.choices(words, k=rng.randint(0, 40)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            parts += [p[a : rng.randint(a, len(p))], " ".join(rng.choices(words, k=rng.randint(0, 9)))]
        rows.append((i, " ".join(parts)))
    return rows


@pytest.mark.parametrize("together", [20_000, 1])
def test_repeats(spark, monkeypatch, together):
    monkeypatch.setattr(repeats, "TOGETHER", together)
    monkeypatch.setattr(repeats, "SHARD_BYTES", 3000)
    monkeypatch.setattr(repeats, "SLICE_BYTES", 700)
    rows = repeated_rows(150)
    want = cut([(i, t.encode()) for i, t in rows])
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in repeats.repeats(table).collect()}
    assert got == want and sum(v[0] for v in want.values())


def test_repeats_on_odd_rows(spark, odd):
    got = {(r["doc_id"], r["n_bytes"]): r for r in repeats.repeats(odd).collect()}
    assert got[1, 0]["n_removed"] == 0 and bytes(got[2, 0]["kept"]) == b""
    assert got[4, len(PHRASE)]["n_removed"] == 0 and got[5, len(PHRASE) + 3]["n_removed"] == len(PHRASE)
    whole = repeats.without_repeats(odd)
    assert whole.columns == odd.columns and whole.count() == 11
    assert repeats.repeats(empty(spark)).count() == 0
    nameless = spark.createDataFrame([(None, PHRASE), (3, PHRASE)], "doc_id long, text string")
    assert [r["n_removed"] for r in repeats.repeats(nameless).collect()] == [0, 0]


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=300), st.integers(1, 3))
def test_suffix_array(data, alphabet):
    data = np.frombuffer(bytes(b % alphabet for b in data), dtype=np.uint8)
    text = data.tobytes()
    order = repeats.suffix_array(data)
    cut_ = [text[i : i + 50] for i in order]
    assert sorted(order) == list(range(len(text))) and cut_ == sorted(cut_)
    common = repeats.common_prefixes(data, order)
    for k in range(1, len(order)):
        a, b = cut_[k - 1], cut_[k]
        assert common[k] == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


# 6 ------------------------------------------------------------------------------------------------


def test_toxicity(spark, odd):
    words = "blorg snark frimp".split()
    rng = random.Random(4)
    plain = ["".join(rng.choices("aeioulnrst", k=rng.randint(2, 7))) for _ in range(400)]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        rows.append((i, " ".join(rng.choices(plain, k=30) + (rng.choices(words, k=2) if toxic else []))))
        labels.append((i, int(toxic)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(table, known)
    found = toxicity.score(table, model).join(known, "doc_id").filter("held_out").toPandas()
    assert (found["predicted"] == found["toxic"]).all()
    assert model.score("you bl0rg and s n a r k and friiimp") > 0.5 > model.score(" ".join(plain[:30]))
    assert model.restorer.restored("Bl0rg f r i m p snaaaark") == "blorg frimp snark"
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(odd, model).collect()}
    assert scores[1] == scores[2] == scores[3] and 0 <= scores[6] <= 1
    assert toxicity.without_toxic(odd, model).columns == odd.columns
    unlabelled = toxicity.fit(odd, known.limit(0))
    assert {r["predicted"] for r in toxicity.score(odd, unlabelled).collect()} == {0}
    assert toxicity.score(empty(spark), model).count() == 0


def restorer(sentence):
    """A restorer whose model has read one sentence many times."""
    codes = toxicity._coded(f"  {sentence}  ".lower() * 50)
    three = codes[:-2] * toxicity.SIZE**2 + codes[1:-1] * toxicity.SIZE + codes[2:]
    counts = np.bincount(three, minlength=toxicity.SIZE**3).reshape((toxicity.SIZE,) * 3)
    return toxicity.Restorer(toxicity.costs(counts.astype(float)))


def test_disguises_are_seen():
    found = restorer("you are a stupid idiot and a fool or an ass")
    for disguised, word in [
        ("s+upid", "stupid"), ("idio7", "idiot"), ("$ t u p i d", "stupid"), ("i/d/i/o/t", "idiot"), ("i  d  i  o  t", "idiot"), ("i, d, 1, o, 7", "idiot"),
        ("iddiioott", "idiot"), ("stupiid", "stupid"), ("_1d10t_", "_idiot_"), ("y o u   a r e   s t u p i d", "you are stupid"),
    ]:
        assert found.restored(disguised) == word
    # a word, and the same with its letters as signs or with gaps, become one
    for word, ways in [("fool", ["f o o l", "f/o/o/l", "f  o  o  l", "f00l", "fo0l"]), ("ass", ["a$$", "a55", "a s $"])]:
        assert {found.restored(w) for w in ways} == {found.restored(word)}
    for plain in ("stupid!", "an idiot!!!", "1990", "12 34 56", "日本語"):
        assert found.restored(plain) == plain


def test_whole_stretches_are_restored():
    found = restorer("you are a stupid idiot and a fool")
    assert found.restored("i" * 300 + "diot") == found.restored("idio" + "t" * 100_000) == "idiot"
    assert found.restored("1d10t" * 100) == found.restored("idiot" * 99 + "idi0t")
    assert found.restored("   ".join(["s t u p i d"] * 5_000)) == " ".join(["stupid"] * 5_000)
    spaced = found.restored(" ".join("youareastupididiot" * 9))
    assert spaced.count("stupid") == spaced.count("idiot") == 9


def test_only_near_copies_leave_the_sample(spark):
    rng = random.Random(5)

    def words(n):
        return ["".join(rng.choices("abcdefghij", k=6)) for _ in range(n)]

    passage = words(60)  # a third of each text: alike in a fifth of all shingles
    rows = [(i, " ".join(words(60) + passage + words(60)), i % 2) for i in range(80)]
    first = rows[0][1].split()
    rows += [(100 + i, " ".join(first[:-3] + words(3)), 0) for i in range(20)]  # near copies of the first
    rows += [(200, rows[0][1], 1), (201, "", 0), (202, None, 0)]
    chain = words(300)  # each is like the one before, but the first and the last have nothing in common
    rows += [(300 + i, " ".join(chain[i * 25 : i * 25 + 100]), 0) for i in range(9)]
    kept, counts = toxicity._without_copies(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    assert kept == {*range(80), 200, 201, *range(300, 309)}
    assert counts == {0: (40 + 20 + 2 + 9, 40 + 1 + 9), 1: (41, 41)}


# 7 ------------------------------------------------------------------------------------------------


def test_cover_tree(spark, monkeypatch):
    monkeypatch.setattr(covertree, "PART", 120)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(20, 16))
    rows = [(base[rng.integers(20)] + rng.normal(size=16) * rng.choice([0, 0.05, 0.1, 0.2, 0.3])).tolist() for _ in range(900)]
    odd_ones = [None, [0.0] * 16, [float("nan")] * 16, [1.0] * 8, [2.0] * 8, [None] * 16, [float("inf")] * 16, []]
    table = spark.createDataFrame(list(enumerate(rows + odd_ones)), "vec_id long, embedding array<double>")
    got = covertree.near_duplicates(table).toPandas().sort_values("vec_id").reset_index(drop=True)
    x = np.array(rows)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    roots = local_roots(900, *np.nonzero(near))
    assert (got["n_links"][:900] == near.sum(1)).all()
    assert (got["component_id"][:900] == roots).all()
    assert got["n_links"][900:].tolist() == [0, 0, 0, 1, 1, 0, 0, 0]
    assert got["component_id"][900:].tolist() == [900, 901, 902, 903, 903, 905, 906, 907]
    assert covertree.near_duplicates(table.limit(0)).count() == 0


def test_cover_tree_on_odd_rows(spark):
    """Repeated and null vec_ids, and columns whose names the operator uses inside."""
    rows = [(1, [1.0, 0.0], "a", 5), (1, [1.0, 0.0], "b", 6), (2, [1.0, 0.01], "c", 7), (None, [1.0, 0.0], "d", 8), (3, [0.0, 1.0], "e", 9)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id string, n_links int")
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0) for r in covertree.near_duplicates(table).collect())
    assert [g[0] for g in got] == [0, 1, 1, 2, 3] and [g[2] for g in got if g[0]] == [1, 1, 1, 3]
    assert [g[1] for g in got if g[0]] == [2, 2, 2, 0]
    assert covertree.near_duplicates(table).columns == ["vec_id", "n_links", "component_id", "kept"]


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(500 + i, 501 + i) for i in range(40)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    roots = local_roots(600, np.array([e[0] for e in edges]), np.array([e[1] for e in edges]))
    assert got == {i: roots[i] for e in edges for i in e if e[0] != e[1]} | {i: c for i, c in got.items() if roots[i] == c}
    assert all(roots[i] == c for i, c in got.items())


# 8 ------------------------------------------------------------------------------------------------


def near_rows(n):
    rng = random.Random(n)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(800)]
    bases = [rng.choices(words, k=rng.randint(3, 120)) for _ in range(8)]
    passage = rng.choices(words, k=40)
    rows = []
    for i in range(n):
        t = list(rng.choice(bases)) if rng.random() < 0.6 else rng.choices(words, k=rng.randint(0, 60)) + passage
        for _ in range(rng.randint(0, max(1, len(t) // 25))):
            if t:
                t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((i, " ".join(t)))
    return rows


def links(rows):
    sets = []
    for _, text in rows:
        w = (text or "").lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    a, b = [], []
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                a.append(i)
                b.append(j)
    roots = local_roots(len(rows), np.array(a, dtype=int), np.array(b, dtype=int))
    linked = Counter(a + b)
    return {rows[i][0]: (len(sets[i]), rows[roots[i]][0], linked[i]) for i in range(len(rows))}


@pytest.mark.parametrize("tile", [1500, 20])
def test_jaccard(spark, monkeypatch, tile):
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "SMALL_TILE", tile)
    rows = near_rows(220)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in jaccard.linked_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    want = links(rows)
    assert got == want and len({v[1] for v in want.values()}) < 200 and max(v[2] for v in want.values()) > 9


def test_jaccard_on_odd_rows(spark, odd):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in jaccard.linked_components(odd).collect()}
    n = len(PHRASE.split()) - 4
    assert [got[i] for i in (1, 2, 3)] == [(0, 1, 0), (0, 2, 0), (0, 3, 0)]
    assert got[4] == (n, 4, 3) and got[5] == (n + 1, 4, 3) and got[10] == (n, 4, 3) and got[9] == (1, 9, 0)
    assert jaccard.linked_components(odd).count() == 11
    kept = jaccard.first_of_each(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4, 6, 7, 8, 9]
    assert kept.filter("doc_id = 1 and text is null and position = 1.0 and pack = 7").count() == 1
    assert jaccard.linked_components(empty(spark)).count() == 0 and jaccard.first_of_each(empty(spark)).count() == 0


def test_jaccard_of_rows_without_names(spark):
    n = len(PHRASE.split()) - 4
    nameless = spark.createDataFrame([(None, PHRASE), (None, PHRASE.upper()), (None, "other")], "doc_id long, text string")
    assert sorted(tuple(r)[1:] for r in jaccard.linked_components(nameless).collect()) == [(1, None, 0), (n, None, 1), (n, None, 1)]
    assert jaccard.first_of_each(nameless).count() == 2
    # of one doc_id with two texts only the near copy goes
    mixed = spark.createDataFrame([(1, PHRASE), (2, PHRASE + " so"), (2, "something else"), (None, PHRASE)], "doc_id long, text string")
    assert sorted(r["text"] for r in jaccard.first_of_each(mixed).collect()) == sorted([PHRASE, "something else"])
    assert {(r["doc_id"], r["component_id"]) for r in jaccard.linked_components(mixed).collect()} == {(1, 1), (2, 1), (2, 2), (None, 1)}


def test_shingles():
    a, b, c = shingle_sets(["A b c d e f", "a  B\tc\nd e F", "a b c"])
    assert (a == b).all() and len(a) == 2 and len(c) == 1
    assert not set(c.tolist()) & set(shingle_sets(["a b c d"])[0].tolist())


# 9 ------------------------------------------------------------------------------------------------


def test_order_minhash(spark, docs, odd):
    rows = docs.toPandas().sort_values("doc_id", ascending=False).reset_index(drop=True)
    texts = rows["text"].tolist()
    other = [orderhash.edited(t, texts[(i + 1) % len(texts)]) for i, t in enumerate(texts)]
    got = orderhash.against_neighbours(docs).toPandas().sort_values("doc_id", ascending=False).reset_index(drop=True)
    assert (got["doc_id"] == rows["doc_id"]).all()
    assert got["edited_sha256"].tolist() == [hashlib.sha256(t.encode()).hexdigest() for t in other]
    assert got["fingerprint"].tolist() == [orderhash.fingerprint(t).tobytes().hex() for t in texts]
    assert (got["near_edited"] > got["near_next"]).mean() > 0.95
    same = orderhash.against_neighbours(odd).filter("doc_id = 4").toPandas()
    assert same["fingerprint"].nunique() == 1 and same["near_next"].max() == 1.0
    assert orderhash.against_neighbours(empty(spark)).count() == 0
    one = orderhash.against_neighbours(odd.filter("doc_id = 8")).first()
    assert one["near_next"] == 1.0 and one["n_chars"] == 4


def by_hand(text):
    """A fingerprint place by place, from k-mers and their numbers."""
    hashes = [int(h) for h in orderhash.numbered_kmers(text)]
    out = []
    for added, factor in zip(orderhash._ADDED.ravel().tolist(), orderhash._FACTORS.ravel().tolist(), strict=True):

        def place(h, added=added, factor=factor):
            x = ((h >> 32) + added) * factor & 0xFFFFFFFF
            return (x ^ x >> 15) * int(orderhash._LAST) & 0xFFFFFFFF

        rank = sorted(range(len(hashes)), key=lambda i: (place(hashes[i]), i))
        chosen = sorted(rank[: orderhash.TUPLE])
        value = np.array([min(orderhash.TUPLE, len(hashes))], dtype=np.uint64)
        for i in chosen:
            value = orderhash._mixed(value, np.array([hashes[i]], dtype=np.uint64))
        out.append(int(value[0]) >> 48)
    return out


@pytest.mark.parametrize("text", ["", "a", "short", "the same words the same words the same words", "x" * 200, "".join(chr(97 + i * i % 23) for i in range(700))])
def test_fingerprints_are_their_definition(text):
    assert orderhash.fingerprint(text).tolist() == by_hand(text)


def test_kmers_are_numbered_by_occurrence():
    text = "abcabcabcabcabcabcabc" * 2 + "zzz"
    found, names, seen = orderhash.numbered_kmers(text).tolist(), [], Counter()
    for i in range(max(1, len(text) - orderhash.K + 1)):
        names.append((text[i : i + orderhash.K], seen[text[i : i + orderhash.K]]))
        seen[text[i : i + orderhash.K]] += 1
    assert len(found) == len(names) and len(set(found)) == len(set(names)) and len(dict(zip(names, found, strict=True))) == len(names)


def test_order_minhash_sees_order():
    a, b = "abcdefghijklmnopqrstuvwxyz0123456789" * 4, "ZYXWVUTSRQPONMLKJIHGFEDCBA9876543210" * 4
    same, swapped = orderhash.likeness(orderhash.fingerprint(a + b), orderhash.fingerprint(a + b)), orderhash.likeness(orderhash.fingerprint(a + b), orderhash.fingerprint(b + a))
    assert same == 1.0 and swapped < 0.8
    k = orderhash.numbered_kmers("abab" * 10)
    assert len(set(k.tolist())) == len(k)


# 10 -----------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet=" ▁abethino'\n\tÉß日 ﻿𝔘<>0x1.,", max_size=60)))
def test_pieces_are_the_librarys(library, text):
    text = text.encode("utf-8", "ignore").decode()
    coder = pieces.pieces(MODEL)
    ids, want = coder.encode(text), library.encode(text)
    assert np.frombuffer(ids, dtype="<i4").tolist() == want
    assert coder.decode(ids) == library.decode(want)


@pytest.mark.parametrize("after", ["", "a", "the", "日", "'", "\n"])
def test_runs_of_blanks(library, after):
    for n in range(70):
        text = "q" + " " * n + after
        assert np.frombuffer(pieces.pieces(MODEL).encode(text), dtype="<i4").tolist() == library.encode(text)


def test_what_is_remembered_is_bounded(library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 5)
    monkeypatch.setattr(pieces, "PAIRS", 5)
    coder = pieces.Pieces(MODEL)
    for text in ("one two three four five six seven eight nine ten one two", "three eleven twelve one"):
        assert np.frombuffer(coder.encode(text), dtype="<i4").tolist() == library.encode(text)
        assert len(coder.known) <= 5 and len(coder.before) <= 5 and len(coder.fits) <= 5
    coder.forget()
    assert not coder.known and not coder.before and not coder.fits


def test_pieces_of_tables(spark, library, odd):
    for row in pieces.encode(odd, MODEL).collect():
        assert row["ids"] is not None
    got = {r["doc_id"]: r for r in pieces.digests(pieces.encode(odd, MODEL)).collect()}
    text = "x" * 300_000
    ids = library.encode(text)
    assert got[6]["n_tokens"] == len(ids) and got[6]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert got[1]["n_tokens"] == 0 and got[1]["ids_sha256"] == hashlib.sha256(b"").hexdigest() == got[1]["decoded_sha256"]
    assert pieces.digests(pieces.encode(empty(spark), MODEL)).count() == 0


# all ----------------------------------------------------------------------------------------------


def test_each_operator_has_its_query():
    assert Counter(int(n[2:].split("_")[0]) for n in QUERIES) == Counter(range(1, 14))


@pytest.mark.parametrize("name", ["op2_hilbert_shards", "op4_nearest_centroid_language", "op5_suffix_array_dedup", "op6_toxicity", "op8_ngram_jaccard_join", "op9_order_minhash", "op10_sentencepiece"])
def test_queries_give_a_row_a_document(spark, docs, name):
    found = QUERIES[name](spark, SMALL)
    assert sorted(r["doc_id"] for r in found.select("doc_id").collect()) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())


@pytest.mark.parametrize("name", ["op5_suffix_array_dedup", "op7_cover_tree_duplicates", "op8_ngram_jaccard_join"])
def test_queries_are_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want, got = con.execute(ORACLES[name]).df(), QUERIES[name](spark, SMALL).toPandas()
    key = want.columns[0]
    want, got = want.sort_values(key).reset_index(drop=True), got.sort_values(key).reset_index(drop=True)
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    for c in want.columns:
        assert (got[c] == want[c]).all(), c


def test_pipeline(spark, docs):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "suffix_array_dedup", "curriculum_mix", "sentencepiece"]
    found = corpus_pipeline.run(spark, SMALL).toPandas()
    per_doc = defaultdict(set)
    for r in found.itertuples():
        per_doc[r.doc_id].add(r.ids_sha256)
    assert len(found) and all(len(v) == 1 for v in per_doc.values())
    assert found["doc_id"].value_counts().max() <= 3
    component = {r["doc_id"]: r["component_id"] for r in jaccard.linked_components(docs).collect()}
    kept = [component[i] for i in per_doc]
    assert len(kept) == len(set(kept))


def test_pipeline_on_odd_and_empty_tables(spark, odd, tmp_path):
    import corpus_pipeline

    for name, table in (("odd", odd.select("doc_id", "text", "lang", "source", F.lit(1).alias("n_chars"))), ("empty", empty(spark))):
        table.write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.createDataFrame([(4, 0, 0), (8, 0, 1), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / name / "labels.parquet"))
        rows = corpus_pipeline.run(spark, str(tmp_path / name)).collect()
        assert (len(rows) > 0) == (name == "odd")
        assert all(len(r["ids"]) == r["n_tokens"] for r in rows)


def test_tables_are_dropped(spark, docs):
    from corpusloom.llm import common

    name = jaccard.linked_components(docs.limit(20)) and common._TABLES[-1]
    assert spark.catalog.tableExists(name) and common.drop_tables(spark) > 0 and not spark.catalog.tableExists(name)


def test_rows_without_words(spark):
    table = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string").withColumn("source", F.lit("a"))
    assert [r["taken"] for r in curriculum.mix(table).collect()] == [0, 0]


def test_learning_from_few_and_repeated_rows(spark):
    """More partitions than rows, one doc_id on very many rows, null doc_ids: whatever is left is learned from."""
    few = spark.createDataFrame([(1, "a fool of a man", "en"), (3, "ein guter Tag", "de"), (4, "x", None)], "doc_id long, text string, lang string").repartition(9)
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, 0), (None, 1), (77, 1)], "doc_id long, toxic int").repartition(9)
    model = toxicity.fit(few, labels)
    assert model.rows == {0: (1, 1), 1: (1, 1)} and toxicity.score(few, model).count() == 3
    assert {r["lang_pred"] for r in langid.predict(few, langid.fit(few)).filter("doc_id <> 4").collect()} == {"en", "de"}
    same = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("the same text "), (F.col("id") % 2).cast("string")).alias("text"), F.lit("en").alias("lang"))
    assert len(langid.fit(same).langs) in (1, 2)
    assert toxicity.fit(same, labels).rows == {0: (0, 0), 1: (1, 1)}
    nameless = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text number "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    model = langid.fit(nameless)
    assert set(model.langs) == {"en"} and langid.predict(nameless, model).filter("lang_pred = 'en' and not held_out").count() == 3000


def test_nearest_centroid_is_brute_force(spark, docs):
    model = langid.fit(docs)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs, model).collect()}
    for r in docs.select("doc_id", "text").toPandas().itertuples():
        if not r.text or not any(c.isalpha() for c in r.text):
            assert got[r.doc_id] == ("und", 0.0)
            continue
        count = Counter()
        data = f" {r.text.lower()} ".encode()
        data = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in data)
        for i in range(len(data) - 2):
            if (gram := data[i : i + 3]) != b"   ":
                count[((gram[0] << 16 | gram[1] << 8 | gram[2]) * 2654435761 & 0xFFFFFFFF) >> 20] += 1
        x = np.zeros(langid.BINS)
        for k, n in count.items():
            x[k] = np.log1p(n) * model.idf[k]
        cos = model.centroids @ (x / np.linalg.norm(x))
        assert got[r.doc_id][0] == model.langs[int(cos.argmax())] and abs(got[r.doc_id][1] - cos.max()) < 1e-5


def every_path(found, stretch):
    """The likeliest word by brute force: every way through the channel, each written out."""
    parts = toxicity._PARTS.findall(stretch)
    last = next((i for i in range(len(parts) - 1, -1, -1) if parts[i] not in toxicity.SIGNS and parts[i][0] not in toxicity.GAPS), len(parts))
    widths = Counter(len(p) for p in parts if p[0] in toxicity.GAPS)
    usual = min(widths, key=lambda n: (-widths[n], n), default=0)
    code, cost = toxicity._CODE, found.cost
    best = []

    def walk(i, a, b, total, out):
        if i == len(parts):
            best.append((total + (cost[a][b][0] if b else 0.0), out))
            return
        part = parts[i]
        if part[0] in toxicity.GAPS:
            drop, keep = (toxicity.KEEP_GAP, toxicity.DROP_GAP) if len(part) > usual else (toxicity.DROP_GAP, toxicity.KEEP_GAP)
            walk(i + 1, a, b, total + drop, out)
            walk(i + 1, b, 0, total + keep + cost[a][b][0], out + " ")
            return
        paid = toxicity.SIGN_COST if part in toxicity.SIGNS else 0.0
        letters = toxicity.SIGNS.get(part, part)
        for letter in letters:
            walk(i + 1, b, code[letter], total + paid + cost[a][b][code[letter]], out + letter)
        if b and any(code[x] == b for x in letters):
            walk(i + 1, a, b, total + paid + toxicity.DROP_REPEAT, out)
        if part in toxicity.SIGNS and i > last:
            if b:
                walk(i + 1, b, 0, total + toxicity.KEEP_SIGN + cost[a][b][0], out + part)
            else:
                walk(i + 1, a, b, total + (part != "!") * toxicity.KEEP_SIGN, out + part)

    walk(0, 0, 0, 0.0, "")
    return best


@pytest.mark.parametrize("stretch", ["1d10t", "s+up1d!", "f o o l", "f/o/o/l", "iddiioo", "a$$!!", "i  d  1 o", "foo1", "$$+u"])
def test_viterbi_is_the_best_of_all_paths(stretch):
    found = restorer("you are a stupid idiot and a fool or an ass")
    ways = every_path(found, stretch)
    least = min(total for total, _ in ways)
    got = min((total for total, out in ways if out == found.viterbi(stretch)), default=None)
    assert got == pytest.approx(least, abs=1e-4)


def test_toxic_documents_of_every_language_are_found(spark):
    """Held out: nine of ten toxic documents in each language, and hardly a clean one."""
    large = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{large}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    marked = docs.join(labels.select("doc_id", "toxic"), "doc_id").select("doc_id", "text", "lang", "toxic")
    found = toxicity.score(marked, model).filter("held_out").join(marked.select("doc_id", "lang", "toxic"), "doc_id").toPandas()
    toxic = found[found["toxic"] == 1].groupby("lang")["predicted"].agg(["mean", "size"])
    assert (toxic["mean"] >= 0.9).all() and toxic["size"].sum() > 100, toxic
    assert found[found["toxic"] == 0]["predicted"].mean() < 0.01


def test_score_is_the_sum_of_weights(spark, docs):
    """By hand: of each different restored word the best of its features' weights, through the logistic function."""
    model = toxicity.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    model.weights = model.weights | {"stupid": 2.0, "stup*": 1.0, "idio*": 1.5, "idiot": 0.5}
    got = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame([(1, "stupid, a STUPID and an idiot"), (2, None), (3, "nothing")], "doc_id long, text string"), model).collect()}
    of = lambda w: 1 / (1 + np.exp(-model.bias - model.slope * w))
    rest = sum(max(model.weights.get(f, 0.0) for f in [w, w[:4] + "*", w[:5] + "*", w[:6] + "*"]) for w in ("a", "and", "an", "nothing"))
    assert rest == 0 and got == pytest.approx({1: of(3.5), 2: of(0), 3: of(0)})
