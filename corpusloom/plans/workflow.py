"""Queries of the steps around the detectors, each with its twin in DuckDB's SQL beside it.

Ledgers, corrections and bundles are written to the shared folder and read again, so that a query shows what a reader makes of
what a writer wrote. Pairs stand in for units, as in the catalog.
"""

from __future__ import annotations

import base64
import gzip
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions import detectors as D
from corpusloom.functions import text as T
from corpusloom.functions.books import copied_heading
from corpusloom.operators import admission, division, gates, ledger, pages, selection
from corpusloom.operators import page_sets as page_sets_
from corpusloom.operators.lineage import shared_folder
from corpusloom.plans import oracle as O
from corpusloom.plans.catalog import _table, pairs
from corpusloom.sources import published, readers, writers
from corpusloom.streaming import units as units_

S, TT = O.S, O.T


def _place(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs as units of an alignment, with the fields of its ledgers."""
    rows = pairs(spark, sf_dir)
    return rows.select("rank", F.col("ordinal").cast("int").alias("ordinal"), F.lit(1).alias("chapter"), T.unit_id(F.lit(1), F.col("ordinal")).alias("unit_id"), "kind", "source", "translation")


UNIT_ID = "'c01-u' || lpad(ordinal::VARCHAR, greatest(4, length(ordinal::VARCHAR))::INT, '0')"


# ---------------------------------------------------------------- selection


def repair_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, forms = D.prepared(pairs(spark, sf_dir))
    flags = selection.repair_flags(F.col("source"), F.col("translation"), F.col("kind"), "ru", forms)
    return rows.select("rank", "ordinal", F.array_join(flags, ",").alias("flags"))


REPAIR_FLAGS = O.pairs(
    "rank, ordinal, "
    + O.named(
        ("empty", O.empty(TT)),
        ("length_or_repetition", f"coalesce(kind, 'paragraph') <> 'heading' AND ({O.omission(S, TT)} OR {O.repetition(S, TT)})"),
        ("source_script_spillover", f"regexp_matches({O.known(TT)}, '[\\x{{0400}}-\\x{{052f}}]')"),
    )
    + " AS flags"
)


def candidate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.with_candidate_reasons(pairs(spark, sf_dir), "en").select("rank", "ordinal", F.array_join("reasons", ",").alias("reasons"))


def repeats(side: str, name: str) -> str:
    """CTEs that end in ``name`` (rank, ordinal, size, count, score, phrase): the best block of tokens said again at once."""
    return f"""{name}_t AS (SELECT rank, ordinal, {O.tokens(O.known(side))} AS t FROM bound
), {name}_k AS (SELECT *, unnest(generate_series(1, least(32, len(t) // 2))) AS size FROM {name}_t
), {name}_p AS (SELECT *, unnest(generate_series(size + 1, len(t))) AS i FROM {name}_k
), {name}_e AS (SELECT *, i - row_number() OVER (PARTITION BY rank, ordinal, size ORDER BY i) AS g FROM {name}_p WHERE t[i] = t[i - size]
), {name}_r AS (SELECT rank, ordinal, size, any_value(t) AS t, min(i) - size AS start, count(*) // size + 1 AS count FROM {name}_e GROUP BY rank, ordinal, size, g
), {name}_b AS (SELECT *, size * count AS score, row_number() OVER (PARTITION BY rank, ordinal ORDER BY size * count DESC, size DESC, count DESC, start) AS n FROM {name}_r WHERE count >= CASE WHEN size = 1 THEN 3 ELSE 2 END
), {name} AS (SELECT rank, ordinal, size, count, score, array_to_string(t[start:start + size - 1], ' ') AS phrase FROM {name}_b WHERE n = 1)"""


REPEATED_ADJACENT = f"WITH {O.PAIRS}, {repeats(TT, 'r')} SELECT b.rank, b.ordinal, coalesce(r.size, 0)::INT AS size, coalesce(r.count, 0)::INT AS count, coalesce(r.score, 0)::INT AS score, r.phrase FROM bound b LEFT JOIN r ON b.rank = r.rank AND b.ordinal = r.ordinal"


def chain(text: str, letters: str, seps: str, least: int, most: int, times: int) -> str:
    """Whether a word stands ``times`` times in a row, with nothing but seps between."""
    chains = f"regexp_extract_all(lower({text}), '(?:^|[^\\p{{L}}\\p{{N}}_])({letters}+(?:{seps}+{letters}+)+)', 1)"
    words = f"list_transform({chains}, lambda c: regexp_extract_all(c, '{letters}+'))"
    again = f"len(list_filter(generate_series(1, len(w) - {times - 1}), lambda i: length(w[i]) BETWEEN {least} AND {most} AND w[i] = w[i + 1] AND len(list_distinct(w[i:i + {times - 1}])) = 1)) > 0"
    return f"(len(list_filter({words}, lambda w: {again})) > 0)"


def word_five_times(text: str) -> str:
    return chain(text, "[a-zà-ÿ]", "[\\s,.;:!?—-]", 3, 1000, 5)


def decoder_loop(text: str) -> str:
    """One sign six times over, a part of a word four times, or a word four times: without back-references, by runs."""
    sign = f"len(list_filter(regexp_extract_all({text}, '[^\\p{{L}}\\p{{N}}_\\s]{{6,}}'), lambda r: len(list_filter(generate_series(1, length(r) - 5), lambda i: substring(r, i, 6) = repeat(substring(r, i, 1), 6))) > 0)) > 0"
    part = f"len(list_filter(regexp_extract_all(lower({text}), '[a-zà-öø-ÿ]{{8,}}'), lambda r: len(list_filter(generate_series(2, least(15, length(r) // 4)), lambda k: len(list_filter(generate_series(1, length(r) - 4 * k + 1), lambda i: substring(r, i, 4 * k) = repeat(substring(r, i, k), 4))) > 0)) > 0)) > 0"
    return f"({sign} OR {part} OR {chain(text, '[a-zà-öø-ÿ]', '[.\\s_-]', 2, 25, 4)})"


def source_copy(s: str, t: str, language: str) -> str:
    known = f"[{', '.join(map(O.q, D.function_words(language)))}]"
    own = f"list_transform(list_filter(generate_series(1, len({s}) - k + 1), lambda i: len(list_filter(({s})[i:i + k - 1], lambda w: list_contains({known}, w))) >= 2), lambda i: array_to_string(({s})[i:i + k - 1], ' '))"
    other = f"list_transform(generate_series(1, len({t}) - k + 1), lambda i: array_to_string(({t})[i:i + k - 1], ' '))"
    return f"(len(list_filter(generate_series(5, least(18, len({s}), len({t}))), lambda k: list_has_any({own}, {other}))) > 0)"


def token_length_anomaly(s: str, t: str) -> str:
    return f"(len({s}) >= 8 AND (len({t})::DOUBLE / greatest(1, len({s})) > 2.5::DOUBLE OR len({t})::DOUBLE / greatest(1, len({s})) < 0.35::DOUBLE))"


MODERN_ONLY = f"regexp_matches({O.known(TT)}, {O.q(O.MODERN)}) AND NOT regexp_matches({O.known(S)}, {O.q(O.MODERN)})"
POST_FAILURES = f"WITH {O.PAIRS}, k AS (SELECT *, {O.tokens(O.known(S))} AS s, {O.tokens(O.known(TT))} AS t FROM bound) SELECT rank, ordinal, " + O.named(
    ("empty_target", O.empty(TT)),
    ("decoder_loop", decoder_loop(O.known(TT))),
    ("source_language_residue", O.residue(O.known(TT), "t", "en")),
    ("exact_duplicate_half", O.duplicate_half("s", "t")),
    ("severe_length_anomaly", token_length_anomaly("s", "t")),
    ("modern_intrusion", MODERN_ONLY),
) + " AS failures FROM k"
CANDIDATE_REASONS = f"WITH {O.PAIRS}, {repeats(TT, 'rt')}, {repeats(S, 'rs')}, k AS (SELECT b.*, {O.tokens(O.known(S))} AS s, {O.tokens(O.known(TT))} AS t, rt.size AS t_size, rt.count AS t_count, rt.score AS t_score, coalesce(rs.count, 1) AS s_count, coalesce(rs.score, 0) AS s_score FROM bound b LEFT JOIN rt ON b.rank = rt.rank AND b.ordinal = rt.ordinal LEFT JOIN rs ON b.rank = rs.rank AND b.ordinal = rs.ordinal) SELECT rank, ordinal, " + O.named(
    ("missing_translation", O.empty(TT)),
    ("decoder_loop", decoder_loop(O.known(TT))),
    ("source_language_residue", O.residue(O.known(TT), "t", "en")),
    ("exact_duplicate_half", O.duplicate_half("s", "t")),
    ("strong_source_unmatched_repetition", "t_count IS NOT NULL AND (t_count > s_count OR t_score >= s_score + 4) AND (t_count >= 3 OR t_size >= 4)"),
    ("source_language_copy", source_copy("s", "t", "en")),
    ("severe_length_anomaly", token_length_anomaly("s", "t")),
    ("modern_intrusion", MODERN_ONLY),
) + " AS reasons FROM k"


# ---------------------------------------------------------------- forms of texts


def composed_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.col("text")
    return _table(spark, sf_dir, "documents").select("doc_id", T.sha(T.composed(x)).alias("composed"), T.sha(T.bare(x)).alias("bare"), T.n_words(x).cast("long").alias("words"))


COMPOSED = "trim(regexp_replace(translate(coalesce(text, ''), '’‘“”', '''''\"\"'), '[\\s\\x{00a0}]+', ' ', 'g'))"
COMPOSED_FORMS = f"SELECT doc_id, sha256({COMPOSED}) AS composed, sha256(replace(strip_accents(lower(text)), 'ß', 'ss')) AS bare, len({O.tokens(COMPOSED)}) AS words FROM documents"


def text_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of parts as slugs, paths, markup and spaced text; signs made of their keys as roman numerals."""
    name = F.concat(F.col("p_name"), F.lit(" & <Co.>Ltd?Yes  "), F.col("p_brand"))
    kind = F.element_at(F.array(F.lit("heading"), F.lit("continuation"), F.lit("paragraph")), (F.col("p_partkey") % 3 + 1).cast("int"))
    signs = F.translate(F.col("p_partkey").cast("string"), "0123456789", "ivxlcdmivx")
    return _table(spark, sf_dir, "part").select(
        "p_partkey", T.slug(name).alias("slug"), T.quoted(name).alias("path"), T.paragraph_html(kind, name).alias("xhtml"), T.spaced(name).alias("spaced"), T.roman_value(signs).cast("long").alias("roman")
    )


_NAME = "(p_name || ' & <Co.>Ltd?Yes  ' || p_brand)"
_ESCAPED = f"replace(replace(replace(replace(replace({_NAME}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), chr(39), '&#x27;')"
_SIGNS = "list_transform(string_split(reverse(translate(p_partkey::VARCHAR, '0123456789', 'ivxlcdmivx')), ''), lambda c: CASE c WHEN 'i' THEN 1 WHEN 'v' THEN 5 WHEN 'x' THEN 10 WHEN 'l' THEN 50 WHEN 'c' THEN 100 WHEN 'd' THEN 500 ELSE 1000 END)"
TEXT_FORMS = f"""SELECT p_partkey, regexp_replace(regexp_replace({O.fold(_NAME)}, '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug, replace(url_encode({_NAME}), '%2F', '/') AS path,
  CASE p_partkey % 3 WHEN 0 THEN '<p class="subhead">' WHEN 1 THEN '<p class="continued">' ELSE '<p>' END || {_ESCAPED} || '</p>' AS xhtml,
  regexp_replace(regexp_replace({O.stripped(_NAME)}, '([.!?…»”"])([A-ZÀ-ÖØ-Þ])', '\\1 \\2', 'g'), '[ \\t]+', ' ', 'g') AS spaced, {O.roman_of(_SIGNS)} AS roman FROM part"""


# ---------------------------------------------------------------- what is written, and read again


def alignment_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledgers by rank as files named by it, read with their ranks."""
    place = _place(spark, "ledgers")
    writers.write_alignment_files(_units(spark, sf_dir), place)
    return readers.alignments(spark, place).select("rank", "unit_id", "kind", "source_sha256", "translation_sha256")


ALIGNMENT_ROUNDTRIP = O.pairs(f"rank::INT AS rank, {UNIT_ID} AS unit_id, kind, sha256(source) AS source_sha256, sha256(translation) AS translation_sha256")


def bundle_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = _place(spark, "bundles")
    writers.write_bundle_files(_units(spark, sf_dir), place)
    found = readers.source_bundle(spark, place)
    return found.select("rank", F.col("ordinal").cast("long").alias("place"), "unit_id", "chapter", "kind", T.sha(F.col("source")).alias("source_sha256"))


BUNDLE_ROUNDTRIP = O.pairs(f"rank::INT AS rank, row_number() OVER (PARTITION BY rank ORDER BY ordinal) - 1 AS place, {UNIT_ID} AS unit_id, 1 AS chapter, kind, sha256(source) AS source_sha256")


def packed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as gzipped JSON in base64, and what the reader finds in it."""

    @F.pandas_udf("string")
    def packed(documents: pd.Series) -> pd.Series:
        return documents.map(lambda d: base64.b64encode(gzip.compress(d.encode("utf-8"))).decode("ascii"))

    place = _place(spark, "packed")
    items = _table(spark, sf_dir, "benchmark").select(packed(F.to_json(F.struct("item_id", "text"))).alias("value"))
    # the format has one document a file, so each row is one
    published.publish(items.withColumn("name", F.concat(F.sha1("value"), F.lit(".txt"))), place, "name", "value", [])
    found = readers.gzipped_base64_json(spark, published.folders_of(place), "item_id LONG, text STRING")
    return found.select("document.item_id", T.sha(F.col("document.text")).alias("text_sha256"))


PACKED_JSON = "SELECT item_id::BIGINT AS item_id, sha256(text) AS text_sha256 FROM benchmark"


def correction_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files of corrections, which overlap, written, read and merged: the last one by name wins, and both are named."""
    units = ledger.bound(_units(spark, sf_dir)).select("rank", "unit_id", "source_sha256", "ordinal")
    places = [_place(spark, f"corrections-{n}") for n in ("a", "b")]
    made = []
    for n, place in enumerate(places):
        # the second file has other names for every other unit, so that some units stand in one file only
        unit = F.when(F.col("ordinal") % 2 == n, F.concat("unit_id", F.lit("x"))).otherwise(F.col("unit_id")) if n else F.col("unit_id")
        rows = units.select("rank", unit.alias("unit_id"), "source_sha256", F.concat(F.lit(f"new {n} "), "unit_id").alias("translation"))
        writers.correction_files(rows.withColumn("translation_sha256", T.sha(F.col("translation"))), place, f"corrections-{n}")
        made.append(readers.corrections(spark, place))
    found = made[0].unionByName(made[1]).withColumn("file", F.regexp_extract("file", "[^/]+$", 0))
    merged = ledger.merged_corrections(found).select("rank", "unit_id", "clash", F.array_join("files", ",").alias("files"))
    last = ledger.last_corrections(found).select("rank", "unit_id", "translation")
    return merged.join(last, ["rank", "unit_id"])


CORRECTION_MERGE = f"WITH {O.PAIRS}, u AS (SELECT rank::INT AS rank, ordinal, {UNIT_ID} AS unit_id FROM bound), c AS (SELECT rank, unit_id, 'corrections-0.json' AS file, 'new 0 ' || unit_id AS translation FROM u UNION ALL SELECT rank, CASE WHEN ordinal % 2 = 1 THEN unit_id || 'x' ELSE unit_id END, 'corrections-1.json', 'new 1 ' || unit_id FROM u) SELECT rank, unit_id, count(DISTINCT file) > 1 AS clash, string_agg(file, ',' ORDER BY file) AS files, arg_max(translation, file) AS translation FROM c GROUP BY rank, unit_id"


# ---------------------------------------------------------------- plans, reports, files


def shard_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.shard_reports(_units(spark, sf_dir), 2)


SHARD_REPORTS = f"WITH {O.PAIRS}, u AS (SELECT rank, ordinal, {UNIT_ID} AS unit_id, translation, floor(ordinal / 2.0)::INT AS shard FROM bound), g AS (SELECT rank, shard, count(*) AS n_units, arg_min(unit_id, ordinal) AS first_unit, arg_max(unit_id, ordinal) AS last_unit, count(*) FILTER (coalesce(translation, '') <> '') AS translated FROM u GROUP BY rank, shard) SELECT *, CASE WHEN translated = n_units THEN 'PASS' ELSE 'FAIL' END AS status FROM g"


def prepared_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as configurations; customers make their plans, suppliers their bundles (the first by name counts)."""
    configs = _table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("rank"), F.col("n_name").alias("slug"), F.concat(F.lit("config/"), F.lower("n_name")).alias("path"))
    customers = _table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("rank"))
    plans = ledger.shard_plan(customers, 16).withColumn("path", F.concat(F.lit("plan/"), F.col("rank").cast("string")))
    bundles = _table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("rank"), F.col("s_name").alias("path"))
    return ledger.prepared_jobs(configs, plans, bundles)


PREPARED_JOBS = "WITH p AS (SELECT c_nationkey AS rank, ceil(count(*) / 16.0)::INT AS n FROM customer GROUP BY 1), b AS (SELECT s_nationkey AS rank, min(s_name) AS bundle FROM supplier GROUP BY 1) SELECT lpad(n_nationkey::VARCHAR, greatest(3, length(n_nationkey::VARCHAR))::INT, '0') AS rank, 'config/' || lower(n_name) AS config, regexp_replace(regexp_replace(lower(n_name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS key, bundle, s.shard::INT AS shard, lpad(s.shard::VARCHAR, greatest(4, length(s.shard::VARCHAR))::INT, '0') AS shard_padded FROM nation JOIN p ON n_nationkey = p.rank JOIN b ON n_nationkey = b.rank, LATERAL (SELECT unnest(generate_series(0, n - 1)) AS shard) s"


def job_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shards of all documents' sources as the list that a job runner takes, which has a limit by itself."""
    jobs = ledger.shard_jobs(ledger.shard_plan(_table(spark, sf_dir, "documents").withColumn("source", F.coalesce("source", F.lit("none"))), 1_000_000, "source"))
    return writers.job_matrix(jobs.select("source", "shard"))


JOB_MATRIX = "WITH p AS (SELECT coalesce(source, 'none') AS source, ceil(count(*) / 1000000.0)::INT AS n FROM documents GROUP BY 1), j AS (SELECT shard::INT AS shard, source FROM p, LATERAL (SELECT unnest(generate_series(0, n - 1)) AS shard) s) SELECT '{\"include\":[' || string_agg('{\"shard\":' || shard || ',\"source\":\"' || source || '\"}', ',' ORDER BY shard, source) || ']}' AS document FROM j"


def qa_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report on all pairs: counts, whole length ratio, and whether it passes; risks are told, but don't fail it."""
    rows, forms = D.prepared(pairs(spark, sf_dir))
    risk = D.translation_risk(F.col("source"), F.col("translation"), forms)
    counted = rows.select("rank", F.length("source").alias("s"), F.length("translation").alias("t"), D.empty(F.col("translation")).alias("empty"), risk.alias("risk"))
    sums = counted.agg(
        F.countDistinct("rank").alias("chapters"), F.count("*").alias("units"), F.count_if("empty").alias("empty_units"), F.count_if("risk").alias("risks"),
        F.round(F.sum("t") / F.greatest(F.lit(1), F.sum("s")), 6).alias("length_ratio"),
    )
    return sums.withColumn("passed", (F.col("empty_units") == 0) & F.col("length_ratio").between(0.55, 1.65))


QA_REPORT = f"WITH {O.PAIRS}, g AS (SELECT count(DISTINCT rank) AS chapters, count(*) AS units, count(*) FILTER ({O.empty(TT)}) AS empty_units, count(*) FILTER ({O.omission(S, TT)} OR {O.repetition(S, TT)}) AS risks, round(sum(length(translation))::DOUBLE / greatest(1, sum(length(source))), 6) AS length_ratio FROM bound) SELECT *, empty_units = 0 AND length_ratio BETWEEN 0.55::DOUBLE AND 1.65::DOUBLE AS passed FROM g"


def seeded_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations' names as headings of their region's work, whose title is the first of them; numerals are copied."""
    nations = _table(spark, sf_dir, "nation")
    titles = nations.groupBy(F.col("n_regionkey").alias("rank")).agg(F.concat(F.min("n_name"), F.lit(".")).alias("original_title"), F.concat(F.lit("title of "), F.min("n_name")).alias("title"))
    units = nations.select(F.col("n_regionkey").alias("rank"), "n_nationkey", F.lit("heading").alias("kind"), F.lower("n_name").alias("source"), F.lit(None).cast("string").alias("translation"))
    found = ledger.seeded(units, titles)
    return found.select("n_nationkey", "translation", copied_heading(F.substring("source", 1, 1)).alias("numeral"))


SEEDED_HEADINGS = "WITH m AS (SELECT n_regionkey AS r, min(n_name) AS first FROM nation GROUP BY 1) SELECT n_nationkey, CASE WHEN n_name = first THEN 'title of ' || first END AS translation, regexp_full_match(upper(n_name[1]), '[IVXLCDM]+\\.?') AS numeral FROM nation JOIN m ON n_regionkey = r"


def translation_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third translation is taken for missing."""
    rows = pairs(spark, sf_dir).withColumn("translation", F.when(F.col("ordinal") % 3 != 0, F.col("translation")))
    found = ledger.progress(rows, ["rank"])
    return found.withColumn("allowed", ledger.within_quota(F.col("chars_left"), F.lit(1000), F.lit(2000)))


TRANSLATION_PROGRESS = f"WITH {O.PAIRS}, u AS (SELECT rank, source, CASE WHEN ordinal % 3 <> 0 THEN coalesce(translation, '') ELSE '' END AS t FROM bound), g AS (SELECT rank, count(*) AS units, count(*) FILTER (t <> '') AS translated, coalesce(sum(length(source)) FILTER (t = ''), 0)::BIGINT AS chars_left FROM u GROUP BY rank) SELECT *, 1000 + chars_left <= 2000 AS allowed FROM g"


def first_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pairs(spark, sf_dir)
    other = rows.select("rank", "ordinal", T.sha(F.when(F.col("rank") % 2 == 0, F.concat("source", F.lit("!"))).otherwise(F.col("source"))).alias("source_sha256"))
    gone = ledger.missing(ledger.bound(rows), other, ("rank", "ordinal", "source_sha256"))
    found = ledger.first_of(gone.withColumn("kind", F.coalesce("kind", F.lit("none"))).withColumn("name", T.unit_id(F.col("rank"), F.col("ordinal"))), ["kind"], "name", 8)
    return found.select("kind", "n", F.array_join("first", ",").alias("first"))


FIRST_MISSING = f"WITH {O.PAIRS}, u AS (SELECT coalesce(kind, 'none') AS kind, 'c' || lpad(rank::VARCHAR, greatest(2, length(rank::VARCHAR))::INT, '0') || '-u' || lpad(ordinal::VARCHAR, greatest(4, length(ordinal::VARCHAR))::INT, '0') AS name FROM bound WHERE rank % 2 = 0) SELECT kind, count(*) AS n, array_to_string(list_sort(list(name))[1:8], ',') AS first FROM u GROUP BY kind"


def numbered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("rank"), "o_orderkey", "o_orderdate")
    return ledger.numbered_files(rows, F.struct("o_orderdate", "o_orderkey")).select("o_orderkey", "file", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


NUMBERED_FILES = "WITH n AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) SELECT o_orderkey, lpad(o_custkey::VARCHAR, greatest(3, length(o_custkey::VARCHAR))::INT, '0') || '-' || lpad(r::VARCHAR, greatest(3, length(r::VARCHAR))::INT, '0') || '.html' AS file, strftime(o_orderdate, '%Y-%m-%d') AS day FROM n"


def expected_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ledger.marker_groups(_table(spark, sf_dir, "events"), F.col("event_type") == "signup", ["user_id"], [F.col("ts"), F.col("event_id")])
    return ledger.with_expected_groups(rows, 12, ["user_id"]).select("user_id", "event_id", F.col("grp").cast("long").alias("grp"))


EXPECTED_GROUPS = "WITH g AS (SELECT user_id, event_id, greatest(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 1)::BIGINT AS grp FROM events), m AS (SELECT *, max(grp) OVER (PARTITION BY user_id) AS most FROM g) SELECT user_id, event_id, grp FROM m WHERE most = 12"


def placed_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signups of a user stand for marked illustrations, the user's orders by key for the images."""
    events = _table(spark, sf_dir, "events")
    marks = F.when(F.col("event_type") == "signup", F.lit(" [Illustration: one]")).otherwise(F.lit("text"))
    units = events.select(F.col("user_id").alias("rank"), F.lit(1).alias("chapter"), F.struct("ts", "event_id").alias("ordinal"), "event_id", marks.alias("source"))
    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    images = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("rank"), place.alias("place"), F.concat(F.lit("image-"), F.col("o_orderkey").cast("string")).alias("name"))
    return ledger.with_images(units, images).select("event_id", "image")


PLACED_IMAGES = "WITH u AS (SELECT user_id, event_id, event_type = 'signup' AS mark, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS place FROM events), i AS (SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS place, 'image-' || o_orderkey AS name FROM orders) SELECT event_id, i.name AS image FROM u LEFT JOIN i ON u.mark AND u.user_id = i.o_custkey AND u.place = i.place"


def rank_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of the customers in one segment, with a rule on a year and the hash of their record."""
    asked = _table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    rows = ledger.in_ranks(_table(spark, sf_dir, "orders"), asked, "o_custkey").select("o_orderkey", "o_custkey", gates.public_domain(F.year("o_orderdate"), 1996).alias("old"))
    return gates.self_hashed(rows, ["o_orderkey", "o_custkey", "old"])


RANK_SCOPE = "SELECT o_orderkey, o_custkey, year(o_orderdate) < 1996 AS old, sha256('{\"o_orderkey\":' || o_orderkey || ',\"o_custkey\":' || o_custkey || ',\"old\":' || (year(o_orderdate) < 1996)::VARCHAR || '}') AS record_sha256 FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"


def page_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts as roots, all their landed pages linked by the root, and a crawl of them."""
    titles = _table(spark, sf_dir, "pages").select(F.regexp_replace("url", "^https?://", "").alias("title"), "page_id")
    host = F.regexp_extract("title", "^[^/]+", 0)
    middle = titles.select("page_id", F.explode(pages.ancestors(F.col("title"))).alias("title"))
    every = titles.unionByName(middle.select("title", "page_id")).groupBy("title").agg(F.min("page_id").alias("position"))
    links = every.select(host.alias("title"), F.col("title").alias("target"), "position").filter("title <> target")
    return pages.crawled(every.select("title"), links, every.select(host.alias("root")).distinct(), 4, 240).select("root", "title", F.col("depth").cast("int").alias("depth"), F.col("place").cast("long").alias("place"))


PAGE_TREE = """WITH RECURSIVE t AS (SELECT regexp_replace(url, '^https?://', '') AS title, page_id FROM pages), parts AS (SELECT page_id, title, string_split(title, '/') AS p FROM t),
every AS (SELECT title, min(page_id) AS position FROM (SELECT title, page_id FROM t UNION ALL SELECT array_to_string(p[1:i], '/'), page_id FROM parts, LATERAL (SELECT unnest(generate_series(1, len(p) - 1)) AS i) s) GROUP BY title),
kids AS (SELECT title, regexp_extract(title, '^(.*)/[^/]+$', 1) AS parent, regexp_extract(title, '^[^/]+') AS root, position FROM every),
ranked AS (SELECT *, row_number() OVER (PARTITION BY parent ORDER BY position, title) AS n FROM kids WHERE parent <> ''),
walk AS (SELECT DISTINCT root, root AS title, 0 AS depth, [0::BIGINT] AS path FROM kids UNION ALL SELECT w.root, r.title, w.depth + 1, list_append(w.path, r.n) FROM walk w JOIN ranked r ON r.parent = w.title WHERE w.depth < 4),
placed AS (SELECT *, row_number() OVER (PARTITION BY root ORDER BY path) AS place FROM walk)
SELECT root, title, depth::INT AS depth, place FROM placed WHERE place <= 240"""


def unit_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs as a stream of units, translations and corrections, some of another source: what each unit ends up with, and how many translations clashed."""
    rows = pairs(spark, sf_dir).select(F.col("rank").cast("int").alias("rank"), T.unit_id(F.lit(1), F.col("ordinal")).alias("unit_id"), "ordinal", T.sha(F.col("source")).alias("source_sha256"), "translation")
    other = F.when(F.col("ordinal") % 5 == 4, F.lit("another")).otherwise(F.col("source_sha256"))
    record = lambda kind, source, text, seq: F.struct(F.lit(kind).alias("kind"), source.alias("source_sha256"), text.alias("translation"), F.lit(seq).cast("long").alias("seq"))
    none, own = F.lit(None).cast("string"), F.col("source_sha256")
    given = F.array(
        record("unit", own, none, 0), record("translation", own, F.col("translation"), 1), record("translation", other, F.concat("translation", F.lit(".")), 2),
        *[F.when(F.col("ordinal") % 3 == 0, record("correction", own, F.lit("corrected"), 3))],
    )
    records = rows.select("rank", "unit_id", "ordinal", F.explode(F.array_compact(given)).alias("r")).select("rank", "unit_id", "r.*", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("ordinal")).alias("at"))
    place = _place(spark, "units")
    # two batches, each of a file for each core
    n = spark.sparkContext.defaultParallelism
    records.repartition(2 * n).write.json(f"{place}/in")
    events = units_.unit_events(units_.record_files(spark, f"{place}/in", n), 3600, "3650 days")
    query = events.writeStream.format("parquet").option("path", f"{place}/out").option("checkpointLocation", f"{place}/check").trigger(availableNow=True).start()
    query.awaitTermination()
    rows = spark.read.schema(units_.OUT).parquet(f"{place}/out")
    sums = rows.groupBy("rank", "unit_id").agg(F.count_if(F.col("event") == "CONFLICT").alias("conflicts"), F.count_if(F.col("event") == "STALE").alias("stale"))
    return units_.settled(rows).join(sums, ["rank", "unit_id"]).select("rank", "unit_id", "seq", T.sha(F.col("translation")).alias("translation_sha256"), "conflicts", "stale")


UNIT_STREAM = O.pairs(
    f"""rank::INT AS rank, {UNIT_ID} AS unit_id, (CASE WHEN ordinal % 3 = 0 THEN 3 WHEN ordinal % 5 = 4 THEN 1 ELSE 2 END)::BIGINT AS seq,
sha256(CASE WHEN ordinal % 3 = 0 THEN 'corrected' WHEN ordinal % 5 = 4 THEN translation ELSE translation || '.' END) AS translation_sha256, (ordinal % 5 <> 4)::BIGINT AS conflicts, (ordinal % 5 = 4)::BIGINT AS stale"""
)


def quota_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pending units of an account for each source; every third account's quota is used up half-way, others have no limit."""
    docs = _table(spark, sf_dir, "documents").select("source", "doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("chars"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"))
    sums = docs.groupBy("source").agg(F.sum("chars").alias("all"), F.count("*").alias("used"))
    kind = F.length("source") + F.ascii(F.substring("source", -1, 1))
    quotas = sums.filter(kind % 5 > 0).select("source", "used", F.when(kind % 3 == 0, F.floor(F.col("all") / 2)).alias("limit"))
    sent = admission.admitted(docs, quotas, "source", ["doc_id"])
    return sent.select("source", "doc_id", "state", "request.cell", "request.row", "request.alone").na.fill(-1, ["cell", "row", "alone"])


QUOTA_ADMISSION = """WITH d AS (SELECT source, doc_id, length(coalesce(text, ''))::BIGINT AS chars, strlen(coalesce(text, ''))::BIGINT AS bytes FROM documents),
q AS (SELECT source, n AS used, CASE WHEN kind % 3 = 0 THEN all_ // 2 END AS lim FROM (SELECT source, sum(chars)::BIGINT AS all_, count(*) AS n, length(source) + ascii(right(source, 1)) AS kind FROM d GROUP BY source) WHERE kind % 5 > 0),
c AS (SELECT *, bytes <= 131072 AS fits FROM d),
s AS (SELECT *, coalesce(sum(CASE WHEN fits THEN chars ELSE 0 END) OVER w, 0) AS chars_, coalesce(sum(CASE WHEN fits THEN bytes ELSE 0 END) OVER w, 0) AS bytes_, coalesce(sum(fits::INT) OVER w, 0) AS n_ FROM c WINDOW w AS (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT s.*, CASE WHEN NOT fits THEN 'TOO_LARGE' WHEN used IS NULL THEN 'NO_ACCOUNT' WHEN lim IS NULL OR used + chars_ + chars <= lim THEN 'SENT' ELSE 'BLOCKED_QUOTA' END AS state FROM s LEFT JOIN q ON q.source IS NOT DISTINCT FROM s.source)
SELECT source, doc_id, state, CASE WHEN state = 'SENT' THEN (bytes_ // 65536)::BIGINT ELSE -1 END AS cell, CASE WHEN state = 'SENT' THEN (n_ // 20)::BIGINT ELSE -1 END AS row, CASE WHEN state <> 'SENT' THEN -1 WHEN bytes > 65536 THEN (n_ + 1)::BIGINT ELSE 0 END AS alone FROM t"""


def gated_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' hashes in files of a thousand ids of a source each, published if the gates that are observed while they are written hold."""
    docs = _table(spark, sf_dir, "documents")
    block = F.floor(F.col("doc_id") / 1000).cast("string")
    lines = docs.select(F.concat(F.coalesce("source", F.lit("none")), F.lit("-"), block, F.lit(".txt")).alias("name"), "doc_id", T.sha(T.known(F.col("text"))).alias("line"), "n_chars")
    place = _place(spark, "release")
    published.publish(lines, place, "name", "line", [F.col("doc_id"), F.col("line")], {"some": F.count("*") > 0, "whole": F.coalesce(F.min("n_chars"), F.lit(0)) >= 0, "named": F.count_if(F.col("name").isNull()) == 0})
    return published.manifest(spark, place).select("name", "lines", "bytes", "sha256")


GATED_RELEASE = "WITH d AS (SELECT coalesce(source, 'none') || '-' || (doc_id // 1000) || '.txt' AS name, doc_id, sha256(coalesce(text, '')) AS line FROM documents) SELECT name, count(*) AS lines, (65 * count(*))::BIGINT AS bytes, sha256(string_agg(line || chr(10), '' ORDER BY doc_id, line)) AS sha256 FROM d GROUP BY name"


def _landed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Hosts as roots with the number of parts that is expected of them, what they and their index pages link to, and sections of pages.

    Every other host (by its length) doesn't link to its index pages. Sections are the paragraphs of a page, of the second level every other one."""
    rows = _table(spark, sf_dir, "pages").select(F.regexp_replace("url", "^https?://", "").alias("title"), "page_id", "html")
    middle = rows.select("page_id", F.explode(pages.ancestors(F.col("title"))).alias("title"))
    every = rows.select("title", "page_id").unionByName(middle.select("title", "page_id")).groupBy("title").agg(F.min("page_id").alias("position"))
    every = every.join(middle.select("title").distinct().withColumn("index", F.lit(True)), "title", "left").withColumn("root", F.regexp_extract("title", "^[^/]+", 0))
    linked = every.filter((F.col("title") != F.col("root")) & (F.col("index").isNull() | (F.length("root") % 2 == 1)))
    own = every.withColumn("above", page_sets_.parent(F.col("title"))).filter("above <> '' and above <> root")
    links = linked.select(F.col("root").alias("title"), F.col("title").alias("target"), "position").unionByName(own.select(F.col("above").alias("title"), F.col("title").alias("target"), "position"))
    first = rows.withColumn("host", F.regexp_extract("title", "^[^/]+", 0))
    of = lambda key: first.groupBy(key).agg(F.min_by("html", "page_id").alias("html")).select(F.col(key).alias("title"), F.size(F.regexp_extract_all("html", F.lit("<p>"), F.lit(0))).alias("n"))
    counts = of("title").unionByName(of("host")).filter("n > 0")
    sections = counts.select("title", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("index"))
    sections = sections.select("title", "index", F.when(F.col("index") % 2 == 1, 2).otherwise(3).alias("level"), F.when(F.col("index") % 3 > 0, F.concat(F.lit("s"), F.col("index").cast("string"))).alias("line"))
    sums = every.groupBy("root").agg(F.count_if(F.col("index").isNull()).alias("leaves"), F.count_if(page_sets_.parent(F.col("title")) == F.col("root")).alias("kids"))
    level_two = sections.filter("level = 2").groupBy(F.col("title").alias("root")).agg(F.count("*").alias("cut"))
    kind = F.length("root") % 6
    expected = F.when(kind == 0, F.col("leaves")).when(kind == 1, F.greatest(F.col("kids") - 1, F.lit(1))).when(kind == 2, F.col("cut")).when(kind == 3, F.col("kids") + 1).when(kind == 4, F.lit(5))
    return sums.join(level_two, "root", "left").select("root", expected.alias("expected")), links, sections


def page_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which landed pages, or sections of them, are the parts of each host; section 0 is a whole page."""
    return page_sets_.page_sets(*_landed(spark, sf_dir)).na.fill(0, ["section"])


PAGE_SETS = f"""WITH RECURSIVE t AS (SELECT regexp_replace(url, '^https?://', '') AS title, page_id, html FROM pages), cut AS (SELECT page_id, string_split(title, '/') AS p FROM t),
middle AS (SELECT page_id, array_to_string(p[1:i], '/') AS title FROM cut, LATERAL (SELECT unnest(generate_series(1, len(p) - 1)) AS i) s),
every AS (SELECT title, min(page_id) AS position, regexp_extract(title, '^[^/]+') AS root, title IN (SELECT title FROM middle) AS is_index, regexp_extract(title, '^(.*)/[^/]+$', 1) AS parent FROM (SELECT title, page_id FROM t UNION ALL SELECT title, page_id FROM middle) GROUP BY title),
of_root AS (SELECT root, title, parent, position FROM every WHERE title <> root AND (NOT is_index OR length(root) % 2 = 1)),
paragraphs AS (SELECT title, len(regexp_extract_all(arg_min(html, page_id), '<p>')) AS n FROM t GROUP BY title UNION ALL SELECT regexp_extract(title, '^[^/]+'), len(regexp_extract_all(arg_min(html, page_id), '<p>')) FROM t GROUP BY 1),
sections AS (SELECT title, i, CASE WHEN i % 3 > 0 THEN 's' || i ELSE i::VARCHAR END AS line FROM (SELECT title, unnest(generate_series(1, n)) AS i FROM paragraphs) WHERE i % 2 = 1),
twos AS (SELECT title, count(*) AS n FROM sections GROUP BY title),
sums AS (SELECT root, count(*) FILTER (WHERE NOT is_index) AS leaves, count(*) FILTER (WHERE parent = root) AS kids FROM every GROUP BY root),
roots AS (SELECT root, coalesce(CASE length(root) % 6 WHEN 0 THEN leaves WHEN 1 THEN greatest(kids - 1, 1) WHEN 2 THEN twos.n WHEN 3 THEN kids + 1 WHEN 4 THEN 5 END, 1) AS expected, coalesce(twos.n, 0) AS sections FROM sums LEFT JOIN twos ON twos.title = root),
terminals AS (SELECT root, title, position FROM of_root o WHERE NOT EXISTS (SELECT 1 FROM of_root b WHERE b.root = o.root AND starts_with(b.title, o.title || '/'))),
chosen AS (SELECT root, expected, CASE WHEN n_terminals = expected THEN 'terminals' WHEN n_kids > 0 AND n_kids >= expected THEN 'children' WHEN expected > 1 AND sections = expected THEN 'sections' WHEN n_kids > 0 THEN 'fewer children' ELSE 'page' END AS strategy
  FROM (SELECT r.*, (SELECT count(*) FROM terminals x WHERE x.root = r.root) AS n_terminals, (SELECT count(*) FROM of_root x WHERE x.root = r.root AND x.parent = r.root) AS n_kids FROM roots r)),
kids AS (SELECT root, parent, title, min(b) AS b, position FROM (SELECT root, parent, title, position, 1 AS b FROM of_root UNION ALL SELECT root, parent, title, position, 0 FROM every WHERE parent NOT IN ('', root)) WHERE parent <> '' GROUP BY root, parent, title, position),
ranked AS (SELECT *, {O.number_of("lower(regexp_extract(title, '[^/]*$'))")} AS number, lower(regexp_extract(title, '[^/]*$')) AS leaf FROM kids),
starts AS (SELECT t.root, t.title, [{{'u': true, 'n': 0::BIGINT, 'l': '', 'b': 0, 'p': t.position, 't': t.title}}] AS path FROM terminals t JOIN chosen c ON c.root = t.root AND strategy = 'terminals'
  UNION ALL SELECT k.root, k.title, [{{'u': number IS NULL, 'n': coalesce(number, 0)::BIGINT, 'l': leaf, 'b': b, 'p': position, 't': title}}] FROM ranked k JOIN chosen c ON c.root = k.root AND strategy IN ('children', 'fewer children') WHERE parent = k.root),
walk AS (SELECT root, title, 1 AS depth, path FROM starts UNION ALL
  SELECT w.root, k.title, depth + 1, list_append(path, {{'u': number IS NULL, 'n': coalesce(number, 0)::BIGINT, 'l': leaf, 'b': b, 'p': position, 't': k.title}}) FROM walk w JOIN ranked k ON k.root = w.root AND k.parent = w.title WHERE depth < 4),
visited AS (SELECT *, row_number() OVER (PARTITION BY root ORDER BY path) AS visit FROM walk),
leaves AS (SELECT root, title, path FROM visited v WHERE visit <= 240 AND (depth = 4 OR NOT EXISTS (SELECT 1 FROM kids k WHERE k.root = v.root AND k.parent = v.title))),
whole AS (SELECT l.*, strategy, expected FROM leaves l JOIN chosen USING (root) UNION ALL SELECT root, root, NULL, strategy, expected FROM chosen WHERE strategy = 'page'),
parts AS (SELECT root, strategy, expected, path, w.title AS page, i AS section, w.title || '/' || line AS title FROM (SELECT w.* FROM whole w JOIN twos ON twos.title = w.title WHERE twos.n = expected AND strategy <> 'page' UNION ALL SELECT root, root, NULL, strategy, expected FROM chosen WHERE strategy = 'sections') w JOIN sections s ON s.title = w.title
  UNION ALL SELECT root, strategy, expected, path, w.title, NULL, w.title FROM whole w LEFT JOIN twos ON twos.title = w.title WHERE strategy = 'page' OR twos.n IS NULL OR twos.n <> expected)
SELECT root, strategy, expected::BIGINT AS expected, row_number() OVER (PARTITION BY root ORDER BY path, page, section) AS place, page, coalesce(section, 0) AS section, title FROM parts"""


def page_division(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages cut at their short paragraphs, where these are as many as the page's number asks for: a title and the markup of each part."""
    rows = _table(spark, sf_dir, "pages").select("page_id", division.divisions(F.col("html"), F.col("page_id") % 3 + 2, (SHORT, "p")).alias("parts"))
    found = rows.select("page_id", F.posexplode("parts").alias("part", "d"))
    return found.select("page_id", "part", F.col("d.title").alias("title"), F.length("d.html").alias("n_chars"), T.sha(F.col("d.html")).alias("html_sha256"))


def page_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blocks of each page's prose: how many, how long, and what they say."""
    rows = _table(spark, sf_dir, "pages").select("page_id", pages.clean_blocks(F.col("html")).alias("blocks"))
    return pages.page_counts(rows).select("page_id", F.col("n_blocks").cast("long").alias("n_blocks"), "n_chars", T.sha(F.array_join("blocks", "\u0001")).alias("blocks_sha256"))


#: A paragraph of at most twelve words.
SHORT = r"\S+(?: \S+){0,11}"
_CUT = "list_transform(string_split(html, '<p>')[2:], lambda x: string_split_regex(x, '</p>|</article>')[1])"
_SAID = "replace(replace(array_to_string(list_filter(list_transform(string_split_regex(x, '<[^>]*>'), lambda t: trim(t, ' ' || chr(10) || chr(9) || chr(13))), lambda t: t <> ''), ' '), '&quot;', chr(34)), '&amp;', '&')"
PAGE_DIVISION = f"""WITH b AS (SELECT page_id, unnest({_CUT}) AS x, unnest(generate_series(1, len({_CUT}))) AS i FROM pages),
t AS (SELECT page_id, i, regexp_replace({_SAID}, '\\s+', ' ', 'g') AS said, '<p>' || replace(x, '&quot;', chr(34)) || CASE WHEN contains(x, '<b>') THEN '</b>' ELSE '' END || '</p>' AS html FROM b),
m AS (SELECT *, regexp_full_match(said, '{SHORT}') AS mark FROM t), n AS (SELECT *, sum(mark::INT) OVER (PARTITION BY page_id ORDER BY i) AS part, sum(mark::INT) OVER (PARTITION BY page_id) AS marks FROM m),
g AS (SELECT page_id, greatest(part, 1)::INT - 1 AS part, string_agg(said, '' ORDER BY i) FILTER (WHERE mark) AS title, coalesce(string_agg(html, '' ORDER BY i) FILTER (WHERE NOT mark), '') AS html FROM n WHERE marks = page_id % 3 + 2 GROUP BY 1, 2)
SELECT page_id, part, title, length(html)::INT AS n_chars, sha256(html) AS html_sha256 FROM g"""


#: Pages of the tables have paragraphs only.
PAGE_BLOCKS = f"""WITH b AS (SELECT page_id, unnest({_CUT}) AS x, unnest(generate_series(1, len({_CUT}))) AS i FROM pages),
t AS (SELECT page_id, i, trim(regexp_replace(regexp_replace({_SAID}, '[ \\t\\x{{00a0}}]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')) AS said FROM b),
d AS (SELECT page_id, said, min(i) AS i FROM t WHERE length(said) >= 2 AND NOT regexp_full_match(said, '(?i)[0-9ivxlcdm. –—-]+') GROUP BY page_id, said),
g AS (SELECT page_id, count(*) AS n, sum(length(said))::BIGINT AS c, string_agg(said, chr(1) ORDER BY i) AS joined FROM d GROUP BY page_id)
SELECT page_id, coalesce(n, 0) AS n_blocks, coalesce(c, 0) AS n_chars, sha256(coalesce(joined, '')) AS blocks_sha256 FROM pages LEFT JOIN g USING (page_id)"""


# ---------------------------------------------------------------- twins of queries in the catalog

BIN_PACK = """WITH RECURSIVE f AS (SELECT source, doc_id, n_chars::BIGINT AS s, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents),
p AS (SELECT source, doc_id, s, r, 1 AS part, s AS held FROM f WHERE r = 1 UNION ALL
  SELECT f.source, f.doc_id, f.s, f.r, CASE WHEN p.held > 0 AND p.held + f.s > 50000 THEN p.part + 1 ELSE p.part END, CASE WHEN p.held > 0 AND p.held + f.s > 50000 THEN f.s ELSE p.held + f.s END
  FROM p JOIN f ON f.source IS NOT DISTINCT FROM p.source AND f.r = p.r + 1)"""


def archive_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.part_sizes(gates.parts(_table(spark, sf_dir, "documents"), "source", "doc_id", "n_chars", 50_000), "source", "n_chars")


def _grams(word: str) -> str:
    def of(k: int) -> str:
        return f"CASE WHEN length({word}) <= {k} THEN [{word}] ELSE list_transform(generate_series(1, length({word}) - {k - 1}), lambda i: substring({word}, i, {k})) END"

    return f"list_concat({of(3)}, CASE WHEN length({word}) >= 4 THEN {of(4)} ELSE [] END, CASE WHEN length({word}) >= 5 THEN {of(5)} ELSE [] END)"


TFIDF_ALIGN = f"""WITH {O.PAIRS}, n AS (SELECT *, ordinal / count(*) OVER (PARTITION BY rank)::DOUBLE AS fraction FROM bound),
texts AS (SELECT rank, 'a' AS side, ordinal, translation AS text, fraction FROM n UNION ALL SELECT rank, 'p', ordinal, source, fraction FROM n),
words AS (SELECT rank, side, ordinal, ' ' || w || ' ' AS w FROM (SELECT rank, side, ordinal, unnest(string_split_regex(replace(strip_accents(lower(coalesce(text, ''))), 'ß', 'ss'), '\\s+')) AS w FROM texts) WHERE w <> ''),
grams AS (SELECT rank, side, ordinal, unnest({_grams('w')}) AS gram FROM words),
tf AS (SELECT rank, side, ordinal, gram, count(*) AS tf FROM grams GROUP BY 1, 2, 3, 4),
docs AS (SELECT rank, count(*) AS docs FROM texts GROUP BY rank),
raw AS (SELECT tf.*, tf * (ln((1 + docs)::DOUBLE / (1 + count(*) OVER (PARTITION BY rank, gram))) + 1) AS raw FROM tf JOIN docs USING (rank)),
w AS (SELECT *, raw / sqrt(sum(raw * raw) OVER (PARTITION BY rank, side, ordinal)) AS weight FROM raw),
cosine AS (SELECT a.rank, a.ordinal AS anchor, p.ordinal AS paragraph, sum(a.weight * p.weight) AS similarity FROM w a JOIN w p ON a.rank = p.rank AND a.gram = p.gram AND a.side = 'a' AND p.side = 'p' GROUP BY 1, 2, 3),
near AS (SELECT c.*, fa.fraction AS fa, fp.fraction AS fp FROM cosine c JOIN n fa ON c.rank = fa.rank AND c.anchor = fa.ordinal JOIN n fp ON c.rank = fp.rank AND c.paragraph = fp.ordinal),
placed AS (SELECT *, row_number() OVER (PARTITION BY rank, anchor ORDER BY round(0.12::DOUBLE * abs(fp - fa) - similarity, 9), fp) AS place FROM near)
SELECT rank AS chapter, anchor::VARCHAR AS anchor, paragraph::VARCHAR AS paragraph, round(similarity, 6) AS similarity, place::INT AS place FROM placed WHERE place <= 3"""

_WS = "[\\s\\x{00a0}]+"


def _lens(parts: str) -> str:
    return f"list_transform({parts}, lambda p: length(p))"


def _packed(lens: str, limit: int, blank: int = 1) -> str:
    """Lengths of what lengths are packed to."""
    step = f"lambda a, b: CASE WHEN a.now + {blank} + b.now <= {limit} THEN {{'done': a.done, 'now': a.now + {blank} + b.now}} ELSE {{'done': list_append(a.done, a.now), 'now': b.now}} END"
    folded = f"list_reduce(list_transform({lens}, lambda n: {{'done': []::BIGINT[], 'now': n::BIGINT}}), {step})"
    return f"CASE WHEN len({lens}) = 0 THEN []::BIGINT[] ELSE list_append(({folded}).done, ({folded}).now) END"


def _words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{_WS}'), lambda w: w <> '')"


def _cut_after(x: str, signs: str) -> str:
    return f"string_split(regexp_replace({x}, '([{signs}]){_WS}', '\\1' || chr(1), 'g'), chr(1))"


def _nonempty(parts: str) -> str:
    return f"list_filter(list_transform({parts}, lambda c: {O.stripped('c')}), lambda c: c <> '')"


_LONG_PARTS = f"flatten(list_transform({_cut_after('s', ';:,—–')}, lambda c: CASE WHEN length(c) > 1400 THEN {_lens(_words('c'))} ELSE [length(c)] END))"
_BLOCKS = f"list_sum(list_transform(sentences, lambda s: CASE WHEN length(s) <= 1400 THEN 1 ELSE len({_packed(_LONG_PARTS, 1400)}) END))"
_CLAUSES = _nonempty(_cut_after("s", ",;:!?…—–"))
_ATOMS = f"list_sum(list_transform(CASE WHEN len(sentences) > 0 THEN sentences ELSE [text] END, lambda s: list_sum(list_transform(CASE WHEN len({_CLAUSES}) > 0 THEN {_CLAUSES} ELSE [s] END, lambda c: CASE WHEN length(c) <= 180 THEN 1 ELSE len({_packed(_lens(_words('c')), 150)}) END))))"
_BOUNDED_FOLD = "list_reduce(list_transform(regexp_extract_all(text, '\\s+|[^\\s]+'), lambda x: {'n': 0, 'now': length(x)::BIGINT, 'full': regexp_matches(x, '[^\\s\\x{00a0}]')}), lambda a, b: CASE WHEN a.now + b.now <= 110 THEN {'n': a.n, 'now': a.now + b.now, 'full': a.full OR b.full} ELSE {'n': a.n + a.full::INT, 'now': b.now, 'full': b.full} END)"
_BOUNDED = f"CASE WHEN len(regexp_extract_all(text, '\\s+|[^\\s]+')) = 0 THEN 1 ELSE greatest(1, ({_BOUNDED_FOLD}).n + ({_BOUNDED_FOLD}).full::INT) END"
_ROUGH = _nonempty("string_split(regexp_replace(regexp_replace(chunk, '([.!?…])\\s+', '\\1' || chr(1), 'g'), '\\n+', chr(1), 'g'), chr(1))")
_CHUNKS = f"CASE WHEN length(chunk) <= 700 THEN 1 ELSE len({_packed(f'flatten(list_transform({_ROUGH}, lambda p: CASE WHEN length(p) > 700 THEN {_packed(_lens(_words("p")), 700)} ELSE [length(p)] END))', 700)}) END"
_BY_WORD = f"CASE WHEN length(chunk) <= 760 THEN 1 ELSE len({_packed(f'flatten(list_transform({_ROUGH}, lambda p: CASE WHEN length(p) > 760 THEN {_lens(_words("p"))} ELSE [length(p)] END))', 760)}) END"
SEGMENTS = f"WITH d AS (SELECT doc_id, text, {O.sentences('text')} AS sentences, regexp_replace({O.stripped('text')}, '[ \\t]+', ' ', 'g') AS chunk FROM documents) SELECT doc_id, coalesce({_BLOCKS}, 0)::INT AS blocks, ({_ATOMS})::INT AS atoms, ({_BOUNDED})::INT AS bounded, ({_CHUNKS})::INT AS chunks, ({_BY_WORD})::INT AS chunks_by_word FROM d"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        repair_flags, candidate_reasons, composed_forms, text_forms, alignment_roundtrip, bundle_roundtrip, packed_json, correction_merge, shard_reports, prepared_jobs,
        job_matrix, qa_report, seeded_headings, translation_progress, first_missing, numbered_files, expected_groups, placed_images, rank_scope, page_tree, page_sets, page_division, page_blocks, quota_admission, gated_release, unit_stream, archive_parts,
    )
}
ORACLES: dict[str, str] = {
    "repair_flags": REPAIR_FLAGS,
    "page_sets": PAGE_SETS,
    "page_division": PAGE_DIVISION,
    "page_blocks": PAGE_BLOCKS,
    "quota_admission": QUOTA_ADMISSION,
    "unit_stream": UNIT_STREAM,
    "gated_release": GATED_RELEASE,
    "candidate_reasons": CANDIDATE_REASONS,
    "composed_forms": COMPOSED_FORMS,
    "text_forms": TEXT_FORMS,
    "alignment_roundtrip": ALIGNMENT_ROUNDTRIP,
    "bundle_roundtrip": BUNDLE_ROUNDTRIP,
    "packed_json": PACKED_JSON,
    "correction_merge": CORRECTION_MERGE,
    "shard_reports": SHARD_REPORTS,
    "prepared_jobs": PREPARED_JOBS,
    "job_matrix": JOB_MATRIX,
    "qa_report": QA_REPORT,
    "seeded_headings": SEEDED_HEADINGS,
    "translation_progress": TRANSLATION_PROGRESS,
    "first_missing": FIRST_MISSING,
    "numbered_files": NUMBERED_FILES,
    "expected_groups": EXPECTED_GROUPS,
    "placed_images": PLACED_IMAGES,
    "rank_scope": RANK_SCOPE,
    "page_tree": PAGE_TREE,
    "archive_parts": f"{BIN_PACK} SELECT source, part, count(*) AS files, sum(s)::BIGINT AS size FROM p GROUP BY source, part",
    "bin_pack_parts": f"{BIN_PACK} SELECT source, doc_id, s AS n_chars, part FROM p",
    "repeated_adjacent": REPEATED_ADJACENT,
    "post_failures": POST_FAILURES,
    "decoder_loop": f"SELECT doc_id, {decoder_loop(O.known('text'))} AS loop, {word_five_times(O.known('text'))} AS word_loop FROM documents",
    "incremental_overlay": O.ORACLES["ledger_latest"],
    "tfidf_align": TFIDF_ALIGN,
    "segments": SEGMENTS,
}
