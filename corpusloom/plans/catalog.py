"""The queries over the driver's tables, one for each operator or group of them.

Pairs stand in for units of an alignment ledger: a turn of a conversation is the source, the next one its translation,
the conversation the rank, and the turn the ordinal.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions import books
from corpusloom.functions import detectors as D
from corpusloom.functions import packing as P
from corpusloom.functions import text as T
from corpusloom.operators import gates, ledger, pages, selection, similarity, translate
from corpusloom.operators.lineage import shared_folder
from corpusloom.streaming.overlay import overlay, record_stream, state


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rank, ordinal, kind, source, translation); the last turn of a conversation has no translation and is none."""
    turns = Window.partitionBy("conv_id").orderBy("turn")
    rows = _table(spark, sf_dir, "conversations").withColumn("translation", F.lead("text").over(turns)).withColumn("_next", F.lead("turn").over(turns))
    return rows.filter("_next is not null").select(
        F.col("conv_id").alias("rank"), F.col("turn").alias("ordinal"), F.col("role").alias("kind"), F.col("text").alias("source"), "translation"
    )


def _sides() -> tuple[Column, Column]:
    return F.col("source"), F.col("translation")


def _flags(forms: D.Forms) -> Column:
    s, t = _sides()
    return D.named(("empty", D.empty(t)), ("omission", D.omission(s, t, forms)), ("repetition", D.repetition(s, t, forms)))


def _hard(forms: D.Forms) -> Column:
    s, t = _sides()
    return D.hard_flags_repair(s, t, "en", similarity.repeated_span(t, forms.target_norms))


def pair_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, t = _sides()
    rows, forms = D.prepared(pairs(spark, sf_dir))
    return rows.select("rank", "ordinal", F.array_join(_flags(forms), ",").alias("flags"), F.array_join(_hard(forms), ",").alias("hard_flags"), F.round(D.ratio(s, t), 6).alias("length_ratio"))


def flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, forms = D.prepared(pairs(spark, sf_dir))
    return ledger.flag_counts(rows.withColumn("flags", _flags(forms)))


def hard_flags_targeted(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, t = _sides()
    return pairs(spark, sf_dir).select("rank", "ordinal", F.array_join(D.hard_flags_targeted(s, t), ",").alias("flags"))


def release_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, t = _sides()
    formed, forms = D.prepared(pairs(spark, sf_dir))
    rows = formed.select("rank", D.translation_risk(s, t, forms).alias("risk"), (F.size(_hard(forms)) > 0).alias("bad"))
    sums = rows.groupBy("rank").agg(F.count("*").alias("units"), F.count_if("risk").alias("flagged"), F.count_if("bad").alias("hard"))
    return sums.withColumn("status", D.status(F.col("flagged"), F.col("hard")))


def length_ratio_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, t = _sides()
    sums = pairs(spark, sf_dir).groupBy("rank").agg(F.sum(F.length(s)).alias("source_chars"), F.sum(F.length(t)).alias("target_chars"), F.count_if(D.empty(t)).alias("empty_units"))
    whole = F.col("target_chars") / F.greatest(F.lit(1), F.col("source_chars"))
    return sums.withColumn("length_ratio", F.round(whole, 6)).withColumn("passed", whole.between(0.55, 1.65) & (F.col("empty_units") == 0))


def duplicate_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, t = T.tokens(F.col("source")), T.tokens(F.col("translation"))
    return pairs(spark, sf_dir).select("rank", "ordinal", F.size(s).cast("long").alias("source_tokens"), F.size(t).cast("long").alias("target_tokens"), D.duplicate_half(s, t).alias("duplicate"))


def token_length_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir).select("rank", "ordinal", D.token_length_anomaly(T.tokens(F.col("source")), T.tokens(F.col("translation"))).alias("anomaly"))


def unit_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = _table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("block", "body"))
    # of the block no more is kept than its kind asks for
    pieces = blocks.select("doc_id", "block", F.substring(T.stripped(F.col("body")), 1, 141).alias("start"), F.posexplode(T.sentences(F.col("body"))).alias("piece", "source"))
    units = pieces.withColumn("ordinal", F.row_number().over(Window.partitionBy("doc_id").orderBy("block", "piece")).cast("long"))
    kind = books.kind(F.col("piece"), F.col("ordinal") - 1, F.col("start"))
    return units.select("doc_id", "ordinal", T.unit_id(F.lit(1), F.col("ordinal")).alias("unit_id"), kind.alias("kind"), T.sha(F.col("source")).alias("source_sha256"))


def sentence_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "documents").select("lang", F.size(T.sentences(T.known(F.col("text")))).cast("long").alias("n"), F.length("text").cast("long").alias("c"))
    return rows.groupBy("lang").agg(F.count("*").alias("docs"), F.sum("n").alias("sentences"), F.sum("c").alias("chars"))


def _documents(*columns: Callable[[], Column]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _table(spark, sf_dir, "documents").select("doc_id", *[c() for c in columns])


def _pairs(*columns: Callable[[], Column]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: pairs(spark, sf_dir).select("rank", "ordinal", *[c() for c in columns])


def _text() -> Column:
    return F.col("text")


def _shaken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all pairs, some of them of another source."""
    other = (F.col("ordinal") % 7 == 0) | (F.col("rank") % 5 == 0)
    return pairs(spark, sf_dir).select("rank", "ordinal", T.sha(F.when(other, F.concat("source", F.lit("!"))).otherwise(F.col("source"))).alias("source_sha256"), "translation")


_KEY = ("rank", "ordinal", "source_sha256")


def assemble_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ledger.assembled(ledger.bound(pairs(spark, sf_dir)).drop("translation_sha256"), _shaken(spark, sf_dir), _KEY)
    return found.select("rank", "ordinal", F.col("translation").isNotNull().alias("found"), T.sha(T.known(F.col("translation"))).alias("translation_sha256"))


def missing_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.missing(ledger.bound(pairs(spark, sf_dir)), _shaken(spark, sf_dir), _KEY).select("rank", "ordinal")


def overlay_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pairs(spark, sf_dir)
    same = (F.col("ordinal") % 2 == 0) & (F.col("rank") % 3 == 0)
    old = F.when(same, T.sha(F.col("source"))).otherwise(T.sha(F.concat(F.lit("old"), "source")))
    fixes = rows.select("rank", "ordinal", old.alias("source_sha256"), F.concat(F.lit("new "), "translation").alias("translation"))
    done = ledger.overlaid(ledger.bound(rows), fixes, ("rank", "ordinal"))
    return done.select("rank", "ordinal", "corrected", T.sha(F.col("translation")).alias("translation_sha256"))


def override_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pairs(spark, sf_dir)
    sha = T.sha(F.col("source")).alias("source_sha256")
    changed = T.sha(F.when(F.col("ordinal") % 3 == 0, F.concat("source", F.lit(" "))).otherwise(F.col("source"))).alias("source_sha256")
    # the second list names the unit before an odd one again, the third one units that aren't there
    overrides = (
        rows.select("rank", "ordinal", changed)
        .unionByName(rows.select("rank", (F.col("ordinal") - F.col("ordinal") % 2).alias("ordinal"), sha))
        .unionByName(rows.select("rank", (F.col("ordinal") + 1000).alias("ordinal"), sha))
    )
    return ledger.override_violations(ledger.bound(rows), overrides, ("rank", "ordinal"))


def fallback_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("rank"), F.col("o_orderkey").alias("unit"), "o_orderstatus")
    primary = rows.filter("o_orderstatus = 'F'").select("rank", "unit", F.lit("primary").alias("origin"))
    other = rows.filter("o_orderstatus <> 'F'").select("rank", "unit", F.lit("fallback").alias("origin"))
    return ledger.with_fallback(primary, other).groupBy("rank").agg(F.count("*").alias("units"), F.min("origin").alias("origin"))


def longest_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("rank"), F.col("l_returnflag").alias("path"))
    return ledger.longest(rows).groupBy("rank", "path").agg(F.count("*").alias("units"))


def conflict_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("rank"), F.col("l_suppkey").alias("unit_id"), F.col("l_returnflag").alias("translation_sha256"))
    return ledger.conflicts(rows)


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.duplicates(_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey"])


def roster_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    selected, excluded = orders.filter("o_orderpriority like '1%'"), orders.filter("o_orderpriority like '5%'")
    return gates.partition_violations_by_bitmaps(_table(spark, sf_dir, "customer"), selected, excluded, "c_custkey")


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", "url", "html", F.regexp_replace("url", "^https?://", "").alias("title"))


def _host() -> Column:
    return F.regexp_extract("title", "^[^/]+", 0)


def prefix_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = _titles(spark, sf_dir)
    roots = titles.select(F.regexp_extract("title", "^(.*)/[^/]+$", 1).alias("title"))
    return pages.children(titles, roots).select("parent", "title")


def terminal_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = _titles(spark, sf_dir)
    return pages.terminals(titles.select("title").unionByName(titles.select(_host().alias("title"))))


def natural_title_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = _titles(spark, sf_dir).withColumn("host", _host()).withColumn("title", F.col("url"))
    return pages.in_title_order(titles, "title", "host", ("page_id",)).select("page_id", F.col("place").cast("long").alias("place"))


def best_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("translation")
    made = F.array(
        F.struct(F.lit(0).alias("candidate"), t.alias("text")),
        F.struct(F.lit(1).alias("candidate"), F.substring(t, F.lit(1), F.floor(F.length(t) / 2).cast("int")).alias("text")),
        F.struct(F.lit(2).alias("candidate"), F.concat(t, F.lit(" "), t).alias("text")),
    )
    rows = pairs(spark, sf_dir).withColumn("c", F.explode(made)).select("rank", "ordinal", "kind", "source", "c.candidate", F.col("c.text").alias("translation"))
    return translate.best(rows, ["rank", "ordinal"], "en").select("rank", "ordinal", "candidate", "clear", F.round("score", 6).alias("score"))


def source_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _table(spark, sf_dir, "part").select(
        "p_partkey", "p_retailprice", F.lower("p_name").alias("title"), F.array(F.lit("")).alias("authors"), F.when(F.col("p_brand").like("%1"), F.array(F.lit("en"))).otherwise(F.array().cast("array<string>")).alias("languages")
    )
    scored = gates.scored_candidates(parts, F.lit("part name special"), F.lit("no one"), F.lit("en"))
    # a report of the best twelve, so the limit is what is asked for
    top = scored.orderBy(F.desc("score"), F.desc("p_retailprice"), "p_partkey").limit(12)
    place = Window.orderBy(F.desc("score"), F.desc("p_retailprice"), "p_partkey")
    return top.select("p_partkey", F.col("score").cast("long").alias("score"), F.row_number().over(place).cast("long").alias("place"))


def end_marker_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("rank"), (F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1).cast("long").alias("ordinal"), "text")
    # conversations are short: the third turn counts as a marker, and a text of even length as a cue
    words = F.when(F.col("ordinal") == 2, F.lit(D.END_MARKERS[0])).otherwise(F.array_join(T.tokens(F.col("text")), " "))
    return ledger.after_end(turns, words, D.END_MARKERS, F.length("text") % 2 == 0, least=2).select("rank", "ordinal", "skipped")


def marker_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "events")
    return ledger.marker_groups(rows, F.col("event_type") == "signup", ["user_id"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_id", F.col("grp").cast("long").alias("grp"))


def ledger_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "events").select("user_id", "event_id", "ts", F.col("event_type").alias("status"))
    return ledger.latest(rows, ["user_id"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_id", "status")


def retry_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger_latest(spark, sf_dir).filter("status <> 'purchase'")


def ledger_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "regionkey")
    return gates.digest(rows, F.to_json(F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))), F.col("n_nationkey"), ["regionkey"])


def gate_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "documents").join(_table(spark, sf_dir, "labels"), "doc_id")
    gate = F.when(F.col("doc_id") % 2 == 0, "even").otherwise("odd")
    evidence = rows.groupBy(F.col("source").alias("rank"), gate.alias("gate")).agg(
        F.when(F.min(F.col("quality") == 1), "PASS").otherwise("FAIL").alias("state"), F.max(F.col("toxic") == 0).alias("bound")
    )
    return gates.rolled_up(evidence, ["even", "odd"]).select("rank", "n_passed", "state")


def ngram_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = similarity.token_grams(_table(spark, sf_dir, "documents"), "doc_id", T.tokens(_text()), 5)
    items = similarity.token_grams(_table(spark, sf_dir, "benchmark"), "item_id", T.tokens(_text()), 5)
    return similarity.shared_grams(docs, items, "doc_id", "item_id")


def _with_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their tokens, which are cut once for all that is asked of them."""
    return _table(spark, sf_dir, "documents").select("doc_id", "text", T.tokens(_text()).alias("t"))


def word_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_tokens(spark, sf_dir).select("doc_id", F.size("t").cast("long").alias("tokens"), F.size(F.array_distinct("t")).cast("long").alias("distinct_tokens"))


def function_word_residue(spark: SparkSession, sf_dir: str) -> DataFrame:
    languages = ("en", "fr", "de")
    # nothing but function words is counted, so only they are folded and gone through for each language
    words = {w for x in ("it", *languages) for w in D.function_words(x)}
    rows = _table(spark, sf_dir, "documents").select("doc_id", "text", T.tokens_among(_text(), words).alias("t"))
    return rows.select("doc_id", *[D.source_residue(_text(), F.col("t"), x).alias(x) for x in languages])


def link_scrape(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = pages.sources_of(F.col("html"), "href")
    return _table(spark, sf_dir, "pages").select("page_id", F.size(links).cast("long").alias("n_links"), F.array_join(links, ",").alias("links"))


def resume_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pairs(spark, sf_dir).withColumn("id", F.col("rank") * 1000 + F.col("ordinal"))
    # every ninth rank is there under other ids
    before = rows.select((F.col("id") + F.when(F.col("rank") % 9 == 0, 500).otherwise(0)).alias("id"), T.sha(F.col("source")).alias("source_sha256"))
    changed = F.when(F.col("ordinal") % 4 == 1, F.concat(F.trim("source"), F.lit("."))).otherwise(F.col("source"))
    return ledger.resumable(before, rows.select("id", T.sha(changed).alias("source_sha256")))


def shard_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.shard_plan(_table(spark, sf_dir, "documents"), 64, "source")


def shard_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = ledger.shard_jobs(ledger.shard_plan(_table(spark, sf_dir, "documents"), 8, "source"))
    return jobs.select("source", "shard", T.padded(F.col("shard"), 4).alias("shard_padded"))


def unchanged_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, t = _sides()
    return pairs(spark, sf_dir).select("rank", "ordinal", similarity.unchanged_similarity(s, t, F.col("kind")).alias("similarity"), similarity.repeated_span(t).alias("repeated"))


def like_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs, every third of which was left as it was but for a few words."""
    left = F.concat(F.lit("And so "), F.substring("source", F.lit(1), F.length("source") - 5))
    return pairs(spark, sf_dir).withColumn("translation", F.when((F.col("rank") + F.col("ordinal")) % 3 == 0, left).otherwise(F.col("translation")))


def repair_flags_en(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags of English sources, for which texts that were left untranslated are told by their likeness."""
    rows, forms = D.prepared(like_pairs(spark, sf_dir))
    flags = selection.repair_flags(F.col("source"), F.col("translation"), F.col("kind"), "en", forms)
    return rows.select("rank", "ordinal", F.array_join(flags, ",").alias("flags"))


def repeated_adjacent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir).select("rank", "ordinal", similarity.repeated_adjacent(T.tokens(F.col("translation"))).alias("r")).select("rank", "ordinal", "r.*")


def collapse_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir).select("rank", "ordinal", similarity.collapsed(*_sides()).alias("translation"))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, found = F.col("text"), F.col("_sentences")
    return _table(spark, sf_dir, "documents").withColumn("_sentences", T.sentences(x)).select(
        "doc_id",
        F.size(P.split_long_block(x, found=found)).alias("blocks"),
        F.size(P.atomic_segments(x, found=found)).alias("atoms"),
        F.size(P.bounded_segments(x, 110)).alias("bounded"),
        F.size(P.source_segments(x)).alias("chunks"),
        F.size(P.source_segments_by_word(x)).alias("chunks_by_word"),
    )


def page_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _titles(spark, sf_dir).select("page_id", F.lit(1).alias("place"), "title", pages.clean_blocks(F.col("html")).alias("blocks"))
    return pages.page_units(rows, "page_id", "place")


def tfidf_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pairs(spark, sf_dir)
    n = F.count("*").over(Window.partitionBy("rank"))
    shared = [F.col("rank").alias("chapter"), F.col("ordinal").cast("string").alias("key")]
    anchors = rows.select(*shared, F.col("translation").alias("text"), (F.col("ordinal") / n).alias("fraction"))
    paragraphs = rows.select(*shared, F.col("source").alias("text"), (F.col("ordinal") / n).alias("fraction"))
    return similarity.aligned(anchors, paragraphs).withColumn("similarity", F.round("similarity", 6))


def translate_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut into pieces, through a translator that changes nothing, and put together again."""
    units = _table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("source"))
    return translate.translated(units, ["doc_id"], [translate.echo]).select("doc_id", T.sha(T.known(F.col("translation"))).alias("translation_sha256"))


def bin_pack_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.parts(_table(spark, sf_dir, "documents"), "source", "doc_id", "n_chars", 50_000)


def incremental_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream of ledger records; the last state of each user when all have been read."""
    place = f"{shared_folder(spark)}/overlay-{uuid.uuid4().hex}"
    schema = _table(spark, sf_dir, "events").schema.simpleString()[len("struct<") : -1].replace(":", " ")
    stream = record_stream(spark, f"{sf_dir}/events*.parquet", schema)
    records = stream.select("user_id", "ts", "event_id", "event_type")
    query = overlay(records, f"{place}/state", f"{place}/checkpoint", ["user_id"], ["ts", "event_id"])
    query.awaitTermination()
    last = query.lastProgress["batchId"] if query.lastProgress else 0
    return state(spark, f"{place}/state", last, records.schema).select("user_id", "event_id", F.col("event_type").alias("status"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        pair_flags, flag_counts, hard_flags_targeted, release_status, length_ratio_qa, duplicate_half, token_length_anomaly, unit_extract, sentence_stats,
        assemble_units, missing_units, overlay_corrections, override_violations, fallback_coalesce, longest_ledger, conflict_units, duplicate_keys,
        roster_partition, prefix_children, terminal_pages, natural_title_order, best_candidate, source_scoring, end_marker_skip, marker_groups,
        ledger_latest, retry_pending, ledger_digest, gate_rollup, ngram_copy, link_scrape, resume_check, shard_plan, shard_jobs, unchanged_similarity, repair_flags_en,
        word_tokens, function_word_residue, repeated_adjacent, collapse_repeats, segments, page_units, tfidf_align, translate_roundtrip, bin_pack_parts, incremental_overlay,
    )
} | {
    "normalized_key": _documents(lambda: T.sha(T.normalized(_text())).alias("key")),
    "adjacent_repeat": _documents(lambda: D.adjacent_repeat(_text()).alias("repeats")),
    "halves_repeat": _documents(lambda: D.halves_repeat(_text()).alias("repeats")),
    "script_spillover": _documents(lambda: D.script_count(_text(), "ru").cast("long").alias("cyrillic"), lambda: D.script_count(_text(), "el").cast("long").alias("greek")),
    "boilerplate_cues": _documents(lambda: D.boilerplate(_text()).alias("cue")),
    "decoder_loop": _documents(lambda: D.decoder_loop(_text()).alias("loop"), lambda: D.word_five_times(_text()).alias("word_loop")),
    "modern_intrusion": _pairs(lambda: D.modern_intrusion(*_sides()).alias("modern")),
    "hash_binding": _pairs(lambda: T.sha(F.col("source")).alias("source_sha256"), lambda: T.sha(F.col("translation")).alias("translation_sha256")),
    "post_failures": _pairs(lambda: F.array_join(D.post_failures(*_sides(), "en"), ",").alias("failures")),
}
