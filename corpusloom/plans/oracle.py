"""The queries' twins in DuckDB's SQL, from fragments that mirror the Column builders."""

from __future__ import annotations

from corpusloom.functions.detectors import BOILERPLATE, END_MARKERS, MODERN, function_words
from corpusloom.functions.text import BOUNDARY, MASK, NOT_WORD, TOKEN
from corpusloom.operators.pages import ORDINAL_WORDS


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def fold(x: str) -> str:
    return f"replace(replace(lower({x}), 'ß', 'ss'), 'ς', 'σ')"


def known(x: str) -> str:
    return f"coalesce({x}, '')"


def stripped(x: str) -> str:
    return f"regexp_replace({x}, {q(chr(94) + '[' + chr(92) + 's' + chr(92) + 'x{00a0}]+|[' + chr(92) + 's' + chr(92) + 'x{00a0}]+$')}, '', 'g')"


def normalized(x: str) -> str:
    return f"trim(regexp_replace({fold(x)}, {q(NOT_WORD)}, ' ', 'g'))"


def squeezed(x: str) -> str:
    return f"regexp_replace({fold(x)}, {q(NOT_WORD)}, '', 'g')"


def sentences(x: str) -> str:
    mask = f"regexp_replace({stripped(x)}, {q(MASK)}, '\\1\\2' || chr(2), 'g')"
    mask = f"regexp_replace({mask}, {q(MASK)}, '\\1\\2' || chr(2), 'g')"
    cut = f"regexp_replace({mask}, {q(BOUNDARY)}, '\\1' || chr(1) || '\\2', 'g')"
    return f"list_filter(list_transform(string_split({cut}, chr(1)), lambda s: {stripped('replace(s, chr(2), chr(46))')}), lambda s: s <> '')"


def tokens(x: str) -> str:
    return f"list_transform(regexp_extract_all({x}, {q(TOKEN)}), lambda t: replace({fold('t')}, '’', chr(39)))"


def ratio(s: str, t: str) -> str:
    return f"(length({known(t)})::DOUBLE / greatest(1, length({known(s)})))"


def omission(s: str, t: str) -> str:
    a, b = f"len({sentences(known(s))})", f"len({sentences(known(t))})"
    return f"(length({known(s)}) >= 90 AND (({a} >= 2 AND {b} < {a}) OR {ratio(s, t)} < 0.62::DOUBLE))"


def adjacent_repeat(t: str) -> str:
    norm = f"list_transform({sentences(known(t))}, lambda s: {normalized('s')})"
    return f"(len(list_filter(list_zip(({norm})[1:-2], ({norm})[2:]), lambda z: z[1] = z[2] AND length(z[2]) > 35)) > 0)"


def halves_repeat(t: str) -> str:
    c = stripped(f"regexp_replace({known(t)}, {q('[' + chr(92) + 's' + chr(92) + 'x{00a0}]+')}, ' ', 'g')")
    left, right = squeezed(f"substring({c}, 1, length({c}) // 2)"), squeezed(f"substring({c}, length({c}) // 2 + 1)")
    return f"(length({c}) > 100 AND {left} <> '' AND {left} = {right})"


def repetition(s: str, t: str) -> str:
    return f"({adjacent_repeat(t)} OR {halves_repeat(t)} OR {ratio(s, t)} > 1.75::DOUBLE)"


def named(*flags: tuple[str, str]) -> str:
    """Names of the flags that hold, with commas."""
    return "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {cond} THEN {q(name)} END" for name, cond in flags) + "], lambda f: f IS NOT NULL), ',')"


def empty(t: str) -> str:
    return f"({stripped(known(t))} = '')"


def sentence_seen_before(t: str) -> str:
    long = f"list_filter(list_transform({sentences(known(t))}, lambda s: {normalized('s')}), lambda s: length(s) >= 35)"
    return f"(len(list_distinct({long})) < len({long}))"


def hard_flags_repair(s: str, t: str) -> str:
    r = ratio(s, t)
    return named(("empty", empty(t)), ("severe_length_anomaly", f"length({known(s)}) >= 90 AND ({r} < 0.30::DOUBLE OR {r} > 2.75::DOUBLE)"), ("decoder_repetition", sentence_seen_before(t)))


def hard_flags_targeted(s: str, t: str) -> str:
    a, b = f"length({stripped(known(s))})", f"length({stripped(known(t))})"
    r = f"({b}::DOUBLE / greatest(1, {a}))"
    return named(
        ("empty_target", f"{b} = 0"),
        ("cyrillic_spillover", f"regexp_matches({known(t)}, '[\\x{{0400}}-\\x{{04ff}}]')"),
        ("greek_spillover", f"regexp_matches({known(t)}, '[\\x{{0370}}-\\x{{03ff}}]')"),
        ("long_digit_run", f"regexp_matches({known(t)}, '\\d{{7,}}')"),
        ("severe_underlength", f"{a} >= 20 AND {r} < 0.18::DOUBLE"),
        ("severe_overlength", f"{a} >= 20 AND {r} > 2.40::DOUBLE"),
    )


def duplicate_half(s: str, t: str) -> str:
    def halved(x: str) -> str:
        return f"(len({x}) % 2 = 0 AND ({x})[1:len({x}) // 2] = ({x})[len({x}) // 2 + 1:])"

    return f"(len({t}) >= 4 AND {halved(t)} AND NOT {halved(s)})"


def residue(text: str, t: str, language: str) -> str:
    own, other = (f"[{', '.join(map(q, function_words(x)))}]" for x in ("it", language))
    ours = f"len(list_filter({t}, lambda w: list_contains({own}, w)))"
    theirs = f"len(list_filter({t}, lambda w: list_contains({other}, w) AND NOT list_contains({own}, w)))"
    return f"(regexp_matches({text}, '[А-Яа-яЁёΑ-ωΆ-ώ]') OR ({theirs} >= 4 AND {theirs} > {ours}))"


PAIRS = """pairs AS (
  SELECT conv_id AS rank, turn AS ordinal, role AS kind, text AS source,
    lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS translation, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS following
  FROM conversations
), bound AS (SELECT * FROM pairs WHERE following IS NOT NULL)"""


def pairs(select: str) -> str:
    return f"WITH {PAIRS} SELECT {select} FROM bound"


def roman_of(signs: str) -> str:
    """The value of signs from the right: one below the largest so far is taken off."""
    return f"list_sum(list_transform({signs}, lambda v, i: CASE WHEN i > 1 AND v < list_max(({signs})[1:i - 1]) THEN -v ELSE v END))::BIGINT"


def number_of(leaf: str) -> str:
    words = " ".join(f"WHEN regexp_matches({leaf}, {q('(^|[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}_])' + w + '($|[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}_])')}) THEN {v}" for w, v in ORDINAL_WORDS)
    digits = f"regexp_extract({leaf}, '\\d+')"
    signs = f"list_transform(string_split(reverse({leaf}), ''), lambda c: CASE c WHEN 'i' THEN 1 WHEN 'v' THEN 5 WHEN 'x' THEN 10 WHEN 'l' THEN 50 WHEN 'c' THEN 100 WHEN 'd' THEN 500 ELSE 1000 END)"
    roman = f"CASE WHEN regexp_full_match({leaf}, '[ivxlcdm]+') THEN {roman_of(signs)} END"
    return f"coalesce(CASE {words} END, {roman}, CASE WHEN {digits} <> '' THEN try_cast({digits} AS BIGINT) END)"


S, T = "source", "translation"
DOC_UNITS = f"""WITH blocks AS (
  SELECT doc_id, b.i AS block, string_split(text, chr(10))[b.i] AS body FROM documents, LATERAL (SELECT unnest(generate_series(1, len(string_split(text, chr(10))))) AS i) b
), pieces AS (
  SELECT doc_id, block, length({stripped('body')}) AS size, p.i AS piece, ({sentences('body')})[p.i] AS source FROM blocks, LATERAL (SELECT unnest(generate_series(1, len({sentences('body')}))) AS i) p
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY block, piece) AS ordinal FROM pieces
) """

ORACLES = {
    "pair_flags": pairs(
        f"rank, ordinal, {named(('empty', empty(T)), ('omission', omission(S, T)), ('repetition', repetition(S, T)))} AS flags, {hard_flags_repair(S, T)} AS hard_flags, round({ratio(S, T)}, 6) AS length_ratio"
    ),
    "flag_counts": f"WITH {PAIRS}, f AS (SELECT rank, unnest(string_split({named(('empty', empty(T)), ('omission', omission(S, T)), ('repetition', repetition(S, T)))}, ',')) AS flag FROM bound) SELECT rank, flag, count(*) AS n FROM f WHERE flag <> '' GROUP BY rank, flag",
    "hard_flags_targeted": pairs(f"rank, ordinal, {hard_flags_targeted(S, T)} AS flags"),
    "release_status": f"WITH {PAIRS}, f AS (SELECT rank, {omission(S, T)} OR {repetition(S, T)} AS flagged, {hard_flags_repair(S, T)} <> '' AS hard FROM bound) SELECT rank, count(*) AS units, sum(flagged::INT)::BIGINT AS flagged, sum(hard::INT)::BIGINT AS hard, CASE WHEN sum(hard::INT) > 0 THEN 'FAIL' WHEN sum(flagged::INT) > 0 THEN 'REVIEW_REQUIRED' ELSE 'PASS' END AS status FROM f GROUP BY rank",
    "length_ratio_qa": f"WITH {PAIRS}, f AS (SELECT rank, sum(length(source))::BIGINT AS source_chars, sum(length(translation))::BIGINT AS target_chars, sum(CASE WHEN {empty(T)} THEN 1 ELSE 0 END)::BIGINT AS empty_units FROM bound GROUP BY rank) SELECT *, round(target_chars::DOUBLE / greatest(1, source_chars), 6) AS length_ratio, (target_chars::DOUBLE / greatest(1, source_chars)) BETWEEN 0.55::DOUBLE AND 1.65::DOUBLE AND empty_units = 0 AS passed FROM f",
    "duplicate_half": f"WITH {PAIRS}, t AS (SELECT rank, ordinal, {tokens(S)} AS s, {tokens(T)} AS t FROM bound) SELECT rank, ordinal, len(s) AS source_tokens, len(t) AS target_tokens, {duplicate_half('s', 't')} AS duplicate FROM t",
    "token_length_anomaly": f"WITH {PAIRS}, t AS (SELECT rank, ordinal, len({tokens(S)}) AS s, len({tokens(T)}) AS t FROM bound) SELECT rank, ordinal, s >= 8 AND (t::DOUBLE / greatest(1, s) > 2.5 OR t::DOUBLE / greatest(1, s) < 0.35::DOUBLE) AS anomaly FROM t",
    "unit_extract": DOC_UNITS
    + "SELECT doc_id, ordinal, 'c01-u' || lpad(ordinal::VARCHAR, greatest(4, length(ordinal::VARCHAR))::INT, '0') AS unit_id, CASE WHEN piece > 1 THEN 'continuation' WHEN ordinal <= 3 AND size < 140 THEN 'heading' ELSE 'paragraph' END AS kind, sha256(source) AS source_sha256 FROM numbered",
    "sentence_stats": f"SELECT lang, count(*) AS docs, sum(len({sentences(known('text'))}))::BIGINT AS sentences, sum(length(text))::BIGINT AS chars FROM documents GROUP BY lang",
    "normalized_key": f"SELECT doc_id, sha256({normalized('text')}) AS key FROM documents",
    "word_tokens": f"SELECT doc_id, len({tokens('text')}) AS tokens, len(list_distinct({tokens('text')})) AS distinct_tokens FROM documents",
    "adjacent_repeat": f"SELECT doc_id, {adjacent_repeat('text')} AS repeats FROM documents",
    "halves_repeat": f"SELECT doc_id, {halves_repeat('text')} AS repeats FROM documents",
    "script_spillover": "SELECT doc_id, len(regexp_extract_all(text, '[\\x{0400}-\\x{052f}]')) AS cyrillic, len(regexp_extract_all(text, '[\\x{0370}-\\x{03ff}\\x{1f00}-\\x{1fff}]')) AS greek FROM documents",
    "function_word_residue": f"WITH t AS (SELECT doc_id, text, {tokens('text')} AS t FROM documents) SELECT doc_id, {residue('text', 't', 'en')} AS en, {residue('text', 't', 'fr')} AS fr, {residue('text', 't', 'de')} AS de FROM t",
    "boilerplate_cues": f"SELECT doc_id, regexp_matches(text, {q('(?i)' + '|'.join(BOILERPLATE))}) AS cue FROM documents",
    "modern_intrusion": pairs(f"rank, ordinal, regexp_matches(translation, {q(MODERN)}) AND NOT regexp_matches(source, {q(MODERN)}) AS modern"),
    "hash_binding": f"WITH {PAIRS} SELECT rank, ordinal, sha256(source) AS source_sha256, sha256(translation) AS translation_sha256 FROM bound",
    "shard_plan": "SELECT source, count(*) AS unit_count, 64 AS shard_size, ceil(count(*) / 64.0)::INT AS shard_count FROM documents GROUP BY source",
    "shard_jobs": "WITH p AS (SELECT source, ceil(count(*) / 8.0)::INT AS n FROM documents GROUP BY source) SELECT source, s.shard::INT AS shard, lpad(s.shard::VARCHAR, greatest(4, length(s.shard::VARCHAR))::INT, '0') AS shard_padded FROM p, LATERAL (SELECT unnest(generate_series(0, n - 1)) AS shard) s",
    "assemble_units": f"WITH {PAIRS}, r AS (SELECT rank, ordinal, sha256(CASE WHEN ordinal % 7 = 0 OR rank % 5 = 0 THEN source || '!' ELSE source END) AS h, translation FROM bound) SELECT b.rank, b.ordinal, r.translation IS NOT NULL AS found, sha256(coalesce(r.translation, '')) AS translation_sha256 FROM bound b LEFT JOIN r ON b.rank = r.rank AND b.ordinal = r.ordinal AND sha256(b.source) = r.h",
    "missing_units": f"WITH {PAIRS}, r AS (SELECT rank, ordinal, sha256(CASE WHEN ordinal % 7 = 0 OR rank % 5 = 0 THEN source || '!' ELSE source END) AS h FROM bound) SELECT b.rank, b.ordinal FROM bound b WHERE NOT EXISTS (SELECT 1 FROM r WHERE b.rank = r.rank AND b.ordinal = r.ordinal AND sha256(b.source) = r.h)",
    "overlay_corrections": f"WITH {PAIRS}, c AS (SELECT rank, ordinal, CASE WHEN ordinal % 2 = 0 AND rank % 3 = 0 THEN sha256(source) ELSE sha256('old' || source) END AS h, 'new ' || translation AS t FROM bound) SELECT b.rank, b.ordinal, c.h IS NOT NULL AND c.h = sha256(b.source) AS corrected, sha256(CASE WHEN c.h = sha256(b.source) THEN c.t ELSE b.translation END) AS translation_sha256 FROM bound b LEFT JOIN c ON b.rank = c.rank AND b.ordinal = c.ordinal",
    "override_violations": f"WITH {PAIRS}, o AS (SELECT rank, ordinal, sha256(CASE WHEN ordinal % 3 = 0 THEN source || ' ' ELSE source END) AS h FROM bound UNION ALL SELECT rank, ordinal - ordinal % 2, sha256(source) FROM bound UNION ALL SELECT rank, ordinal + 1000, sha256(source) FROM bound), j AS (SELECT o.*, b.source FROM o LEFT JOIN bound b ON o.rank = b.rank AND o.ordinal = b.ordinal) SELECT rank, ordinal, 'source_changed' AS violation FROM j WHERE source IS NOT NULL AND sha256(source) <> h UNION ALL SELECT rank, ordinal, 'unit_missing' FROM j WHERE source IS NULL UNION ALL SELECT rank, ordinal, 'duplicate_override' FROM o GROUP BY rank, ordinal HAVING count(*) > 1",
    "fallback_coalesce": "WITH p AS (SELECT o_custkey AS rank, o_orderkey AS unit FROM orders WHERE o_orderstatus = 'F') SELECT rank, count(*) AS units, min(origin) AS origin FROM (SELECT rank, unit, 'primary' AS origin FROM p UNION ALL SELECT o_custkey, o_orderkey, 'fallback' FROM orders WHERE o_orderstatus <> 'F' AND o_custkey NOT IN (SELECT rank FROM p)) GROUP BY rank",
    "longest_ledger": "WITH c AS (SELECT l_suppkey AS rank, l_returnflag AS path, count(*) AS n FROM lineitem GROUP BY 1, 2), b AS (SELECT *, row_number() OVER (PARTITION BY rank ORDER BY n DESC, path) AS r FROM c) SELECT rank, path, n AS units FROM b WHERE r = 1",
    "conflict_units": "SELECT l_orderkey AS rank, l_suppkey AS unit_id, count(DISTINCT l_returnflag) AS n_translations FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT l_returnflag) > 1",
    "duplicate_keys": "SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "roster_partition": "WITH s AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority LIKE '1%'), x AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority LIKE '5%'), a AS (SELECT c_custkey AS k FROM customer) SELECT k AS c_custkey, 'in_both' AS violation FROM s WHERE k IN (SELECT k FROM x) UNION ALL SELECT k, 'in_none' FROM a WHERE k NOT IN (SELECT k FROM s UNION ALL SELECT k FROM x) UNION ALL SELECT k, 'unknown' FROM (SELECT k FROM s UNION SELECT k FROM x) WHERE k NOT IN (SELECT k FROM a)",
    "prefix_children": "WITH t AS (SELECT DISTINCT regexp_replace(url, '^https?://', '') AS title FROM pages), p AS (SELECT title, regexp_extract(title, '^(.*)/[^/]+$', 1) AS parent FROM t) SELECT parent, title FROM p WHERE parent <> '' AND parent IN (SELECT regexp_extract(regexp_replace(url, '^https?://', ''), '^(.*)/[^/]+$', 1) FROM pages)",
    "terminal_pages": "WITH t AS (SELECT DISTINCT regexp_replace(url, '^https?://', '') AS title FROM pages UNION SELECT DISTINCT regexp_extract(regexp_replace(url, '^https?://', ''), '^[^/]+', 0) FROM pages) SELECT title FROM t WHERE NOT EXISTS (SELECT 1 FROM t b WHERE starts_with(b.title, t.title || '/'))",
    "natural_title_order": f"WITH t AS (SELECT page_id, regexp_extract(url, '[^/]*$') AS leaf, regexp_extract(regexp_replace(url, '^https?://', ''), '^[^/]+', 0) AS host, url FROM pages) SELECT page_id, row_number() OVER (PARTITION BY host ORDER BY {number_of('lower(leaf)')} ASC NULLS LAST, lower(leaf), url, page_id) AS place FROM t",
    "best_candidate": f"WITH {PAIRS}, c AS (SELECT rank, ordinal, kind, source, 0 AS cand, translation AS t FROM bound UNION ALL SELECT rank, ordinal, kind, source, 1, substring(translation, 1, length(translation) // 2) FROM bound UNION ALL SELECT rank, ordinal, kind, source, 2, translation || ' ' || translation FROM bound), s AS (SELECT rank, ordinal, cand, CASE WHEN {empty('t')} THEN 1000000.0::DOUBLE ELSE CASE WHEN {omission(S, 't')} OR {repetition(S, 't')} THEN 1200.0::DOUBLE ELSE 0 END + CASE WHEN {ratio(S, 't')} < 0.48::DOUBLE THEN (0.48::DOUBLE - {ratio(S, 't')}) * 1500 ELSE 0 END + CASE WHEN {ratio(S, 't')} > 1.85::DOUBLE THEN ({ratio(S, 't')} - 1.85::DOUBLE) * 900 ELSE 0 END END AS score, {hard_flags_repair(S, 't')} = '' AS clear FROM c), r AS (SELECT *, row_number() OVER (PARTITION BY rank, ordinal ORDER BY clear DESC, score, cand) AS n FROM s) SELECT rank, ordinal, cand AS candidate, clear, round(score, 6) AS score FROM r WHERE n = 1",
    "source_scoring": "WITH a AS (SELECT s_suppkey, list_filter(regexp_extract_all(lower(s_name), '[\\p{L}\\p{N}_]+'), lambda w: length(w) > 3) AS w FROM supplier), p AS (SELECT p_partkey, lower(p_name) AS title, p_brand, p_retailprice FROM part), s AS (SELECT p_partkey, p_retailprice, CASE WHEN p_brand LIKE '%1' THEN 8 ELSE 0 END + len(list_filter(regexp_extract_all('part name special', '[\\p{L}\\p{N}_]+'), lambda w: length(w) > 3 AND contains(title, w))) AS score FROM p), r AS (SELECT *, row_number() OVER (ORDER BY score DESC, p_retailprice DESC, p_partkey) AS place FROM s) SELECT p_partkey, score, place FROM r WHERE place <= 12",
    "end_marker_skip": f"WITH t AS (SELECT conv_id AS rank, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS ordinal, text FROM conversations), m AS (SELECT *, array_to_string({tokens('text')}, ' ') AS words FROM t), l AS (SELECT *, max(CASE WHEN words IN ({', '.join(map(q, END_MARKERS))}) OR ordinal = 2 THEN ordinal END) OVER (PARTITION BY rank) AS last FROM m), c AS (SELECT *, bool_or(ordinal > last AND length(text) % 2 = 0) OVER (PARTITION BY rank) AS tail FROM l) SELECT rank, ordinal, coalesce(last >= 2 AND tail AND ordinal > last, false) AS skipped FROM c",
    "marker_groups": "SELECT user_id, event_id, greatest(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 1)::BIGINT AS grp FROM events",
    "ledger_latest": "WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) SELECT user_id, event_id, event_type AS status FROM r WHERE n = 1",
    "retry_pending": "WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) SELECT user_id, event_id, event_type AS status FROM r WHERE n = 1 AND event_type <> 'purchase'",
    "ledger_digest": "SELECT n_regionkey AS regionkey, sha256('[' || string_agg('{\"key\":' || n_nationkey || ',\"name\":\"' || n_name || '\"}', ',' ORDER BY n_nationkey) || ']') AS ledger_sha256 FROM nation GROUP BY n_regionkey",
    "gate_rollup": "WITH e AS (SELECT d.source AS rank, CASE WHEN l.quality = 1 THEN 'PASS' ELSE 'FAIL' END AS state, l.toxic = 0 AS bound, CASE WHEN d.doc_id % 2 = 0 THEN 'even' ELSE 'odd' END AS gate FROM documents d JOIN labels l USING (doc_id)), g AS (SELECT rank, gate, CASE WHEN bool_and(state = 'PASS') THEN 'PASS' ELSE 'FAIL' END AS state, bool_or(bound) AS bound FROM e GROUP BY rank, gate) SELECT rank, count(DISTINCT CASE WHEN state = 'PASS' AND bound THEN gate END) AS n_passed, CASE WHEN bool_and(state = 'PASS' AND bound) AND count(DISTINCT CASE WHEN state = 'PASS' AND bound THEN gate END) = 2 THEN 'PASS' ELSE 'FAIL' END AS state FROM g GROUP BY rank",
    "ngram_copy": f"WITH d AS (SELECT doc_id AS id, {tokens('text')} AS t FROM documents), b AS (SELECT item_id AS id, {tokens('text')} AS t FROM benchmark), dg AS (SELECT DISTINCT id, array_to_string(t[i:i + 4], ' ') AS g FROM d, LATERAL (SELECT unnest(generate_series(1, len(t) - 4)) AS i) s), bg AS (SELECT DISTINCT id, array_to_string(t[i:i + 4], ' ') AS g FROM b, LATERAL (SELECT unnest(generate_series(1, len(t) - 4)) AS i) s) SELECT dg.id AS doc_id, bg.id AS item_id, count(*) AS grams FROM dg JOIN bg USING (g) GROUP BY 1, 2",
    "link_scrape": "SELECT page_id, len(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS n_links, array_to_string(list_distinct_ordered, ',') AS links FROM (SELECT page_id, html, regexp_extract_all(html, 'href=\"([^\"]*)\"', 1) AS list_distinct_ordered FROM pages)",
    "translate_roundtrip": f"WITH c AS (SELECT doc_id, regexp_replace({stripped('text')}, '[ \\t]+', ' ', 'g') AS t FROM documents) SELECT doc_id, sha256(CASE WHEN length(t) <= 700 THEN t ELSE trim(regexp_replace(t, '\\s+', ' ', 'g')) END) AS translation_sha256 FROM c",
    "resume_check": f"WITH {PAIRS}, a AS (SELECT rank * 1000 + ordinal + CASE WHEN rank % 9 = 0 THEN 500 ELSE 0 END AS id, sha256(source) AS h FROM bound), b AS (SELECT rank * 1000 + ordinal AS id, sha256(CASE WHEN ordinal % 4 = 1 THEN trim(source) || '.' ELSE source END) AS h FROM bound) SELECT coalesce(a.id, b.id) AS id FROM a FULL JOIN b ON a.id = b.id WHERE a.h IS DISTINCT FROM b.h",
}
