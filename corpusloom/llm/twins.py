"""Operators written out in DuckDB's SQL, by their definitions: every pair, every shingle, every window of bytes."""

from __future__ import annotations

#: Groups of links (u, w), both ways, of all rows of ``nodes`` (id): (id, c) with the least id that each one reaches.
_REACH = """reach AS (SELECT id, id AS r FROM nodes UNION SELECT reach.id, links.w FROM reach JOIN links ON links.u = reach.r),
groups AS (SELECT id, min(r) AS c FROM reach GROUP BY id)"""

COVER_TREE = f"""WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
sound AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS u, b.vec_id AS w FROM sound a JOIN sound b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.95::DOUBLE),
nodes AS (SELECT vec_id AS id FROM v), {_REACH}
SELECT vec_id, (SELECT count(*) FROM links WHERE u = vec_id) AS n_links, c AS component_id, vec_id = c AS kept FROM v JOIN groups ON id = vec_id"""

JACCARD = f"""WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS t FROM documents),
shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(t) = 0 THEN [] WHEN len(t) < 5 THEN [array_to_string(t, ' ')] ELSE list_transform(generate_series(1, len(t) - 4), lambda i: array_to_string(t[i:i + 4], ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS u, b.doc_id AS w, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT u, w FROM common JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = w WHERE 100 * c >= 80 * (x.n + y.n - c)),
nodes AS (SELECT doc_id AS id FROM documents), {_REACH}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c AS component_id, (SELECT count(*) FROM links WHERE u = d.doc_id) AS n_links
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN groups ON id = d.doc_id"""

#: Bytes are pairs of hexadecimal digits. A text is cut into blocks first, as a substring of a long text is slow.
REPEATS = """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
blocks AS (SELECT doc_id, b * 1024 AS start, substring(h, b * 2048 + 1, 2048 + 98) AS part FROM (SELECT doc_id, h, unnest(generate_series(0, greatest(0, length(h) // 2 - 50) // 1024)) AS b FROM d)),
places AS (SELECT doc_id, start, part, unnest(generate_series(0, least(1023, length(part) // 2 - 50))) AS i FROM blocks),
windows AS (SELECT doc_id, start + i AS pos, hash(substring(part, 2 * i + 1, 100)) AS w FROM places),
first AS (SELECT w, min(doc_id) AS least FROM windows GROUP BY w),
gone AS (SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM windows JOIN first USING (w) WHERE least < doc_id),
runs AS (SELECT doc_id, pos, sum(CASE WHEN before IS NULL OR pos > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM gone),
spans AS (SELECT doc_id, min(pos) AS a, max(pos) + 50 AS b FROM runs GROUP BY doc_id, run),
cuts AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS since FROM spans),
pieces AS (SELECT cuts.doc_id, since, substring(h, 2 * since + 1, 2 * (a - since)) AS piece FROM cuts JOIN d USING (doc_id)
  UNION ALL SELECT d.doc_id, coalesce(last, 0), substring(h, 2 * coalesce(last, 0) + 1) FROM d LEFT JOIN (SELECT doc_id, max(b) AS last FROM spans GROUP BY doc_id) USING (doc_id)),
kept AS (SELECT doc_id, string_agg(piece, '' ORDER BY since) AS k FROM pieces GROUP BY doc_id),
sums AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS n FROM spans GROUP BY doc_id)
SELECT d.doc_id, length(h) // 2 AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(n, 0) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)"""
