"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"
_WORDS10 = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP10 = f"""
WITH d AS (SELECT doc_id, {_WORDS10} AS w FROM documents),
i AS (SELECT item_id, {_WORDS10} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, len(g) AS n, g FROM (
  SELECT item_id, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda k: w[k:k+9])) AS g FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, k, w[k:k+n-1] AS g FROM (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT doc_id, k, dw.n, item_id FROM dw JOIN iw USING (g)),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS pos FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""

_WORDS9 = rf"regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+')"

OP9 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS9} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
    ELSE list_transform(range(1, len(w) - 3), lambda k: w[k:k+4]) END) AS g FROM d)),
n AS (SELECT d.doc_id, count(s.g) AS n FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT doc_id, doc_id AS c FROM n UNION SELECT e.b, reach.c FROM reach JOIN e ON e.a = reach.doc_id)
SELECT n.doc_id, n.n AS n_shingles, min(reach.c) AS component_id, n.doc_id = min(reach.c) AS kept
FROM n JOIN reach ON reach.doc_id = n.doc_id GROUP BY n.doc_id, n.n
"""

OP11 = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS alike, b.vec_id AS id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id IS DISTINCT FROM b.vec_id AND len(a.q) = len(b.q)),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

OP12 = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT r, k, md5(b[k:k + 399]) AS h FROM (SELECT r, b, unnest(range(1, n - 398)) AS k FROM d WHERE n >= 400)),
m AS (
  SELECT r, k, coalesce(k > lag(k) OVER (PARTITION BY r ORDER BY k) + 400, true) AS new
  FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
spans AS (
  SELECT r, j, min(k) AS a, max(k) + 400 AS z FROM (SELECT r, k, sum(new::INT) OVER (PARTITION BY r ORDER BY k) AS j FROM m) GROUP BY r, j),
gaps AS (
  SELECT r, j, coalesce(lag(z) OVER (PARTITION BY r ORDER BY j), 1) AS a, a AS z FROM spans
  UNION ALL SELECT r, max(j) + 1, max(z), max(n) + 1 FROM spans JOIN d USING (r) GROUP BY r),
rest AS (
  SELECT r, string_agg(substr(hex(b), 2 * g.a - 1, 2 * (g.z - g.a)), '' ORDER BY j) AS kept FROM gaps g JOIN d USING (r) GROUP BY r),
lost AS (SELECT r, sum(z - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, coalesce(sha256(unhex(kept)), sha256(b)) AS kept_sha256
FROM d LEFT JOIN lost USING (r) LEFT JOIN rest USING (r)
"""

ORACLE = {"op9_odd_sketch": OP9, "op10_decontamination": OP10, "op11_anchor_tree": OP11, "op12_induced_dedup": OP12}
