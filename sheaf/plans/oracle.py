"""DuckDB oracle SQL for the registered queries.

Each statement is an independent formulation over the plain tables (the
Spark side parses text it formatted itself and uses arrays; the SQL side
works on long-form rows).  The silhouettes of the embeddings sum the
squared distances of every (point, sample point) pair, as they are
defined, where the Spark side uses cluster moments; only the lineitem
points, too many for pairs, use the moments here too.  k-means is checked
by what any fit must satisfy.
"""

from __future__ import annotations

from sheaf.plans.queries import LAYOUT_PARTITIONS, ROUND, SAMPLE_SEED, SAMPLE_T, SWEEP, TOP_T

# --- common table expressions -------------------------------------------

LINES = r"""
lines AS (
  SELECT doc_id, CAST(o - 1 AS INTEGER) AS line_no, line
  FROM (SELECT doc_id,
               CASE WHEN text = '' THEN []::VARCHAR[]
                    ELSE regexp_split_to_array(regexp_replace(text, '(\r\n|\r|\n)\z', ''), '\r\n|\r|\n')
               END AS arr
        FROM {table}) d,
       unnest(arr) WITH ORDINALITY AS u(line, o)
)"""

SPLIT = "CASE WHEN length({c}) > 0 AND rtrim({c}, ' ') = '' THEN []::VARCHAR[] ELSE string_split(rtrim({c}, ' '), ' ') END"

TOKENS = r"""
tokens AS (
  SELECT doc_id, line_no, CAST(o - 1 AS INTEGER) AS pos, word
  FROM lines, unnest(""" + SPLIT.format(c="line") + r""") WITH ORDINALITY AS u(word, o)
)"""

DOCS = "documents"
CONVERSATIONS = "(SELECT conv_id AS doc_id, text FROM conversations)"

RATINGS = """
r AS (
  SELECT l.l_partkey AS product_id, o.o_custkey AS user_id, CAST(l.l_quantity AS FLOAT) AS rating
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""

CENTRED = """
c AS (
  SELECT product_id, user_id, rating,
         rating - CAST(avg(CAST(rating AS DOUBLE)) OVER (PARTITION BY user_id) AS FLOAT) AS norm_rating
  FROM r
)"""

MAXIMA = """
m AS (SELECT product_id, max(norm_rating) AS max_norm_rating FROM c GROUP BY product_id)"""

POINTS = """
pts AS (
  SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS point, CAST(label AS INTEGER) AS cluster
  FROM embeddings
)"""

LINEITEM_POINTS = """
pts AS MATERIALIZED (
  SELECT row_number() OVER () AS id, [l_quantity, l_discount, l_tax] AS point,
         CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS INTEGER) AS cluster
  FROM lineitem
)"""

SAMPLE = f"""
sized AS (
  SELECT id, point, cluster, count(*) OVER (PARTITION BY cluster) AS cluster_size,
         CAST(CAST(concat('0x', substr(md5(concat('{SAMPLE_SEED}:', CAST(id AS VARCHAR))), 1, 13)) AS BIGINT) AS DOUBLE)
           / 4503599627370496.0 AS u
  FROM pts
),
kept AS (SELECT * FROM sized WHERE u < least({SAMPLE_T}.0 / cluster_size, 1.0)),
sample AS (
  SELECT id, point, cluster, cluster_size FROM (
    SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY u, id) AS rn FROM kept
  ) WHERE rn <= {SAMPLE_T}
)"""


PAIR_SUMS = """
sc AS (SELECT cluster, count(*) AS n, max(cluster_size) AS size FROM {sample} GROUP BY cluster),
pc AS (
  SELECT p.id, p.cluster AS own, q.cluster AS c, sum((p.x - q.x) * (p.x - q.x)) AS dist_sum
  FROM pdims p JOIN sdims q ON p.i = q.i GROUP BY p.id, p.cluster, q.cluster
)"""

MOMENT_SUMS = """
mom AS (
  SELECT cluster, i, count(*) AS n, avg(x) AS mu, var_pop(x) AS v, max(cluster_size) AS size
  FROM sdims GROUP BY cluster, i
),
sc AS (
  SELECT cluster, max(n) AS n, max(n) * sum(v) AS m2, max(size) AS size FROM mom GROUP BY cluster
),
pm AS (
  SELECT d.id, d.cluster AS own, m.cluster AS c, sum((d.x - m.mu) * (d.x - m.mu)) AS dsq
  FROM pdims d JOIN mom m ON d.i = m.i
  GROUP BY d.id, d.cluster, m.cluster
),
pc AS (
  SELECT pm.id, pm.own, pm.c, sc.n * pm.dsq + sc.m2 AS dist_sum FROM pm JOIN sc ON pm.c = sc.cluster
)"""


def _silhouette_ctes(points: str, sample: str, norm: str, sums: str = PAIR_SUMS) -> str:
    """a, b, s per point of ``points`` against ``sample``.

    ``norm`` is an expression over the sampled clusters ``sc`` (columns n,
    size); ``sums`` gives the distance sums per (point, sampled cluster).
    """
    return f"""
pdims AS (SELECT id, cluster, o AS i, x FROM {points}, unnest(point) WITH ORDINALITY AS u(x, o)),
sdims AS (SELECT cluster, cluster_size, o AS i, x FROM {sample}, unnest(point) WITH ORDINALITY AS u(x, o)),
{sums.format(sample=sample)},
ad AS (
  SELECT pc.id, pc.own, pc.c, pc.dist_sum / ({norm}) AS d FROM pc JOIN sc ON pc.c = sc.cluster
),
ab AS (
  SELECT id, own AS cluster,
         coalesce(max(CASE WHEN c = own THEN d END), 0.0) AS a,
         coalesce(min(CASE WHEN c <> own THEN d END), 0.0) AS b
  FROM ad GROUP BY id, own
),
scores AS (
  SELECT p.id, p.cluster, coalesce(ab.a, 0.0) AS a, coalesce(ab.b, 0.0) AS b
  FROM {points} p LEFT JOIN ab ON p.id = ab.id
),
s AS (
  SELECT id, cluster, a, b,
         CASE WHEN greatest(a, b) = 0 THEN 'NaN'::DOUBLE ELSE (b - a) / greatest(a, b) END AS s
  FROM scores
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def _sweep_scores(k: int) -> str:
    """Row (k, t, silhouette, n_points) of the labels ``label mod k``, pair by pair."""
    t = SWEEP["m"] // k
    points = POINTS.replace("CAST(label AS INTEGER) AS cluster", f"CAST(label AS INTEGER) % {k} AS cluster")
    sample = SAMPLE.replace(f"least({SAMPLE_T}.0", f"least({t}.0").replace(f"rn <= {SAMPLE_T}", f"rn <= {t}")
    body = _with(points, sample, _silhouette_ctes("pts", "sample", f"least({t}.0, CAST(sc.size AS DOUBLE))"))
    values = f"CAST({k} AS INTEGER) AS k, CAST({t} AS INTEGER) AS t, round(avg(s), {ROUND}) AS silhouette, count(*) AS n_points"
    return f"SELECT * FROM ({body} SELECT {values} FROM s)"


EXPECTED_NORM = f"least({SAMPLE_T}.0, CAST(sc.size AS DOUBLE))"
ACTUAL_NORM = "CAST(sc.n AS DOUBLE)"

WORD_COUNT = "SELECT word, count(*) AS n FROM tokens GROUP BY word"
UTF16_LEN = "CAST(length(word) + length(regexp_replace(word, '[\\x{0000}-\\x{FFFF}]', '', 'g')) AS INTEGER)"

ORACLE: dict[str, str] = {
    # sources
    "text_lines": _with(LINES.format(table=DOCS)) + " SELECT doc_id, line_no, line FROM lines",
    "text_file_lines": _with(LINES.format(table=DOCS)) + " SELECT line FROM lines",
    "numbered_text_lines": _with(LINES.format(table=DOCS))
    + " SELECT row_number() OVER (ORDER BY doc_id, line_no) - 1 AS id, line FROM lines",
    "parse_ratings": _with(RATINGS)
    + " SELECT CAST(product_id AS VARCHAR) AS product_id, CAST(user_id AS VARCHAR) AS user_id, rating FROM r",
    "parse_labeled_points": "SELECT vec_id AS id, CAST(label AS INTEGER) AS cluster, CAST(o - 1 AS INTEGER) AS pos, "
    "CAST(x AS DOUBLE) AS x FROM embeddings, unnest(embedding) WITH ORDINALITY AS u(x, o)",
    "parse_points": "SELECT vec_id AS id, CAST(o - 1 AS INTEGER) AS pos, CAST(x AS DOUBLE) AS x "
    "FROM embeddings, unnest(embedding) WITH ORDINALITY AS u(x, o)",
    # ratings
    "user_mean_rating": _with(RATINGS)
    + " SELECT user_id, CAST(avg(CAST(rating AS DOUBLE)) AS FLOAT) AS mean_rating FROM r GROUP BY user_id",
    "attach_user_mean": _with(RATINGS)
    + " SELECT product_id, user_id, rating,"
    " CAST(avg(CAST(rating AS DOUBLE)) OVER (PARTITION BY user_id) AS FLOAT) AS mean_rating FROM r",
    "center_ratings_by_user": _with(RATINGS, CENTRED) + " SELECT product_id, user_id, rating, norm_rating FROM c",
    "rating_deviation": _with(RATINGS, CENTRED) + " SELECT product_id, norm_rating FROM c",
    "max_norm_rating": _with(RATINGS, CENTRED, MAXIMA) + " SELECT product_id, max_norm_rating FROM m",
    "rank_products": _with(RATINGS, CENTRED, MAXIMA) + " SELECT row_number() OVER (ORDER BY -max_norm_rating, product_id) AS rank, product_id, max_norm_rating FROM m",
    "partial_max_by_partition": _with(RATINGS, CENTRED, MAXIMA) + " SELECT product_id, max_norm_rating FROM m",
    "top_normalized_ratings": _with(RATINGS, CENTRED, MAXIMA)
    + " SELECT CAST(row_number() OVER (ORDER BY -max_norm_rating, product_id) AS INTEGER) AS rank,"
    f" product_id, max_norm_rating FROM m ORDER BY -max_norm_rating, product_id LIMIT {TOP_T}",
    "top_products": _with(RATINGS, CENTRED, MAXIMA)
    + " SELECT CAST(row_number() OVER (ORDER BY -max_norm_rating, product_id) AS INTEGER) AS rank,"
    f" product_id, max_norm_rating FROM m ORDER BY -max_norm_rating, product_id LIMIT {TOP_T}",
    # Java's Float.toString and DuckDB's cast agree for |v| in [1e-3, 1e7), where the top maxima lie.
    "report_top_products": _with(RATINGS, CENTRED, MAXIMA)
    + f", t AS (SELECT * FROM m ORDER BY -max_norm_rating, product_id LIMIT {TOP_T})"
    " SELECT CAST(row_number() OVER (ORDER BY -max_norm_rating, product_id) AS INTEGER) AS rank,"
    " 'Product ' || CAST(product_id AS VARCHAR) || ' maxNormRating ' || CAST(max_norm_rating AS VARCHAR) AS line FROM t",
    "repartition_layout": f"SELECT CAST({LAYOUT_PARTITIONS} AS BIGINT) AS n_partitions, count(*) AS n_rows,"
    " CAST(sum(length(text)) AS BIGINT) AS n_chars, true AS is_even FROM documents",
    # word count
    "java_split": _with(LINES.format(table=DOCS))
    + " SELECT doc_id, line_no, CAST(len(" + SPLIT.format(c="line") + ") AS INTEGER) AS n_tokens FROM lines",
    "tokenize": _with(LINES.format(table=DOCS), TOKENS) + " SELECT doc_id, line_no, pos, word FROM tokens",
    "doc_term_counts": _with(LINES.format(table=DOCS), TOKENS)
    + " SELECT doc_id, line_no, word, count(*) AS n FROM tokens GROUP BY doc_id, line_no, word",
    "word_count": _with(LINES.format(table=DOCS), TOKENS) + " " + WORD_COUNT,
    "word_count_salted": _with(LINES.format(table=DOCS), TOKENS) + " " + WORD_COUNT,
    "word_count_salted_pairs": _with(LINES.format(table=DOCS), TOKENS) + " " + WORD_COUNT,
    "word_count_partitionwise": _with(LINES.format(table=DOCS), TOKENS) + " " + WORD_COUNT,
    "word_count_conversations": _with(LINES.format(table=CONVERSATIONS), TOKENS) + " " + WORD_COUNT,
    "word_count_report": _with(LINES.format(table=DOCS), TOKENS)
    + ", v AS (SELECT count(DISTINCT word) AS n FROM tokens)"
    " SELECT 'n_documents' AS metric, (SELECT count(*) FROM lines) AS value"
    " UNION ALL SELECT 'vocabulary_size_one_round', n FROM v"
    " UNION ALL SELECT 'n_tokens_one_round', count(*) FROM tokens"
    " UNION ALL SELECT 'vocabulary_size_salted', n FROM v"
    " UNION ALL SELECT 'n_tokens_salted', count(*) FROM tokens"
    " UNION ALL SELECT 'vocabulary_size_salted_pairs', n FROM v"
    " UNION ALL SELECT 'n_tokens_salted_pairs', count(*) FROM tokens"
    " UNION ALL SELECT 'vocabulary_size_partitionwise', n FROM v"
    " UNION ALL SELECT 'n_tokens_partitionwise', count(*) FROM tokens"
    f" UNION ALL SELECT 'avg_word_length', CAST(sum({UTF16_LEN}) AS BIGINT) // count(*)"
    " FROM (SELECT DISTINCT word FROM tokens)",
    "count_documents": _with(LINES.format(table=DOCS)) + " SELECT count(*) AS n_documents FROM lines",
    "vocabulary_size": _with(LINES.format(table=DOCS), TOKENS)
    + " SELECT count(DISTINCT word) AS vocabulary_size FROM tokens",
    "word_lengths": _with(LINES.format(table=DOCS), TOKENS)
    + f" SELECT word, {UTF16_LEN} AS length FROM (SELECT DISTINCT word FROM tokens)",
    "avg_word_length": _with(LINES.format(table=DOCS), TOKENS)
    + f", w AS (SELECT DISTINCT word FROM tokens), wl AS (SELECT {UTF16_LEN} AS length FROM w)"
    " SELECT count(*) AS vocabulary_size, CAST(sum(length) AS BIGINT) AS total_length,"
    " CAST(sum(length) AS BIGINT) // count(*) AS avg_word_length FROM wl",
    # sampling
    "project_cluster": _with(POINTS) + " SELECT cluster FROM pts",
    "count_points": "SELECT count(*) AS n_points FROM embeddings",
    "attach_normalizer": _with(POINTS)
    + f" SELECT id, cluster, least(CAST({SAMPLE_T} AS BIGINT), count(*) OVER (PARTITION BY cluster)) AS norm FROM pts",
    "cap_per_cluster": _with(POINTS)
    + " SELECT id, cluster FROM (SELECT id, cluster, row_number() OVER (PARTITION BY cluster ORDER BY id) AS rn"
    f" FROM pts) WHERE rn <= {SAMPLE_T}",
    "cluster_sizes": _with(POINTS) + " SELECT cluster, count(*) AS size FROM pts GROUP BY cluster",
    "attach_cluster_size": _with(POINTS)
    + " SELECT id, cluster, count(*) OVER (PARTITION BY cluster) AS cluster_size FROM pts",
    "bernoulli_sample": _with(POINTS, SAMPLE) + " SELECT id, cluster, u FROM kept",
    "stratified_sample": _with(POINTS, SAMPLE) + " SELECT id, cluster FROM sample",
    "normalizers": _with(POINTS)
    + f" SELECT cluster, least(CAST({SAMPLE_T} AS BIGINT), count(*)) AS norm FROM pts GROUP BY cluster",
    "sample_cluster_sizes": _with(POINTS, SAMPLE)
    + " SELECT cluster, count(*) AS sample_size FROM sample GROUP BY cluster",
    # silhouette
    "silhouette_per_point": _with(POINTS, SAMPLE, _silhouette_ctes("pts", "sample", EXPECTED_NORM))
    + f" SELECT id, cluster, round(a, {ROUND}) AS a, round(b, {ROUND}) AS b, round(s, {ROUND}) AS s FROM s",
    "silhouette_value": _with(POINTS, SAMPLE, _silhouette_ctes("pts", "sample", EXPECTED_NORM))
    + f" SELECT id, cluster, round(s, {ROUND}) AS s FROM s",
    "mean_silhouette": _with(POINTS, SAMPLE, _silhouette_ctes("pts", "sample", EXPECTED_NORM))
    + f" SELECT round(avg(s), {ROUND}) AS silhouette, count(*) AS n_points FROM s",
    "intra_cluster_distance": _with(POINTS, SAMPLE, _silhouette_ctes("pts", "sample", EXPECTED_NORM))
    + f" SELECT id, cluster, round(a, {ROUND}) AS a FROM s",
    "nearest_cluster_distance": _with(POINTS, SAMPLE, _silhouette_ctes("pts", "sample", EXPECTED_NORM))
    + f" SELECT id, cluster, round(b, {ROUND}) AS b FROM s",
    "distance_sums_by_cluster": _with(POINTS, SAMPLE, _silhouette_ctes("pts", "sample", ACTUAL_NORM))
    + f" SELECT pc.id, pc.own AS cluster, pc.c AS sample_cluster, round(pc.dist_sum, {ROUND}) AS dist_sum FROM pc",
    "approx_silhouette_full": _with(POINTS, SAMPLE, _silhouette_ctes("pts", "sample", EXPECTED_NORM))
    + f" SELECT round(avg(s), {ROUND}) AS approx_silhouette, count(*) AS n_points FROM s",
    "approx_silhouette_actual": _with(POINTS, SAMPLE, _silhouette_ctes("pts", "sample", ACTUAL_NORM))
    + f" SELECT round(avg(s), {ROUND}) AS approx_silhouette, count(*) AS n_points FROM s",
    "exact_silhouette_full": _with(
        POINTS, "allpts AS (SELECT *, 0 AS cluster_size FROM pts)", _silhouette_ctes("pts", "allpts", ACTUAL_NORM)
    )
    + f" SELECT round(avg(s), {ROUND}) AS silhouette, count(*) AS n_points FROM s",
    "exact_silhouette_sample": _with(POINTS, SAMPLE, _silhouette_ctes("sample", "sample", ACTUAL_NORM))
    + f" SELECT round(avg(s), {ROUND}) AS sample_silhouette, count(*) AS n_points FROM s",
    "silhouette_report": _with(
        POINTS,
        SAMPLE,
        "near AS (" + _with(_silhouette_ctes("pts", "sample", EXPECTED_NORM)) + " SELECT avg(s) AS v, count(*) AS n FROM s)",
        "own AS (" + _with(_silhouette_ctes("sample", "sample", ACTUAL_NORM)) + " SELECT avg(s) AS v, count(*) AS n FROM s)",
    )
    + f" SELECT round(near.v, {ROUND}) AS approx_silhouette, near.n AS n_points,"
    f" round(own.v, {ROUND}) AS sample_silhouette, own.n AS n_sample FROM near, own",
    "exact_silhouette_lineitem": _with(
        LINEITEM_POINTS,
        "allpts AS (SELECT *, 0 AS cluster_size FROM pts)",
        _silhouette_ctes("pts", "allpts", ACTUAL_NORM, MOMENT_SUMS),
    )
    + f" SELECT round(avg(s), {ROUND}) AS silhouette, count(*) AS n_points FROM s",
    # clustering
    "kmeans_fit": _with(POINTS, "d AS (SELECT o AS i, x FROM pts, unnest(point) WITH ORDINALITY AS u(x, o))")
    + f" SELECT CAST(i - 1 AS INTEGER) AS pos, round(avg(x), {ROUND}) AS single_centre,"
    " CAST(0 AS BIGINT) AS n_off, CAST(4 AS BIGINT) AS k FROM d GROUP BY i",
    "kmeans_assign": "SELECT vec_id AS id, true AS is_nearest FROM embeddings",
    "k_sweep_silhouette": f"SELECT CAST(k AS INTEGER) AS k, CAST({SWEEP['m']} // k AS INTEGER) AS t, n_points,"
    " true AS in_range, CASE WHEN k = 1 THEN CAST(-1 AS DOUBLE) END AS single_silhouette"
    f" FROM range({SWEEP['k_start']}, {SWEEP['k_start'] + SWEEP['h']}) ks(k), (SELECT count(*) AS n_points FROM embeddings)",
    "sweep_scores": " UNION ALL ".join(_sweep_scores(k) for k in range(SWEEP["k_start"], SWEEP["k_start"] + SWEEP["h"])),
    "sqdist": _with(
        POINTS,
        "pdims AS (SELECT id, cluster, o AS i, x FROM pts, unnest(point) WITH ORDINALITY AS u(x, o))",
        "cent AS (SELECT cluster, i, avg(x) AS mu FROM pdims GROUP BY cluster, i)",
    )
    + f" SELECT d.id, d.cluster, round(sum((d.x - c.mu) * (d.x - c.mu)), {ROUND}) AS d"
    " FROM pdims d JOIN cent c ON d.cluster = c.cluster AND d.i = c.i GROUP BY d.id, d.cluster",
    "assign_nearest": _with(
        POINTS,
        "pdims AS (SELECT id, cluster, o AS i, x FROM pts, unnest(point) WITH ORDINALITY AS u(x, o))",
        "cent AS (SELECT cluster, i, avg(x) AS mu FROM pdims GROUP BY cluster, i)",
        "pc AS (SELECT d.id, d.cluster, c.cluster AS cand, sum((d.x - c.mu) * (d.x - c.mu)) AS dsq"
        " FROM pdims d JOIN cent c ON d.i = c.i GROUP BY d.id, d.cluster, c.cluster)",
    )
    + " SELECT id, cluster, CAST(arg_min(cand, dsq) AS INTEGER) AS nearest FROM pc GROUP BY id, cluster",
}
