"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the warehouse tables of ``sf_dir`` in full (no id
subsets, no row caps); the only limit is the top-T of the ratings report,
which is the feature itself.  Computed columns carry the same names as in
``sheaf.plans.oracle``.  Doubles that depend on summation order
(silhouettes) are rounded to 6 decimals for the comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.functions.strings import java_split
from sheaf.functions.vectors import silhouette_value, sqdist
from sheaf.operators import clustering, ratings, sampling, silhouette, wordcount
from sheaf.operators.joins import broadcast_if_small, materialize
from sheaf.plans.ksweep import k_sweep_silhouette
from sheaf.sources import parsers, tables
from sheaf.sources.text import lines_from_column, read_text_lines, write_text_lines

# Fixed parameters of the registered queries (the oracle SQL uses the same).
TOP_T = 20
SAMPLE_T = 20
SAMPLE_SEED = 7
N_SALTS = 8
LAYOUT_PARTITIONS = 6
SWEEP = {"k_start": 1, "h": 4, "max_iter": 10, "m": 60, "seed": 11}
DRAW = "md5"  # the sampling draw DuckDB can reproduce (the library default is xxhash64)
ROUND = 6

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- sources
def q_text_lines(spark: SparkSession, sf: str) -> DataFrame:
    return lines_from_column(tables.documents(spark, sf))


def q_text_file_lines(spark: SparkSession, sf: str) -> DataFrame:
    # The document lines round-trip through text files: sink, then source.
    path = write_text_lines(lines_from_column(tables.documents(spark, sf)), "line")
    return read_text_lines(spark, path).select(F.col("value").alias("line"))


def q_numbered_text_lines(spark: SparkSession, sf: str) -> DataFrame:
    # Lines in corpus order through text files: a line's id is its place in the input, however the files are split.
    lines = lines_from_column(tables.documents(spark, sf))
    ordered = lines.repartitionByRange("doc_id", "line_no").sortWithinPartitions("doc_id", "line_no")
    return read_text_lines(spark, write_text_lines(ordered, "line"), with_ids=True).withColumnRenamed("value", "line")


def q_parse_ratings(spark: SparkSession, sf: str) -> DataFrame:
    return parsers.parse_ratings(tables.rating_lines(spark, sf))


def _long_form(df: DataFrame) -> DataFrame:
    return df.select("id", *(["cluster"] if "cluster" in df.columns else []),
                     F.posexplode("point").alias("pos", "x"))


def q_parse_labeled_points(spark: SparkSession, sf: str) -> DataFrame:
    return _long_form(parsers.parse_labeled_points(tables.labeled_point_lines(spark, sf), keep=["id"]))


def q_parse_points(spark: SparkSession, sf: str) -> DataFrame:
    return _long_form(parsers.parse_points(tables.point_lines(spark, sf), keep=["id"]))


# ---------------------------------------------------------------- ratings
def q_user_mean_rating(spark: SparkSession, sf: str) -> DataFrame:
    return ratings.user_mean_rating(tables.ratings(spark, sf))


def _ratings(spark: SparkSession, sf: str) -> DataFrame:
    # The ratings come out of a join and are read twice (means, rows): write them once.
    return materialize(tables.ratings(spark, sf))


def q_attach_user_mean(spark: SparkSession, sf: str) -> DataFrame:
    return ratings.attach_user_mean(_ratings(spark, sf), strategy="join")


def q_center_ratings_by_user(spark: SparkSession, sf: str) -> DataFrame:
    return ratings.center_ratings_by_user(_ratings(spark, sf), strategy="join")


def q_rating_deviation(spark: SparkSession, sf: str) -> DataFrame:
    return ratings.rating_deviation(_ratings(spark, sf))


def _maxima(spark: SparkSession, sf: str) -> DataFrame:
    return ratings.max_norm_rating(ratings.center_ratings_by_user(_ratings(spark, sf)))


def q_max_norm_rating(spark: SparkSession, sf: str) -> DataFrame:
    return _maxima(spark, sf)


def q_partial_max_by_partition(spark: SparkSession, sf: str) -> DataFrame:
    # The partial maxima depend on the layout; their maximum (round 2) does not.
    partials = ratings.partial_max_by_partition(ratings.center_ratings_by_user(_ratings(spark, sf)))
    return ratings.max_of_partials(partials)


def q_rank_products(spark: SparkSession, sf: str) -> DataFrame:
    return ratings.rank_products(_maxima(spark, sf))


def q_top_products(spark: SparkSession, sf: str) -> DataFrame:
    return ratings.top_products(_maxima(spark, sf), TOP_T)


def q_top_normalized_ratings(spark: SparkSession, sf: str) -> DataFrame:
    return ratings.top_normalized_ratings(tables.ratings(spark, sf), TOP_T, materialize_input=True)


def q_report_top_products(spark: SparkSession, sf: str) -> DataFrame:
    return ratings.report_lines(q_top_normalized_ratings(spark, sf))


# ----------------------------------------------------------------- layout
def q_repartition_layout(spark: SparkSession, sf: str) -> DataFrame:
    """The input repartitioned into K: rows and characters per partition, summed up.

    No value changes, every partition has rows, and none has twice the even share."""
    docs = tables.documents(spark, sf, num_partitions=LAYOUT_PARTITIONS)
    parts = docs.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.char_length("text")).alias("chars"))
    return parts.agg(
        F.count(F.lit(1)).alias("n_partitions"), F.sum("n").alias("n_rows"), F.sum("chars").alias("n_chars"),
        (F.max("n") <= 2 * F.sum("n") / LAYOUT_PARTITIONS).alias("is_even"),
    )


# ------------------------------------------------------------- word count
def _tokens(spark: SparkSession, sf: str, with_pos: bool = False) -> DataFrame:
    return wordcount.tokenize(lines_from_column(tables.spread(tables.documents(spark, sf))), with_pos=with_pos)


def q_java_split(spark: SparkSession, sf: str) -> DataFrame:
    lines = lines_from_column(tables.documents(spark, sf))
    return lines.select("doc_id", "line_no", F.size(java_split("line", " ")).alias("n_tokens"))


def q_tokenize(spark: SparkSession, sf: str) -> DataFrame:
    return _tokens(spark, sf, with_pos=True)


def q_doc_term_counts(spark: SparkSession, sf: str) -> DataFrame:
    return wordcount.count_terms_in_rows(lines_from_column(tables.spread(tables.documents(spark, sf))))


def q_word_count(spark: SparkSession, sf: str) -> DataFrame:
    return wordcount.word_count(_tokens(spark, sf))


def q_word_count_salted(spark: SparkSession, sf: str) -> DataFrame:
    return wordcount.word_count_salted(_tokens(spark, sf), N_SALTS)


def q_word_count_salted_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return wordcount.word_count_salted_pairs(_tokens(spark, sf), N_SALTS)


def q_word_count_partitionwise(spark: SparkSession, sf: str) -> DataFrame:
    return wordcount.word_count_partitionwise(_tokens(spark, sf))


def q_count_documents(spark: SparkSession, sf: str) -> DataFrame:
    return wordcount.count_documents(lines_from_column(tables.documents(spark, sf)))


def q_vocabulary_size(spark: SparkSession, sf: str) -> DataFrame:
    return wordcount.vocabulary_size(wordcount.word_count(_tokens(spark, sf)))


def q_word_lengths(spark: SparkSession, sf: str) -> DataFrame:
    return wordcount.word_lengths(wordcount.word_count(_tokens(spark, sf)))


def q_avg_word_length(spark: SparkSession, sf: str) -> DataFrame:
    return wordcount.avg_word_length(wordcount.word_count_partitionwise(_tokens(spark, sf)))


def q_word_count_report(spark: SparkSession, sf: str) -> DataFrame:
    return wordcount.word_count_report(lines_from_column(tables.spread(tables.documents(spark, sf))), n_salts=N_SALTS)


def q_word_count_conversations(spark: SparkSession, sf: str) -> DataFrame:
    lines = lines_from_column(tables.conversation_texts(spark, sf), keep=("conv_id", "turn"))
    return wordcount.word_count(wordcount.tokenize(lines, keep=("conv_id", "turn", "line_no"), with_pos=False))


# --------------------------------------------------------------- sampling
def _points(spark: SparkSession, sf: str) -> DataFrame:
    return tables.labeled_points(spark, sf)


def q_project_cluster(spark: SparkSession, sf: str) -> DataFrame:
    return _points(spark, sf).select("cluster")


def q_count_points(spark: SparkSession, sf: str) -> DataFrame:
    return _points(spark, sf).agg(F.count(F.lit(1)).alias("n_points"))


def q_cluster_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.cluster_sizes(_points(spark, sf))


def q_attach_cluster_size(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.attach_cluster_size(_points(spark, sf)).select("id", "cluster", "cluster_size")


def q_attach_normalizer(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.attach_normalizer(_points(spark, sf), SAMPLE_T).select("id", "cluster", "norm")


def q_cap_per_cluster(spark: SparkSession, sf: str) -> DataFrame:
    # The per-group limit on its own: the first t points of each cluster by id.
    capped = sampling.cap_per_cluster(_points(spark, sf).select("id", "cluster"), SAMPLE_T, order=("id",))
    return capped.select("id", "cluster")


def q_bernoulli_sample(spark: SparkSession, sf: str) -> DataFrame:
    sized = sampling.attach_cluster_size(_points(spark, sf))
    kept = sampling.bernoulli_sample(sized, SAMPLE_T, SAMPLE_SEED, draw=DRAW)
    return kept.select("id", "cluster", "u")


def q_stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.stratified_sample(_points(spark, sf), SAMPLE_T, SAMPLE_SEED, draw=DRAW).select("id", "cluster")


def q_normalizers(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.normalizers(sampling.cluster_sizes(_points(spark, sf)), SAMPLE_T)


def q_sample_cluster_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.sample_cluster_sizes(sampling.stratified_sample(_points(spark, sf), SAMPLE_T, SAMPLE_SEED, draw=DRAW))


# ------------------------------------------------------------- silhouette
def _rounded_scores(scored: DataFrame) -> DataFrame:
    return scored.select(
        "id", "cluster", *[F.round(c, ROUND).alias(c) for c in ("a", "b", "s")]
    )


def _rounded_mean(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.round("silhouette", ROUND).alias(name), "n_points")


def q_silhouette_per_point(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_scores(silhouette.approx_silhouette_scores(_points(spark, sf), SAMPLE_T, SAMPLE_SEED, draw=DRAW))


def q_silhouette_value(spark: SparkSession, sf: str) -> DataFrame:
    scored = silhouette.approx_silhouette_scores(_points(spark, sf), SAMPLE_T, SAMPLE_SEED, draw=DRAW)
    return scored.select("id", "cluster", F.round(silhouette_value("a", "b"), ROUND).alias("s"))


def q_mean_silhouette(spark: SparkSession, sf: str) -> DataFrame:
    scored = silhouette.approx_silhouette_scores(_points(spark, sf), SAMPLE_T, SAMPLE_SEED, draw=DRAW)
    return _rounded_mean(silhouette.mean_silhouette(scored), "silhouette")


def q_intra_cluster_distance(spark: SparkSession, sf: str) -> DataFrame:
    scored = silhouette.approx_silhouette_scores(_points(spark, sf), SAMPLE_T, SAMPLE_SEED, draw=DRAW)
    return scored.select("id", "cluster", F.round("a", ROUND).alias("a"))


def q_nearest_cluster_distance(spark: SparkSession, sf: str) -> DataFrame:
    scored = silhouette.approx_silhouette_scores(_points(spark, sf), SAMPLE_T, SAMPLE_SEED, draw=DRAW)
    return scored.select("id", "cluster", F.round("b", ROUND).alias("b"))


def q_distance_sums_by_cluster(spark: SparkSession, sf: str) -> DataFrame:
    pts = _points(spark, sf)
    dim = silhouette.vector_dim(pts)
    sample = sampling.stratified_sample(pts, SAMPLE_T, SAMPLE_SEED, draw=DRAW)
    moments = silhouette.cluster_moments(sample, dim)
    sums = silhouette.distance_sums_by_cluster(pts.select("id", "point", "cluster"), moments, dim)
    return sums.select("id", "cluster", "sample_cluster", F.round("dist_sum", ROUND).alias("dist_sum"))


def q_approx_silhouette_full(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_mean(silhouette.approx_silhouette(_points(spark, sf), SAMPLE_T, SAMPLE_SEED, draw=DRAW), "approx_silhouette")


def q_approx_silhouette_actual(spark: SparkSession, sf: str) -> DataFrame:
    df = silhouette.approx_silhouette(_points(spark, sf), SAMPLE_T, SAMPLE_SEED, normalizer="actual", draw=DRAW)
    return _rounded_mean(df, "approx_silhouette")


def q_exact_silhouette_full(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_mean(silhouette.exact_silhouette(_points(spark, sf)), "silhouette")


def q_exact_silhouette_sample(spark: SparkSession, sf: str) -> DataFrame:
    df = silhouette.exact_silhouette_sample(_points(spark, sf), SAMPLE_T, SAMPLE_SEED, draw=DRAW)
    return _rounded_mean(df, "sample_silhouette")


def q_silhouette_report(spark: SparkSession, sf: str) -> DataFrame:
    out = silhouette.silhouette_report(_points(spark, sf), SAMPLE_T, SAMPLE_SEED, draw=DRAW)
    return out.withColumns({c: F.round(c, ROUND) for c in ("approx_silhouette", "sample_silhouette")})


def q_exact_silhouette_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_mean(silhouette.exact_silhouette(tables.lineitem_points(spark, sf)), "silhouette")


# ------------------------------------------------------------- clustering
def q_assign_nearest(spark: SparkSession, sf: str) -> DataFrame:
    pts = _points(spark, sf)
    dim = silhouette.vector_dim(pts)
    out = clustering.assign_nearest(pts, clustering.centroids(pts, dim))
    return out.select("id", "cluster", "nearest")


def q_sqdist(spark: SparkSession, sf: str) -> DataFrame:
    pts = _points(spark, sf)
    cents, _ = broadcast_if_small(clustering.centroids(pts, silhouette.vector_dim(pts)))
    joined = pts.join(cents, "cluster")
    return joined.select("id", "cluster", F.round(sqdist("point", "centre"), ROUND).alias("d"))


def q_kmeans_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Per coordinate: the centre of k = 1, and how many of the k = 4 centres are off the mean of their points.

    The k = 4 fit runs until it converges, when a centre is that mean up to the tolerance of its last step.
    """
    pts = _points(spark, sf).select("id", "point")
    single = clustering.kmeans_centres(spark, clustering.kmeans_fit(pts, k=1, max_iter=1))
    model = clustering.kmeans_fit(pts, k=4, max_iter=100, seed=SWEEP["seed"])
    means = clustering.centroids(clustering.kmeans_assign(model, pts), silhouette.vector_dim(pts))

    def coordinates(centres: DataFrame, name: str) -> DataFrame:
        return centres.select("cluster", F.posexplode("centre").alias("pos", name))

    both = coordinates(clustering.kmeans_centres(spark, model), "x").join(coordinates(means, "mean"), ["cluster", "pos"])
    off = both.groupBy("pos").agg(F.count_if(F.abs(F.col("x") - F.col("mean")) > 1e-3).alias("n_off"), F.count(F.lit(1)).alias("k"))
    one = coordinates(single, "x").select("pos", F.round("x", ROUND).alias("single_centre"))
    return one.join(off, "pos")


def q_kmeans_assign(spark: SparkSession, sf: str) -> DataFrame:
    pts = _points(spark, sf).select("id", "point")
    model = clustering.kmeans_fit(pts, k=4, max_iter=10, seed=SWEEP["seed"])
    labelled = clustering.kmeans_assign(model, pts)
    checked = clustering.assign_nearest(labelled, clustering.kmeans_centres(spark, model))
    return checked.select("id", (F.col("cluster") == F.col("nearest")).alias("is_nearest"))


def q_k_sweep_silhouette(spark: SparkSession, sf: str) -> DataFrame:
    """k, t, n_points per k; the silhouette of k = 1 is -1, and any other lies between -1 and 1."""
    out = k_sweep_silhouette(_points(spark, sf), **SWEEP)
    single = F.when(F.col("k") == 1, F.round("silhouette", ROUND)).alias("single_silhouette")
    return out.select("k", "t", "n_points", F.col("silhouette").between(-1, 1).alias("in_range"), single)


def q_sweep_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The scoring half of the sweep on labels that the table fixes: label mod k for each k."""
    ks = range(SWEEP["k_start"], SWEEP["k_start"] + SWEEP["h"])
    labelled = _points(spark, sf).withColumns({f"cluster_{k}": F.col("cluster") % k for k in ks})
    size_of = {f"cluster_{k}": SWEEP["m"] // k for k in ks}
    out = silhouette.approx_silhouettes(labelled, size_of, SAMPLE_SEED, draw=DRAW)
    k = F.substring_index("labelling", "_", -1).cast("int").alias("k")
    return out.select(k, "t", F.round("silhouette", ROUND).alias("silhouette"), "n_points")


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
