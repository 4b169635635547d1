"""Silhouette of a labelled clustering, from per-cluster moments.

For a point p of cluster c and a set Q of sample points of cluster c':

    sum_{q in Q} ||p - q||^2  =  m * ||p - mu||^2  +  M2

with m = |Q|, mu the mean of Q and M2 = sum_q ||q - mu||^2 (exact, and
numerically stable because it is centred).  With N(c') the normaliser,

    a(p) = sum over the own cluster / N(c)            (0 if c has no sample point)
    b(p) = min over other sampled clusters of sum / N  (0 if there is none)
    s(p) = (b - a) / max(a, b)                         (NaN when both are 0)

which is the reference's per-point definition (squared distances, the
point itself included in its own cluster's sum).  It is *not*
``ClusteringEvaluator``, which leaves the point out of its own cluster.

Plan shape.  One grouped aggregate reduces the (sample) points to k rows
of moments: a partial aggregate per task, so a cluster holding a third of
the points costs one buffer per task.  The k rows are model-sized (k
centres of d coordinates, like a k-means model) and are shipped to the
tasks inside the plan.  A model larger than one block (``block_clusters``
rows, 2^24 values) is read back and applied block by block, the points
with their running a and b being written between two blocks, so neither
the driver nor a task ever holds more than one block.  Every point
needs k*d arithmetic and no join, no shuffle and no pair of points
is ever formed; the mean is a partial + final ``avg``.  Work is linear in
the number of points, so the exact silhouette of all points costs one
more pass than the approximate one.

Per-point evaluation methods (``method``):

* ``codegen`` – the moments become literals of plain arithmetic
  expressions, compiled by whole-stage codegen (best for small k*d);
* ``arrow`` – an Arrow UDF computing the distances of a whole batch to one
  cluster mean after the other (best when k*d is large, where the
  generated code would outgrow a JVM method); for 512 clusters and more the
  search for b passes over groups of means by distance bounds (``pruned``);
* ``lambda`` – array higher-order functions over the moments as one array
  literal column, interpreted per element; a cross-check for small models.

All three take differences to the mean before squaring, and keep infinite
and NaN distances (NaN above every number).  A point without an own or
another sampled cluster has a = 0 or b = 0.

Normalisers: ``expected`` = min(t, |C|) (the reference's approximate
silhouette), ``actual`` = number of sampled points of the cluster (the
exact silhouette of the sample, or of all points when the sample is
everything).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import islice
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.vectors import silhouette_value
from sheaf.operators.joins import materialize
from sheaf.operators.pruned import MIN_MEANS, PrunedMeans
from sheaf.operators.sampling import DEFAULT_BLOCK_CLUSTERS, model_block_rows, stratified_sample, stratified_samples

NORMALIZERS = ("expected", "actual")
METHODS = ("auto", "codegen", "arrow", "lambda")
# Up to this many coordinates the moments are per-coordinate built-in
# aggregates; above it Spark ML's Summarizer (one vector aggregate).
WIDE_MAX_DIM = 16
# Up to this many (cluster, coordinate) terms per point, generated code.
CODEGEN_MAX_TERMS = 64
# Clusters per block of distance sums: an Arrow batch holds this many sums per point.
SUMS_BLOCK = 1024


def vector_dim(points: DataFrame, point: str = "point") -> int:
    """Length of the first vector (reads one row); 0 for an empty input."""
    row = points.select(F.size(point).alias("d")).first()
    return int(row["d"]) if row is not None else 0


def _dim_error(dim: int) -> Column:
    return F.raise_error(F.lit(f"points must all have {dim} coordinates"))


def cluster_moments(
    df: DataFrame,
    dim: int | None = None,
    point: str = "point",
    cluster: str = "cluster",
    size_col: str | None = None,
) -> DataFrame:
    """(cluster, n, mean:array<double>, m2[, size]) per cluster.

    ``m2`` is the centred scatter sum ||q - mean||^2, from stable running
    variances.  Vectors of unequal length fail the query.
    """
    p = F.col(point)
    extra = [F.max(size_col).alias("size")] if size_col else []
    if dim is not None and dim <= WIDE_MAX_DIM:
        whole = F.size(F.array_compact(p))  # a null coordinate counts as a missing one
        aggs = [F.count(F.lit(1)).alias("n"), F.min(whole).alias("_dmin"), F.max(F.size(p)).alias("_dmax")]
        aggs += [F.avg(p[i]).alias(f"_mu{i}") for i in range(dim)]
        aggs += [F.var_pop(p[i]).alias(f"_var{i}") for i in range(dim)]
        m = df.groupBy(cluster).agg(*aggs, *extra)
        scatter = reduce(add, [F.col(f"_var{i}") for i in range(dim)], F.lit(0.0)) * F.col("n")
        m2 = F.when((F.col("_dmin") != dim) | (F.col("_dmax") != dim), _dim_error(dim)).otherwise(scatter)
        mean = F.array(*[F.col(f"_mu{i}") for i in range(dim)])
    else:
        summary = Summarizer.metrics("mean", "variance", "count").summary(array_to_vector(p))
        m = df.groupBy(cluster).agg(summary.alias("_st"), *extra)
        n = F.col("_st.count")
        # Summarizer's variance is the unbiased one: scatter = var * (n - 1).
        var_sum = F.aggregate(vector_to_array("_st.variance"), F.lit(0.0), lambda acc, v: acc + v)
        m = m.withColumn("n", n)
        m2 = var_sum * (n - 1).cast("double")
        mean = vector_to_array("_st.mean")
    cols = [F.col(cluster), F.col("n"), mean.alias("mean"), m2.alias("m2")]
    return m.select(*cols, *(["size"] if size_col else []))


@dataclass(frozen=True)
class Moments:
    """Moments of one cluster's sample, with its normaliser."""

    cluster: int
    n: float
    mean: tuple[float, ...]
    m2: float
    norm: float


def moment_blocks(
    moments: DataFrame,
    norm: Column,
    cluster: str = "cluster",
    block_clusters: int = DEFAULT_BLOCK_CLUSTERS,
    dim: int | None = None,
) -> Iterator[list[Moments]]:
    """The k moment rows in blocks that the driver may hold, by ascending cluster within a block."""
    limit = model_block_rows(block_clusters, dim)
    table = moments.select(
        F.col(cluster).alias("cluster"),
        F.col("n").cast("double").alias("n"),
        F.col("mean"),
        F.col("m2").cast("double").alias("m2"),
        norm.cast("double").alias("norm"),
    )
    rows = table.limit(limit + 1).collect()
    # a model of more than one block is written once and read back a partition at a time
    source = iter(rows) if len(rows) <= limit else materialize(table).toLocalIterator()
    while block := list(islice(source, limit)):
        if any(r["cluster"] is None for r in block):
            raise ValueError(f"null label in {cluster}")
        out = [Moments(r["cluster"], r["n"], tuple(r["mean"]), r["m2"], r["norm"]) for r in block]
        yield sorted(out, key=lambda m: m.cluster)


def _tree_sum(terms: list[Column]) -> Column:
    while len(terms) > 1:
        terms = [terms[i] + terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
    return terms[0]


def _scores_codegen(points: DataFrame, moments: list[Moments], dim: int, point: str, cluster: str) -> DataFrame:
    p = F.col(point)
    dists = []
    for m in moments:
        sq = _tree_sum([(p[i] - F.lit(m.mean[i])) * (p[i] - F.lit(m.mean[i])) for i in range(dim)])
        dists.append(F.lit(m.n / m.norm) * sq + F.lit(m.m2 / m.norm))
    index = F.create_map(*[x for j, m in enumerate(moments) for x in (F.lit(m.cluster), F.lit(j))])
    checked = F.when(F.size(p) != dim, _dim_error(dim)).otherwise(F.array(*dists))
    staged = points.select("*", checked.alias("_ds"), F.element_at(index, F.col(cluster)).alias("_own"))
    ds, own = F.col("_ds"), F.col("_own")
    others = [F.when(own.isNull() | (own != j), ds[j]) for j in range(len(moments))]
    b = others[0] if len(others) == 1 else F.least(*others)
    return staged.select(
        *[F.col(c) for c in points.columns],
        F.get(ds, own).alias("a"),
        b.alias("b"),
    )


def point_matrix(points: pa.Array, dim: int) -> np.ndarray:
    """Rows x dim doubles of an Arrow list column; other lengths fail."""
    sizes = points.value_lengths()
    if points.null_count or sizes.to_numpy(zero_copy_only=False).tolist().count(dim) != len(points):
        raise ValueError(f"points must all have {dim} coordinates")
    return points.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(points), dim)


def scaled_distance(p: np.ndarray, mean: np.ndarray, n: float, m2: float) -> np.ndarray:
    """n * ||p - mean||^2 + m2 by differences: nothing cancels, non-finite values stay."""
    with np.errstate(over="ignore", invalid="ignore"):
        diff = p - mean
        return n * (diff * diff).sum(axis=1) + m2


def _arrays(moments: list[Moments], dim: int, scaled: bool) -> tuple:
    mu = np.array([m.mean for m in moments], dtype=np.float64).reshape(len(moments), dim)
    norm = np.array([m.norm if scaled else 1.0 for m in moments])
    weight = np.array([m.n for m in moments]) / norm
    return [m.cluster for m in moments], mu, weight, np.array([m.m2 for m in moments]) / norm


def _ab_udf(spark, moments: list[Moments], dim: int):
    # The block of the model travels once per executor as a broadcast variable.
    ids, *arrays = _arrays(moments, dim, scaled=True)
    if len(ids) >= MIN_MEANS:
        return _pruned_ab_udf(spark, np.array(ids), PrunedMeans(*arrays), dim)
    model = spark.sparkContext.broadcast((ids, *arrays))

    @F.arrow_udf("a double, b double")
    def ab(points: pa.Array, labels: pa.Array) -> pa.Array:
        ids, mu, weight, offset = model.value
        p, own_id = point_matrix(points, dim), labels.to_numpy(zero_copy_only=False)
        a, b = np.full(len(p), np.nan), np.full(len(p), np.nan)
        has_a, has_b = np.zeros(len(p), dtype=bool), np.zeros(len(p), dtype=bool)
        for j, cluster in enumerate(ids):
            d, own = scaled_distance(p, mu[j], weight[j], offset[j]), own_id == cluster
            a[own] = d[own]
            b[~own] = np.fmin(b[~own], d[~own])  # NaN is above every number
            has_a |= own
            has_b |= ~own
        columns = [pa.array(a, mask=~has_a), pa.array(b, mask=~has_b)]
        return pa.StructArray.from_arrays(columns, names=["a", "b"])

    return ab


def _pruned_ab_udf(spark, ids: np.ndarray, means: PrunedMeans, dim: int):
    """As ``_ab_udf`` for many clusters: a is one lookup, b a pruned search (``ids`` ascend)."""
    model = spark.sparkContext.broadcast((ids, means))

    @F.arrow_udf("a double, b double")
    def ab(points: pa.Array, labels: pa.Array) -> pa.Array:
        ids, means = model.value
        p, own_id = point_matrix(points, dim), labels.to_numpy(zero_copy_only=False)
        own = np.minimum(np.searchsorted(ids, own_id), len(ids) - 1)
        has_a = ids[own] == own_id
        with np.errstate(over="ignore", invalid="ignore"):
            diff = p - means.means[own]
            a = means.weight[own] * (diff * diff).sum(axis=1) + means.offset[own]
        b, where = means.best(p, skip=np.where(has_a, own, -1))
        columns = [pa.array(a, mask=~has_a), pa.array(b, mask=where < 0)]
        return pa.StructArray.from_arrays(columns, names=["a", "b"])

    return ab


def _scores_arrow(points: DataFrame, moments: list[Moments], dim: int, point: str, cluster: str) -> DataFrame:
    ab = _ab_udf(points.sparkSession, moments, dim)
    staged = points.select("*", ab(F.col(point), F.col(cluster)).alias("_ab"))
    return staged.select(*[F.col(c) for c in points.columns], F.col("_ab.a").alias("a"), F.col("_ab.b").alias("b"))


def _lookup(moments: list[Moments]) -> Column:
    """The moments as one array literal."""
    entries = [
        F.struct(
            F.lit(m.cluster).alias("cluster"), F.lit(m.n).alias("n"), F.array(*map(F.lit, m.mean)).alias("mean"),
            F.lit(m.m2).alias("m2"), F.lit(m.norm).alias("norm"),
        )
        for m in moments
    ]
    return F.array(*entries)


def _scores_lambda(points: DataFrame, moments: list[Moments], dim: int, point: str, cluster: str) -> DataFrame:
    p, c = F.col(point), F.col(cluster)

    def sqdist(q: Column) -> Column:
        return F.aggregate(F.zip_with(F.col("_p"), q, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)

    avg_dist = F.transform(
        F.col("_mom"),
        lambda e: F.struct(
            e["cluster"].alias("cluster"), ((e["n"] * sqdist(e["mean"]) + e["m2"]) / e["norm"]).alias("d")
        ),
    )
    own = F.array_max(F.transform(F.filter(F.col("_ad"), lambda e: e["cluster"] == c), lambda e: e["d"]))
    other = F.array_min(F.transform(F.filter(F.col("_ad"), lambda e: e["cluster"] != c), lambda e: e["d"]))
    return (
        points.withColumn("_p", F.when(F.size(p) != dim, _dim_error(dim)).otherwise(p))
        .withColumn("_mom", _lookup(moments))
        .withColumn("_ad", avg_dist)
        .withColumn("a", own)
        .withColumn("b", other)
        .drop("_p", "_mom", "_ad")
    )


def silhouette_scores(
    points: DataFrame,
    moments: DataFrame,
    norm: Column,
    dim: int,
    point: str = "point",
    cluster: str = "cluster",
    method: str = "auto",
    block_clusters: int = DEFAULT_BLOCK_CLUSTERS,
) -> DataFrame:
    """Add ``a``, ``b`` and ``s`` to every point, given the sample moments."""
    return _score_blocks(points, moment_blocks(moments, norm, cluster, block_clusters, dim), dim, point, cluster, method)


def _score_blocks(
    points: DataFrame, blocks: Iterable[list[Moments]], dim: int, point: str, cluster: str, method: str
) -> DataFrame:
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    scored = None
    for block in blocks:
        way = method
        if way == "auto":
            way = "codegen" if len(block) * dim <= CODEGEN_MAX_TERMS else "arrow"
        score = {"codegen": _scores_codegen, "arrow": _scores_arrow, "lambda": _scores_lambda}[way]
        if scored is None:
            scored = score(points, block, dim, point, cluster)
            continue
        # written before the next block, so that one block is in memory at a time
        before = materialize(scored).withColumnsRenamed({"a": "_a", "b": "_b"})
        both = score(before, block, dim, point, cluster)
        a, b = F.greatest("a", "_a"), F.least("b", "_b")  # both pass over nulls
        scored = both.select(*[F.col(c) for c in points.columns], a.alias("a"), b.alias("b"))
    if scored is None:
        scored = points.withColumns({c: F.lit(None).cast("double") for c in ("a", "b")})
    scored = scored.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("a", "b")})
    return scored.withColumn("s", silhouette_value("a", "b"))


def _sums_udf(spark, moments: list[Moments], dim: int):
    model = spark.sparkContext.broadcast(_arrays(moments, dim, scaled=False))

    @F.arrow_udf("array<double>")
    def sums(points: pa.Array) -> pa.Array:
        ids, mu, weight, offset = model.value
        p = point_matrix(points, dim)
        out = np.empty((len(p), len(ids)))
        for j in range(len(ids)):
            out[:, j] = scaled_distance(p, mu[j], weight[j], offset[j])
        starts = np.arange(len(p) + 1, dtype=np.int32) * len(ids)
        return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(out.ravel()))

    return sums


def distance_sums_by_cluster(
    points: DataFrame,
    moments: DataFrame,
    dim: int,
    point: str = "point",
    cluster: str = "cluster",
    block_clusters: int = DEFAULT_BLOCK_CLUSTERS,
    method: str = "auto",
) -> DataFrame:
    """One row per (point, sampled cluster): ``dist_sum`` = sum of squared
    distances from the point to that cluster's sample points.

    k rows per point (never one per pair of points); the input columns are
    kept.  The moment rows are shipped in the plan in blocks of at most
    ``SUMS_BLOCK`` clusters (the k sums of a batch of points lie in memory
    together): generated code for small k*d, else Arrow batches.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    p = F.col(point)
    checked = F.when(F.size(p) != dim, _dim_error(dim))
    parts = []
    for rows in moment_blocks(moments, F.col("n"), cluster, min(block_clusters, SUMS_BLOCK), dim):
        way = method
        if way == "auto":
            way = "codegen" if len(rows) * dim <= CODEGEN_MAX_TERMS else "arrow"
        if way == "lambda":
            one = lambda e: e["n"] * F.aggregate(
                F.zip_with(p, e["mean"], lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, v: acc + v
            ) + e["m2"]
            arr = checked.otherwise(F.transform(_lookup(rows), one))
        elif way == "codegen":
            arr = checked.otherwise(F.array(*[
                F.lit(m.n) * _tree_sum([(p[i] - F.lit(m.mean[i])) * (p[i] - F.lit(m.mean[i])) for i in range(dim)])
                + F.lit(m.m2)
                for m in rows
            ]))
        else:
            arr = _sums_udf(points.sparkSession, rows, dim)(p)
        ids = F.array(*[F.lit(m.cluster) for m in rows])
        staged = points.select("*", F.posexplode(arr).alias("_j", "dist_sum"))
        parts.append(
            staged.select(*[F.col(c) for c in points.columns], ids[F.col("_j")].alias("sample_cluster"), "dist_sum")
        )
    if not parts:
        return points.select("*", F.lit(None).cast("int").alias("sample_cluster"),
                             F.lit(None).cast("double").alias("dist_sum")).where(F.lit(False))
    return reduce(DataFrame.unionByName, parts)


def mean_silhouette(scored: DataFrame, name: str = "silhouette") -> DataFrame:
    """(silhouette = mean of s, n_points); null silhouette on no points."""
    return scored.agg(F.avg("s").alias(name), F.count(F.lit(1)).alias("n_points"))


def exact_silhouette_scores(
    points: DataFrame,
    dim: int | None = None,
    point: str = "point",
    cluster: str = "cluster",
    method: str = "auto",
    block_clusters: int = DEFAULT_BLOCK_CLUSTERS,
) -> DataFrame:
    """a, b, s for every point against all points (sample = everything)."""
    dim = vector_dim(points, point) if dim is None else dim
    moments = cluster_moments(points, dim, point, cluster)
    return silhouette_scores(points, moments, F.col("n"), dim, point, cluster, method, block_clusters)


def approx_silhouette_scores(
    points: DataFrame,
    t: int,
    seed: int,
    normalizer: str = "expected",
    dim: int | None = None,
    id_col: str = "id",
    point: str = "point",
    cluster: str = "cluster",
    method: str = "auto",
    block_clusters: int = DEFAULT_BLOCK_CLUSTERS,
    draw: str = "xxhash64",
) -> DataFrame:
    """a, b, s for every point against a stratified sample of at most t per cluster."""
    if normalizer not in NORMALIZERS:
        raise ValueError(f"normalizer must be one of {NORMALIZERS}")
    dim = vector_dim(points, point) if dim is None else dim
    sample = stratified_sample(points, t, seed, id_col, cluster, draw=draw)
    if normalizer == "expected":
        moments = cluster_moments(sample, dim, point, cluster, size_col="cluster_size")
        norm = F.least(F.lit(float(t)), F.col("size").cast("double"))
    else:
        moments = cluster_moments(sample, dim, point, cluster)
        norm = F.col("n")
    return silhouette_scores(points, moments, norm, dim, point, cluster, method, block_clusters)


def sample_silhouette_scores(
    points: DataFrame,
    t: int,
    seed: int,
    dim: int | None = None,
    id_col: str = "id",
    point: str = "point",
    cluster: str = "cluster",
    method: str = "auto",
    block_clusters: int = DEFAULT_BLOCK_CLUSTERS,
    draw: str = "xxhash64",
) -> DataFrame:
    """a, b, s for every *sampled* point against the sample (actual sizes).

    The sample (at most t rows per cluster, k checked) is written once to
    the checkpoint folder: its moments and its scores then read that small
    table instead of re-running the full-data sampling passes.
    """
    dim = vector_dim(points, point) if dim is None else dim
    sample = stratified_sample(points, t, seed, id_col, cluster, draw=draw)
    sample = materialize(sample.select(*points.columns))
    moments = cluster_moments(sample, dim, point, cluster)
    return silhouette_scores(sample, moments, F.col("n"), dim, point, cluster, method, block_clusters)


def exact_silhouette(points: DataFrame, **kwargs) -> DataFrame:
    """Q2x: mean silhouette of all points against all points."""
    return mean_silhouette(exact_silhouette_scores(points, **kwargs))


def approx_silhouette(points: DataFrame, t: int, seed: int, **kwargs) -> DataFrame:
    """Q2: mean silhouette of all points against the sample (approxSilhFull)."""
    return mean_silhouette(approx_silhouette_scores(points, t, seed, **kwargs))


def exact_silhouette_sample(points: DataFrame, t: int, seed: int, **kwargs) -> DataFrame:
    """Q3: mean silhouette of the sample against itself (exactSilhSample)."""
    return mean_silhouette(sample_silhouette_scores(points, t, seed, **kwargs))


def approx_silhouettes(
    points: DataFrame,
    size_of: dict[str, int],
    seed: int,
    normalizer: str = "expected",
    dim: int | None = None,
    id_col: str = "id",
    point: str = "point",
    method: str = "auto",
    block_clusters: int = DEFAULT_BLOCK_CLUSTERS,
    draw: str = "xxhash64",
) -> DataFrame:
    """``approx_silhouette`` of several labellings of the same points in common passes.

    ``size_of`` gives the sample size t of each label column of ``points``.
    One row per label column: (labelling, t, silhouette, n_points).  One
    aggregate for all cluster sizes, one sample, one aggregate for all
    moments and one scoring pass, however many labellings there are.
    """
    if normalizer not in NORMALIZERS:
        raise ValueError(f"normalizer must be one of {NORMALIZERS}")
    dim = vector_dim(points, point) if dim is None else dim
    labellings = list(size_of)
    sample = stratified_samples(points.select(id_col, point, *labellings), size_of, seed, id_col, draw=draw)
    keyed = sample.withColumn("_group", F.struct("labelling", "cluster", "t"))
    moments = cluster_moments(keyed, dim, point, "_group", size_col="cluster_size")
    norm = F.least("_group.t", "size") if normalizer == "expected" else F.col("n")
    table = materialize(moments.select("_group.labelling", "_group.cluster", "n", "mean", "m2", norm.cast("double").alias("norm")))
    limit = model_block_rows(block_clusters, dim)
    rows = table.limit(limit + 1).collect()
    scored = points.select(point, *labellings)
    if method == "auto":  # one way for all, so that they share a projection
        most = max(Counter(r["labelling"] for r in rows).values(), default=0)
        method = "codegen" if most * dim * len(labellings) <= CODEGEN_MAX_TERMS else "arrow"
    for place, name in enumerate(labellings):
        if len(rows) <= limit:  # one block holds the moments of all labellings
            own = [Moments(r["cluster"], float(r["n"]), tuple(r["mean"]), r["m2"], r["norm"]) for r in rows if r["labelling"] == name]
            blocks = [sorted(own, key=lambda m: m.cluster)] if own else []
        else:
            own = table.where(F.col("labelling") == name).drop("labelling")
            blocks = moment_blocks(own, F.col("norm"), "cluster", block_clusters, dim)
        scored = _score_blocks(scored, blocks, dim, point, name, method)
        scored = scored.withColumnRenamed("s", f"_s{place}").drop("a", "b")
    # one partial aggregate per task holds the sums of all labellings
    means = scored.agg(F.count(F.lit(1)).alias("n_points"), *[F.avg(f"_s{k}").alias(f"_s{k}") for k in range(len(labellings))])
    rows = F.array(*[
        F.struct(F.lit(c).alias("labelling"), F.lit(size_of[c]).alias("t"), F.col(f"_s{k}").alias("silhouette"), "n_points")
        for k, c in enumerate(labellings)
    ])
    return means.select(F.inline(rows))


def silhouette_report(
    points: DataFrame,
    t: int,
    seed: int,
    dim: int | None = None,
    id_col: str = "id",
    point: str = "point",
    cluster: str = "cluster",
    method: str = "auto",
    block_clusters: int = DEFAULT_BLOCK_CLUSTERS,
    draw: str = "xxhash64",
) -> DataFrame:
    """Both silhouettes of one and the same sample, in one row.

    (approx_silhouette of all points, n_points, sample_silhouette, n_sample).
    The sample is drawn once and written; its moments, computed once, serve
    all points with the expected sizes and the sample with the actual ones.
    """
    dim = vector_dim(points, point) if dim is None else dim
    sample = stratified_sample(points, t, seed, id_col, cluster, draw=draw)
    sample = materialize(sample.select(*points.columns, F.col("cluster_size").alias("_size")))
    moments = materialize(cluster_moments(sample, dim, point, cluster, size_col="_size"))
    expected = F.least(F.lit(float(t)), F.col("size").cast("double"))
    everyone = silhouette_scores(points, moments, expected, dim, point, cluster, method, block_clusters)
    sampled = silhouette_scores(sample, moments, F.col("n"), dim, point, cluster, method, block_clusters)
    both = everyone.select("s", F.lit(False).alias("sampled")).unionByName(sampled.select("s", F.lit(True).alias("sampled")))
    of_sample = F.col("sampled")
    return both.agg(
        F.avg(F.when(~of_sample, F.col("s"))).alias("approx_silhouette"),
        F.count_if(~of_sample).alias("n_points"),
        F.avg(F.when(of_sample, F.col("s"))).alias("sample_silhouette"),
        F.count_if(of_sample).alias("n_sample"),
    )
