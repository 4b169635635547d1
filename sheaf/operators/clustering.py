"""k-means and nearest-centre assignment.

Training is Spark ML's ``KMeans`` (k-means|| initialisation, Lloyd
iterations), which is distributed and keeps only the k centres on the
driver.  ``ml`` rejects k = 1, which is the mean vector, handled here.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.operators.joins import materialize
from sheaf.operators.pruned import MIN_MEANS, PrunedMeans
from sheaf.operators.sampling import DEFAULT_BLOCK_CLUSTERS, model_block_rows
from sheaf.operators.silhouette import CODEGEN_MAX_TERMS, point_matrix, scaled_distance, vector_dim


@dataclass
class SingleCluster:
    """The k = 1 model: every point in cluster 0, whose centre is their mean (empty for no points)."""

    centre: tuple[float, ...] = ()

    def transform(self, df: DataFrame, prediction: str = "cluster") -> DataFrame:
        return df.withColumn(prediction, F.lit(0))


def kmeans_fit(
    points: DataFrame,
    k: int,
    max_iter: int,
    seed: int = 1,
    point: str = "point",
):
    """Fit k-means on an ``array<double>`` or vector column; returns a model with ``transform``.

    A persisted frame with a vector column is fitted as it is: Spark ML then
    keeps only the norms and no second copy of the points.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    if not _is_vector(points, point):
        points, point = points.select(array_to_vector(point).alias("features")), "features"
    if k == 1:
        if points.isEmpty():
            return SingleCluster()
        mean = points.select(Summarizer.mean(F.col(point)).alias("mean")).first()["mean"]
        return SingleCluster(tuple(float(x) for x in mean))
    return KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol=point).fit(points)


def _is_vector(points: DataFrame, point: str) -> bool:
    return isinstance(points.schema[point].dataType, VectorUDT)


def kmeans_assign(model, points: DataFrame, point: str = "point", prediction: str = "cluster") -> DataFrame:
    """Label every point with the index of its closest centre (column ``prediction``)."""
    if isinstance(model, SingleCluster):
        return model.transform(points, prediction)
    model = model.copy().setPredictionCol("_prediction").setFeaturesCol("_features")
    features = F.col(point) if _is_vector(points, point) else array_to_vector(point)
    out = model.transform(points.withColumn("_features", features))
    return out.withColumn(prediction, F.col("_prediction").cast("int")).drop("_features", "_prediction")


def kmeans_centres(spark, model) -> DataFrame:
    """(cluster, centre) of a fitted model: its k centres, already on the driver."""
    centres = [model.centre] if isinstance(model, SingleCluster) else model.clusterCenters()
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(centres)]
    return spark.createDataFrame(rows, "cluster int, centre array<double>")


def centroids(points: DataFrame, dim: int, point: str = "point", cluster: str = "cluster") -> DataFrame:
    """(cluster, centre:array<double>) – mean vector of each label."""
    p = F.col(point)
    m = points.groupBy(cluster).agg(*[F.avg(p[i]).alias(f"_c{i}") for i in range(dim)])
    return m.select(cluster, F.array(*[F.col(f"_c{i}") for i in range(dim)]).alias("centre"))


def _centre_blocks(centres: DataFrame, block_rows: int) -> Iterator[list[tuple[int, list[float]]]]:
    """The centres in blocks of at most ``block_rows`` rows, by ascending id within a block."""
    rows = centres.limit(block_rows + 1).collect()
    source = iter(rows) if len(rows) <= block_rows else materialize(centres).toLocalIterator()
    while block := list(islice(source, block_rows)):
        yield sorted((r[0], [float(x) for x in r[1]]) for r in block)


def _nearest_codegen(p: Column, cents: list[tuple[int, list[float]]], dim: int) -> Column:
    entries = []
    for cid, c in cents:
        terms = [(p[i] - F.lit(c[i])) * (p[i] - F.lit(c[i])) for i in range(dim)]
        while len(terms) > 1:
            terms = [terms[i] + terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
        entries.append(F.struct(terms[0].alias("d"), F.lit(cid).cast("int").alias("cluster")))
    return F.array_min(F.array(*entries))


def _nearest_arrow(spark, cents: list[tuple[int, list[float]]], dim: int):
    ids = np.array([cid for cid, _ in cents], dtype=np.int32)
    mat = np.array([c for _, c in cents], dtype=np.float64).reshape(len(cents), dim)
    if len(ids) >= MIN_MEANS:
        return _nearest_pruned(spark, ids, mat, dim)
    model = spark.sparkContext.broadcast((ids, mat))

    @F.arrow_udf("d double, cluster int")
    def nearest(points: pa.Array) -> pa.Array:
        cid, cen = model.value
        p = point_matrix(points, dim)
        best, where = np.full(len(p), np.nan), np.zeros(len(p), dtype=np.int64)
        for j in range(len(cen)):
            d = scaled_distance(p, cen[j], 1.0, 0.0)
            closer = (d < best) | (np.isnan(best) & ~np.isnan(d))  # NaN is above every number; ties stay
            best[closer], where[closer] = d[closer], j
        return pa.StructArray.from_arrays([pa.array(best), pa.array(cid[where])], names=["d", "cluster"])

    return nearest


def _nearest_pruned(spark, ids: np.ndarray, centres: np.ndarray, dim: int):
    """As ``_nearest_arrow`` for many centres: groups of centres are passed over by distance bounds."""
    model = spark.sparkContext.broadcast((ids, PrunedMeans(centres, np.ones(len(ids)), np.zeros(len(ids)))))

    @F.arrow_udf("d double, cluster int")
    def nearest(points: pa.Array) -> pa.Array:
        cid, means = model.value
        best, where = means.best(point_matrix(points, dim))
        return pa.StructArray.from_arrays([pa.array(best), pa.array(cid[where])], names=["d", "cluster"])

    return nearest


def _nearest_lambda(p: Column, cents: list[tuple[int, list[float]]]) -> Column:
    lookup = F.array(*[
        F.struct(F.array(*map(F.lit, c)).alias("centre"), F.lit(cid).cast("int").alias("cluster")) for cid, c in cents
    ])
    dist = F.transform(
        lookup,
        lambda e: F.struct(
            F.aggregate(
                F.zip_with(p, e["centre"], lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, v: a + v
            ).alias("d"),
            e["cluster"].alias("cluster"),
        ),
    )
    return F.array_min(dist)


def assign_nearest(
    points: DataFrame,
    centres: DataFrame,
    point: str = "point",
    centre: str = "centre",
    cluster: str = "cluster",
    out: str = "nearest",
    block_centres: int = DEFAULT_BLOCK_CLUSTERS,
    method: str = "auto",
) -> DataFrame:
    """Add the id of the closest centre (squared Euclidean by differences; ties to the smaller id).

    The centres reach the driver and the tasks in blocks (``block_centres``
    rows, 2^24 values); between two blocks the points with their best centre
    so far are written, so any number of centres works.  Each point computes
    its distances in one projection per block (generated code for small k*d,
    Arrow batches otherwise, or array lambdas), so no point-centre pair is
    ever a row and the points are not shuffled.
    """
    dim = vector_dim(points, point)
    best = None
    for cents in _centre_blocks(centres.select(cluster, centre), model_block_rows(block_centres, dim)):
        dim = len(cents[0][1])
        if any(len(c) != dim for _, c in cents):
            raise ValueError("centres differ in length")
        way = method
        if way == "auto":
            way = "codegen" if len(cents) * dim <= CODEGEN_MAX_TERMS else "arrow"
        p = F.col(point)
        checked = F.when(F.size(p) != dim, F.raise_error(F.lit(f"points must all have {dim} coordinates")))
        if way == "codegen":
            found = checked.otherwise(_nearest_codegen(p, cents, dim))
        elif way == "lambda":
            found = checked.otherwise(_nearest_lambda(p, cents))
        else:
            found = _nearest_arrow(points.sparkSession, cents, dim)(p)
        if best is None:
            best = points.withColumn("_best", found)
        else:
            # written before the next block, so that one block is in memory at a time
            step = materialize(best).withColumn("_next", found)
            best = step.withColumn("_best", F.least("_best", "_next")).drop("_next")
    if best is None:
        return points.withColumn(out, F.lit(None).cast("int"))
    return best.select(*points.columns, F.col("_best.cluster").cast("int").alias(out))
