"""k-sweep: for each k in [k_start, k_start + h), k-means and its silhouette.

The loop over k runs on the driver because each k-means fit is itself an
iterative distributed job.  The values of k are independent, so up to
``parallel_k`` fits are submitted as concurrent Spark jobs over the same
persisted points: a k-means iteration ends in a driver-side step, and other
k's tasks fill the executors meanwhile.

Everything after the fits is one pass for all k: the models label the
points together (one label column per k, persisted), and sizes, samples,
moments and scores of all k come from common scans
(``silhouette.approx_silhouettes``), so their number does not grow with h.
Points and labels are released afterwards, also after a failure; a lost
executor only costs recomputing its partitions from the Parquet scan.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sheaf.operators.clustering import kmeans_assign, kmeans_fit
from sheaf.operators.silhouette import approx_silhouettes, vector_dim

SWEEP_SCHEMA = T.StructType(
    [
        T.StructField("k", T.IntegerType(), False),
        T.StructField("t", T.IntegerType(), False),
        T.StructField("silhouette", T.DoubleType(), True),
        T.StructField("n_points", T.LongType(), False),
        T.StructField("clustering_seconds", T.DoubleType(), False),
        T.StructField("silhouette_seconds", T.DoubleType(), False),
    ]
)


def label_column(k: int) -> str:
    return f"cluster_{k}"


def label_points(models: dict[int, object], points: DataFrame, point: str = "point") -> DataFrame:
    """``points`` with the label of every model in a column of its own, from one pass."""
    for k, model in models.items():
        points = kmeans_assign(model, points, point=point, prediction=label_column(k))
    return points


def k_sweep_silhouette(
    points: DataFrame,
    k_start: int,
    h: int,
    max_iter: int,
    m: int,
    seed: int = 1,
    id_col: str = "id",
    point: str = "point",
    num_partitions: int | None = None,
    normalizer: str = "expected",
    parallel_k: int = 4,
    draw: str = "xxhash64",
) -> DataFrame:
    """One row per k: (k, t = m div k, approximate silhouette, n_points, timings).

    ``silhouette_seconds`` is the time of the common scoring pass of all k.
    """
    if k_start < 1 or h < 1:
        raise ValueError("k_start and h must be >= 1")
    if m // (k_start + h - 1) < 1:
        raise ValueError("m must be at least the largest k (t = m div k must be >= 1)")
    spark = points.sparkSession
    base = points.select(id_col, point)
    if num_partitions:
        base = base.repartition(num_partitions)
    dim = vector_dim(base, point)
    base = base.select(id_col, array_to_vector(point).alias(point)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        base.count()  # fill the cache once, before concurrent jobs read it

        def fit(k: int) -> tuple:
            started = time.perf_counter()
            return kmeans_fit(base, k, max_iter, seed=seed, point=point), time.perf_counter() - started

        ks = list(range(k_start, k_start + h))
        with ThreadPoolExecutor(max_workers=max(1, min(parallel_k, len(ks)))) as pool:
            fitted = dict(zip(ks, pool.map(fit, ks)))
        started = time.perf_counter()
        labelled = label_points({k: model for k, (model, _) in fitted.items()}, base, point).withColumn(point, vector_to_array(point))
        labelled = labelled.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            size_of = {label_column(k): m // k for k in ks}
            scores = approx_silhouettes(
                labelled, size_of, seed, normalizer=normalizer, dim=dim, id_col=id_col, point=point, draw=draw
            )
            found = {r["labelling"]: r for r in scores.collect()}
        finally:
            labelled.unpersist()
        done = time.perf_counter() - started
        by_k = [(k, found[label_column(k)]) for k in ks]
        rows = [(k, r["t"], r["silhouette"], r["n_points"], fitted[k][1], done) for k, r in by_k]
    finally:
        base.unpersist()
    return spark.createDataFrame(rows, SWEEP_SCHEMA)
