"""Per-cluster (stratified) sampling of labelled points.

A point of cluster C is kept with probability ``min(t / |C|, 1)``, then at
most ``t`` points per cluster are kept.  When ``t >= |C|`` the whole
cluster is kept, so the sample is deterministic there.

Scale notes.  Cluster sizes are one partial aggregate (one row per
cluster).  They are broadcast while a count shows them within the bound:
a hash lookup per point, no shuffle of the points.  Beyond it, the sizes
of hot clusters are broadcast and the other points go through a shuffle
join in which no cluster is hot; any number of clusters works.

The cap is ``row_number() <= t`` over the cluster window, which Spark plans
with a ``WindowGroupLimit`` on the map side (at most ``t`` rows per cluster
and task are shuffled) while ``t`` is within
``spark.sql.optimizer.windowGroupLimitThreshold`` (1000 by default).  For a
larger ``t`` the place of a row in its cluster comes from a range-partitioned
sort (``ordering.number_in_order``), so no task holds a whole cluster.

A null cluster label fails the query, here and in the silhouettes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheaf.functions.random import seeded_uniform
from sheaf.operators.joins import DEFAULT_BROADCAST_MAX_ROWS, join_group_values
from sheaf.operators.ordering import number_in_order

# Rows and values of a k x d model (cluster means, centres) that reach the driver
# and the executors at a time; a larger model is evaluated block by block.
DEFAULT_BLOCK_CLUSTERS = 100_000
DEFAULT_BLOCK_VALUES = 1 << 24


def model_block_rows(max_rows: int, dim: int | None, max_values: int = DEFAULT_BLOCK_VALUES) -> int:
    """Rows of a k x ``dim`` model in one block: at most ``max_rows`` and ``max_values`` values."""
    return max_rows if not dim else min(max_rows, max(1, max_values // dim))


def cluster_sizes(points: DataFrame, cluster: str = "cluster") -> DataFrame:
    """(cluster, size) – the number of points per label."""
    return points.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"))


def _no_null(cluster: str, value: Column) -> Column:
    return F.when(F.col(cluster).isNull(), F.raise_error(F.lit(f"null label in {cluster}"))).otherwise(value)


def attach_cluster_size(
    points: DataFrame, cluster: str = "cluster", broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS
) -> DataFrame:
    """Add ``cluster_size`` (the size of the point's own cluster); a null label fails the query.

    A hash lookup per point while the sizes are within the broadcast bound,
    else a shuffle join with hot clusters split off.
    """
    checked = points.withColumn(cluster, _no_null(cluster, F.col(cluster)))
    sizes = cluster_sizes(checked, cluster).withColumnRenamed("size", "cluster_size")
    joined = join_group_values(checked, sizes, [cluster], "cluster_size", broadcast_max_rows)
    return joined.select(*points.columns, "cluster_size")


def attach_normalizer(
    points: DataFrame, t: int, cluster: str = "cluster", broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS
) -> DataFrame:
    """Add ``norm = min(t, size of the point's cluster)`` through the same lookup."""
    sized = attach_cluster_size(points, cluster, broadcast_max_rows)
    norm = F.least(F.lit(int(t)).cast("bigint"), F.col("cluster_size")).alias("norm")
    return sized.select(*points.columns, norm)


def bernoulli_sample(
    points: DataFrame,
    t: int,
    seed: int,
    id_col: str = "id",
    size_col: str = "cluster_size",
    draw: str = "xxhash64",
) -> DataFrame:
    """Keep a row when ``u < min(t / size, 1)``; ``u`` is a seeded hash of the id."""
    keep = F.least(F.lit(float(t)) / F.col(size_col), F.lit(1.0))
    return points.withColumn("u", seeded_uniform(id_col, seed, draw)).where(F.col("u") < keep)


def cap_per_cluster(
    df: DataFrame, t: int, cluster: str = "cluster", order: tuple[str, ...] = ("u", "id")
) -> DataFrame:
    """At most ``t`` rows per cluster, the first ones in ``order`` (ascending, nulls first)."""
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if t > threshold:  # Spark plans no map-side limit here, and a group could fill a task
        numbered = number_in_order(df, list(order), cluster, "_rn")
    else:
        numbered = df.withColumn("_rn", F.row_number().over(Window.partitionBy(cluster).orderBy(*order)))
    return numbered.where(F.col("_rn") <= t).select(*df.columns)


def stratified_sample(
    points: DataFrame,
    t: int,
    seed: int,
    id_col: str = "id",
    cluster: str = "cluster",
    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
    draw: str = "xxhash64",
) -> DataFrame:
    """Bernoulli at ``min(t/|C|, 1)`` per cluster, then capped at ``t`` per cluster.

    The result keeps the input columns plus ``cluster_size`` and ``u``.
    Ids must be stable and unique (table keys), so the sample is the same
    on every run and after any task retry.  ``draw`` picks the hash behind
    the uniform draw (``xxhash64`` fast, ``md5`` reproducible in SQL).
    """
    if t < 1:
        raise ValueError("sample size t must be >= 1")
    sized = attach_cluster_size(points, cluster, broadcast_max_rows)
    return cap_per_cluster(bernoulli_sample(sized, t, seed, id_col, draw=draw), t, cluster, ("u", id_col))


def stratified_samples(
    points: DataFrame,
    size_of: dict[str, int],
    seed: int,
    id_col: str = "id",
    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
    draw: str = "xxhash64",
) -> DataFrame:
    """``stratified_sample`` of several labellings of the same points at once.

    ``size_of`` gives the sample size t of each label column.  Returns the
    sampled points once per labelling they are sampled for, with the column's
    name as ``labelling``, its label as ``cluster``, ``t``, ``cluster_size``
    and ``u``; a labelling's sample is the one ``stratified_sample`` draws.
    Sizes of all labellings are one aggregate, draw and cap one window, so
    the points are passed over twice however many labellings there are.
    """
    if not size_of or min(size_of.values()) < 1:
        raise ValueError("sample size t must be >= 1")
    others = [c for c in points.columns if c not in size_of]
    each = F.array(*[
        F.struct(F.lit(c).alias("labelling"), F.lit(t).alias("t"), _no_null(c, F.col(c)).alias("cluster")) for c, t in size_of.items()
    ])
    single = points.select(*others, F.explode(each).alias("_l")).select(*others, "_l.*")
    sizes = single.groupBy("labelling", "cluster").agg(F.count(F.lit(1)).alias("cluster_size"))
    sized = join_group_values(single, sizes, ["labelling", "cluster"], "cluster_size", broadcast_max_rows)
    keep = F.least(F.col("t") / F.col("cluster_size"), F.lit(1.0))
    kept = sized.withColumn("u", seeded_uniform(id_col, seed, draw)).where(F.col("u") < keep)
    group = F.struct("labelling", "cluster")
    most = max(size_of.values())
    threshold = int(points.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if most > threshold:
        numbered = number_in_order(kept.withColumn("_of", group), ["u", id_col], "_of", "_rn")
    else:
        place = F.row_number().over(Window.partitionBy("labelling", "cluster").orderBy("u", id_col))
        numbered = kept.withColumn("_rn", place).where(F.col("_rn") <= most)  # the map-side limit
    return numbered.where(F.col("_rn") <= F.col("t")).select(*others, "labelling", "cluster", "t", "cluster_size", "u")


def normalizers(sizes: DataFrame, t: int, cluster: str = "cluster") -> DataFrame:
    """(cluster, norm = min(t, size)): the expected sample size per cluster."""
    return sizes.select(cluster, F.least(F.lit(int(t)).cast("bigint"), F.col("size")).alias("norm"))


def sample_cluster_sizes(sample: DataFrame, cluster: str = "cluster") -> DataFrame:
    """(cluster, sample_size): the actual number of sampled points per label."""
    return sample.groupBy(cluster).agg(F.count(F.lit(1)).alias("sample_size"))
