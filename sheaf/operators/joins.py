"""Materialised intermediates and size-checked broadcast.

``materialize`` writes a DataFrame once as a Parquet table in the shared
folder named by ``spark.checkpoint.dir`` and reads it back: the lineage is
cut (a lost executor never recomputes it), later branches scan compact
columnar files instead of re-running the producing joins, and the planner
sees real file sizes.

A side whose size grows with the data (one row per user, per word, ...)
is never broadcast on faith: it is materialised, its rows and bytes are
counted with a bound, and it is broadcast only when both are within their
bounds; otherwise the caller gets the plain side for a shuffle join.
``join_group_values`` joins one row per group back to the rows of the
groups, with the hot groups split off that shuffle join.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaf.session import ensure_checkpoint_dir

DEFAULT_BROADCAST_MAX_ROWS = 1_000_000
DEFAULT_BROADCAST_MAX_BYTES = 256 << 20
# A group with more than this share of all rows is "hot"; fewer rows make it hot
# when the shuffle has many partitions (see ``hot_share``).
DEFAULT_HOT_FRACTION = 0.01


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into a Parquet table under the checkpoint directory."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sheaf-tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


SCRATCH_FOLDERS = ("sheaf-tables", "sheaf-text")


def drop_materialized(spark) -> bool:
    """Delete what this application wrote to scratch: the tables of
    ``materialize`` and the text files of ``write_text_lines`` without a path.

    They live in the application's own subfolder of the checkpoint
    directory; call this once the results that read them are written
    (a DataFrame still reading them fails afterwards).  Works on any
    Hadoop-compatible file system.  True when something was deleted.
    """
    sc = spark.sparkContext
    root = ensure_checkpoint_dir(spark).rstrip("/")
    deleted = False
    for folder in SCRATCH_FOLDERS:
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{root}/{folder}")
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        deleted = bool(fs.delete(path, True)) or deleted
    return deleted


def _width(name: str, dtype: T.DataType) -> Column:
    """Bytes of a value in a row, estimated from its type and length."""
    col = F.col(name)
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(col), F.lit(0)) + 24
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, (T.NumericType, T.BooleanType)):
        return F.coalesce(F.size(col), F.lit(0)) * 8 + 24
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0)) + 24
    return F.lit(16)


def broadcast_if_small(
    df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS, max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES
) -> tuple[DataFrame, bool]:
    """(side to join with, whether it is broadcast).

    The count stops at ``max_rows + 1``, so checking a large side costs no
    more than reading that many rows of the materialised result.
    """
    side = materialize(df)
    width = sum((_width(f.name, f.dataType) for f in side.schema.fields), F.lit(0)).cast("long")
    found = side.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("bytes")).first()
    small = found["rows"] <= max_rows and (found["bytes"] or 0) <= max_bytes
    return (F.broadcast(side) if small else side), small


def hot_share(spark, hot_fraction: float | None = None) -> float:
    """Share of all rows above which a group is split off a shuffle join.

    Twice the even share of a shuffle partition, at most ``DEFAULT_HOT_FRACTION``:
    so at most half as many groups as shuffle partitions (or 100) are hot.
    """
    if hot_fraction is None:
        return min(DEFAULT_HOT_FRACTION, 2.0 / int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    if not 0 < hot_fraction <= 1:
        raise ValueError("hot_fraction must be above 0 and at most 1")
    return float(hot_fraction)


def join_group_values(
    rows: DataFrame,
    values: DataFrame,
    keys: list[str],
    count: str,
    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
    hot_fraction: float | None = None,
) -> DataFrame:
    """Join ``values`` (one row per group, with its number of rows in ``count``) back to ``rows``.

    All values are broadcast when they are within the bound.  Beyond it,
    the hot groups (at most 1 / share of them) are broadcast and joined
    map-side, and the other rows go through a shuffle join in which no
    group holds more than that share.  The keys hold no nulls.
    """
    values, small = broadcast_if_small(values, broadcast_max_rows)
    if small:
        return rows.join(values, keys)
    limit = values.agg(F.sum(count).cast("double").alias("t")).scalar() * F.lit(hot_share(rows.sparkSession, hot_fraction))
    hot = F.broadcast(values.where(F.col(count) > limit))
    cold = values.where(F.col(count) <= limit)
    cold_rows = rows.join(hot.select(*keys), keys, "left_anti").join(cold, keys)
    return rows.join(hot, keys).unionByName(cold_rows)
