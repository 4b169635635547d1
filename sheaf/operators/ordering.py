"""Ranks over a whole table or inside large groups, without a window task per group.

The rows are sorted once into range partitions by (group, order) and
written with their place; the places of the first row of each (partition,
group) and the rows of the group in earlier partitions (at most one row
per partition and group) give every row its rank.  No task holds more
than a range partition, whatever the size of a group, and the write fixes
the layout, so a retried task sees the same places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheaf.operators.joins import broadcast_if_small, materialize

_PARTITION_SHIFT = 33  # monotonically_increasing_id: partition above, row in partition below


def number_in_order(df: DataFrame, order: list[Column | str], group: str | None = None, out: str = "rank") -> DataFrame:
    """``df`` with ``out``: the 1-based place of each row in ``order``, within its ``group`` if one is named.

    Null groups form a group of their own; rows equal in the whole order
    get consecutive places in no fixed order; an empty table stays empty.
    """
    keys = [*([group] if group else []), *order]
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = materialize(placed.select("*", F.monotonically_increasing_id().alias("_place")))
    key = F.struct(F.col(group) if group else F.lit(0)).alias("_group")  # a struct equals itself, a null does not
    rows = placed.select("*", F.shiftright("_place", _PARTITION_SHIFT).alias("_part"), key)
    starts = rows.groupBy("_part", "_group").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.partitionBy("_group").orderBy("_part")) - F.col("_rows")
    side, _ = broadcast_if_small(starts.select("_part", "_group", (before - F.col("_first") + 1).alias("_shift")))
    joined = rows.join(side, ["_part", "_group"])
    return joined.select((F.col("_place") + F.col("_shift")).alias(out), *[F.col(c) for c in df.columns])
