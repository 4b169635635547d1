"""Longest-processing-time sharding: groups that stay together, by size, to the least-loaded shard.

Law ``bytes``: the shards' sizes come out near equal.  The number of
groups grows with the corpus, so the heap never sees them all: groups
above ``total / heavy_parts`` bytes are items of their own (at most
``heavy_parts`` of them), the others fall by hash into ``bundles`` items
of ordinary and ``bundles`` of a hundredth of that size, which level the
shards at the end.  The driver's heap thus works on at most
``heavy_parts + 2 * bundles`` (key, bytes) pairs at any corpus size.

Defined results: null text counts as empty (8 bytes with the frame) and
is one group with the empty texts; null ids are kept; repeated rows are
members of one group, each with a slot of its own; ties of the heap go to
the lower shard, of the sort to the smaller item key; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheaf.llm.common import write_scratch

#: Rows numbered together in one window group.
SLOT_ROWS = 50_000
FRAME_BYTES = 8


def longest_first(items: list[tuple[str, int]], shards: int) -> list[int]:
    """Shard of each (key, size): largest first, to the least-loaded shard."""
    heap = [(0, s) for s in range(shards)]
    out = [0] * len(items)
    for i in sorted(range(len(items)), key=lambda i: (-items[i][1], items[i][0])):
        load, shard = heapq.heappop(heap)
        out[i] = shard
        heapq.heappush(heap, (load + items[i][1], shard))
    return out


def shard_by_size(
    docs: DataFrame,
    shards: int = 24,
    group: str = "text",
    heavy_parts: int = 10_000,
    bundles: int = 4_096,
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot); ``group`` names the column whose
    equal values stay together (any type that casts to string)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    key = text if group == "text" else F.coalesce(F.col(group).cast("string"), F.lit(""))
    rows = write_scratch(
        docs.select(
            "doc_id",
            (F.octet_length(text) + F.lit(FRAME_BYTES)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.md5(key.cast("binary"))).alias("_group"),
        ),
        "shard-rows",
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    sizes = rows.groupBy("_group").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    draw = F.pmod(F.xxhash64("_group"), F.lit(101 * bundles))
    bundle = F.when(draw < bundles, F.concat(F.lit("f"), draw)).otherwise(F.concat(F.lit("c"), draw % bundles))
    heavy = F.col("bytes") * heavy_parts > F.lit(total)
    items = write_scratch(
        sizes.groupBy(F.when(heavy, F.concat(F.lit("g"), F.hex("_group"))).otherwise(bundle).alias("_item"))
        .agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")),
        "shard-items",
    )
    listed = items.select("_item", "bytes").collect()  # at most heavy_parts + 2 * bundles rows
    placed = longest_first([(r[0], r[1]) for r in listed], shards)
    plan = spark.createDataFrame(
        [(r[0], s) for r, s in zip(listed, placed)], "_item string, shard int"
    ).join(items, "_item").select(
        "_item", "shard", F.ceil(F.col("n") / SLOT_ROWS).cast("int").alias("_parts")
    )
    plan = write_scratch(plan, "shard-plan")
    own = F.broadcast(plan.where(F.col("_item").startswith("g")).select(F.col("_item").alias("_heavy")))
    placed_rows = (
        rows.join(own, F.concat(F.lit("g"), F.hex("_group")) == F.col("_heavy"), "left")
        .withColumn("_item", F.coalesce("_heavy", bundle))
        .join(F.broadcast(plan), "_item")  # the same bound
        .withColumn("_part", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.col("_parts")).cast("int"))
        .select("doc_id", "size", "text_crc32", "shard", "_item", "_part")
    )
    # Gapless slots: the count of each part, summed within the shard, then numbers within the part.
    before = Window.partitionBy("shard").orderBy("_item", "_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed_rows.groupBy("shard", "_item", "_part").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select("_item", "_part", "_start")
    )
    within = Window.partitionBy("_item", "_part").orderBy("doc_id", "text_crc32")
    return (
        placed_rows.withColumn("_k", F.row_number().over(within))
        .join(starts, ["_item", "_part"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("_start") + F.col("_k") - 1).alias("slot"))
    )
