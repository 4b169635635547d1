"""Bindings from the warehouse tables to the four input shapes.

Each binding reads only the columns it needs, so the Parquet scan is
pruned; nothing here triggers a job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# l_returnflag -> cluster label for the lineitem points.
RETURNFLAG_CLUSTER = {"A": 0, "N": 1, "R": 2}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings (product_id, user_id, rating:float) from lineitem joined to orders.

    product = l_partkey, user = o_custkey, rating = l_quantity.  Ids keep
    their bigint type (cheaper to hash and sort than strings).
    """
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("l_partkey").alias("product_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_quantity").cast("float").alias("rating"),
    )


def rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ratings as CSV text lines ``product,user,rating`` (column ``value``)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.concat_ws(",", "l_partkey", "o_custkey", "l_quantity").alias("value")
    )


def labeled_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled points (id, point:array<double>, cluster:int) from embeddings."""
    return read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("embedding").cast("array<double>").alias("point"),
        F.col("label").cast("int").alias("cluster"),
    )


def labeled_point_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as ``x1,...,x64,label`` lines (columns id, value).

    Coordinates are widened to double before formatting, so the text
    round-trips to exactly ``cast(embedding as array<double>)``.
    """
    emb = read_table(spark, sf_dir, "embeddings")
    coords = F.transform(F.col("embedding").cast("array<double>"), lambda x: x.cast("string"))
    return emb.select(
        F.col("vec_id").alias("id"),
        F.concat_ws(",", coords, F.col("label").cast("string")).alias("value"),
    )


def point_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings without label as space-separated lines (columns id, value)."""
    emb = read_table(spark, sf_dir, "embeddings")
    coords = F.transform(F.col("embedding").cast("array<double>"), lambda x: x.cast("string"))
    return emb.select(F.col("vec_id").alias("id"), F.concat_ws(" ", coords).alias("value"))


def lineitem_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume binding: point = (quantity, discount, tax), cluster from the return flag."""
    flag = F.col("l_returnflag")
    expr = None
    for code, label in RETURNFLAG_CLUSTER.items():
        expr = F.when(flag == code, F.lit(label)) if expr is None else expr.when(flag == code, F.lit(label))
    cluster = expr.otherwise(F.raise_error(F.concat(F.lit("unknown l_returnflag "), flag))).cast("int")
    return read_table(spark, sf_dir, "lineitem").select(
        F.array("l_quantity", "l_discount", "l_tax").alias("point"),
        cluster.alias("cluster"),
    )


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as the session has cores.

    A table of few row groups would keep tokenising in as few tasks; one
    with enough splits already is left alone, so nothing large is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def documents(spark: SparkSession, sf_dir: str, num_partitions: int | None = None) -> DataFrame:
    """Documents (doc_id, text); optional round-robin repartition (X1)."""
    df = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return df.repartition(num_partitions) if num_partitions else df


def conversation_texts(spark: SparkSession, sf_dir: str, num_partitions: int | None = None) -> DataFrame:
    """Second corpus: one text per conversation turn (conv_id, turn, text)."""
    df = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return df.repartition(num_partitions) if num_partitions else df
