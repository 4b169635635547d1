"""Shared helpers of the operators in this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.session import ensure_checkpoint_dir

#: ASCII white space as the contracts name it, \x20 and \x09-\x0D.
ASCII_SPACES = "\t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers that share the driver's file system import this package.

    Elsewhere the package is shipped as usual (``--py-files``)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_workers(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/sheaf-tables/{name}-{uuid.uuid4().hex}"


@contextmanager
def no_shuffles_left(spark: SparkSession) -> Iterator[None]:
    """Let Spark delete the shuffle files of each query inside as soon as it ends.

    Its cleaner goes by garbage collection on the driver, which on a quiet
    driver comes long after the files could have gone."""
    before = spark.conf.getAll.get(FILE_CLEANUP)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(FILE_CLEANUP) if before is None else spark.conf.set(FILE_CLEANUP, before)


def write_scratch(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the
    lineage, and a lost executor costs the running tasks only."""
    path = scratch_path(df.sparkSession, name)
    with no_shuffles_left(df.sparkSession):
        df.write.options(**({"compression": "zstd"} | options)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(*tables: DataFrame) -> None:
    """Delete the files of tables of ``write_scratch`` that nothing reads any more."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else.  ``lower`` has a fast path for ASCII;
    other texts go through ``translate``."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def space_words(text: Column) -> Column:
    """Array of the maximal runs of ``[^\\x20\\x09-\\x0D]``; null text gives none."""
    flat = F.translate(F.coalesce(text, F.lit("")), ASCII_SPACES, " " * len(ASCII_SPACES))
    return F.array_remove(F.split(flat, " "), "")


