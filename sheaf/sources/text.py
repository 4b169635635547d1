"""Line-oriented text sources.

A reference "document" or "record" is one line of a text file.  Lines are
read with ``spark.read.text`` (splittable, LF / CR / CRLF, compressed
files, directories and globs), or cut out of a text column of a table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheaf.functions.strings import text_to_lines
from sheaf.operators.joins import broadcast_if_small, materialize
from sheaf.session import ensure_checkpoint_dir


def split_paths(paths: str) -> list[str]:
    """Cut at commas that stand outside braces (``in/{a,b}.txt`` is one glob)."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(paths):
        depth += (c == "{") - (c == "}")
        if c == "," and depth <= 0:
            out.append(paths[start:i])
            start = i + 1
    return [p for p in (*out, paths[start:]) if p]


def read_text_lines(
    spark: SparkSession,
    paths: str | Iterable[str],
    num_partitions: int | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """One row per line, column ``value`` (and ``id`` with ``with_ids``).

    ``num_partitions`` is the optional round-robin repartition of the
    input (only worth it when the input has fewer splits than cores).
    ``with_ids`` adds ``id``, the 0-based position of the line in the input
    (files in path order), see ``number_lines``.
    """
    if isinstance(paths, str):
        paths = split_paths(paths)
    df = spark.read.text(list(paths))
    if with_ids:
        df = number_lines(df)
    return df.repartition(num_partitions) if num_partitions else df


def number_lines(scan: DataFrame) -> DataFrame:
    """(id, value): ``id`` is the line's position in the input, files in path order.

    The files are read once: every line is written with its file, the start
    of its split and its row number, and all further steps read that table,
    so a change of cores or split settings, a retry or a lost executor
    between them cannot lose or move a line.  A split is read by one task,
    line after line, so a line's place in it is the distance from the
    split's first row number; the lines before a split are a running sum
    within its file, those before a file a sum over the files, which the
    driver lists anyway (one name and one count each).
    """
    spark = scan.sparkSession
    rows = materialize(scan.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
        "value",
    ))
    splits = rows.groupBy("_file", "_block").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    splits = materialize(splits)
    total, before = 0, []
    for name, n in sorted(tuple(r) for r in splits.groupBy("_file").agg(F.sum("_n")).collect()):
        before.append((name, total))
        total += n
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    files = spark.createDataFrame(before, "_file string, _files_before bigint")
    splits = splits.join(files, "_file").select(
        "_file", "_block", (F.col("_files_before") + F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    side, _ = broadcast_if_small(splits)
    found = rows.join(side, ["_file", "_block"], "left")
    shift = F.coalesce("_shift", F.raise_error(F.lit("a line without its split")).cast("bigint"))
    return found.select((F.col("_row") + shift).alias("id"), "value")


def lines_from_column(
    df: DataFrame,
    text: str = "text",
    keep: Iterable[str] = ("doc_id",),
    line: str = "line",
    line_no: str = "line_no",
) -> DataFrame:
    """Explode a text column into its lines, keeping the 0-based line number."""
    return df.select(*keep, F.posexplode(text_to_lines(text)).alias(line_no, line))


def write_text_lines(df: DataFrame, column: str = "line", path: str | None = None) -> str:
    """Write one string column as text files (one row per line); returns the path.

    Without ``path`` the files go to a fresh folder under the session's
    checkpoint directory (a shared folder on a cluster).
    """
    spark = df.sparkSession
    if path is None:
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sheaf-text/{uuid.uuid4().hex}"
    df.select(F.col(column).cast("string").alias("value")).write.text(path)
    return path
