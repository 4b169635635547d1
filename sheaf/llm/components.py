"""Connected components over an edge table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import write_scratch


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp): the smallest node reachable over the edges (nulls never link).

    Each round takes the smallest label among neighbours, then jumps to the
    label of the label, so a path of n nodes needs about log n rounds.  Labels
    only fall, and the smallest reaches one more neighbour in every round, so
    the rounds end by themselves.  Every round is a table in the shared folder.
    """
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("next")).where("node is not null and next is not null and node <> next")
    both = write_scratch(both.unionByName(both.select(F.col("next").alias("node"), F.col("node").alias("next"))).distinct(), "edges")
    labels = both.groupBy("node").agg(F.least(F.min("next"), F.first("node")).alias("comp"))
    labels = write_scratch(labels, "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "next"), "next").groupBy("node").agg(F.min("comp").alias("near"))
        step = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("down"))
        jump = labels.select(F.col("node").alias("down"), F.col("comp").alias("far"))
        new = write_scratch(
            step.join(jump, "down").select("node", F.least("down", "far").alias("comp"), (F.least("down", "far") < F.col("comp")).alias("moved")),
            "labels",
        )
        labels = new.select("node", "comp")
        if new.where("moved").isEmpty():
            return labels
