"""Measure task skew when one key holds a third of all rows.

Usage: python scripts/skew_check.py [rows]

Runs the user-mean centring plus the product maximum twice on a synthetic
fixture (one "hot" user owns a third of the rows): with the default
``join`` strategy (hot users split off and broadcast, the rest shuffle
joined) and with ``lazy_join`` (a plain shuffle join).  Broadcast joins
of the means are disabled and the broadcast bound is set low, as they
would be with a billion users.  Then a word count where one word is a
third of all tokens, and a stratified sample where one cluster holds a
third of the points.  Spark's event log (written to a fresh scratch
folder) gives the records each task read; the script prints, per job, the
largest share of a full-data stage that a single task handled, and how
many rows crossed a shuffle.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from sheaf.operators import ratings as R  # noqa: E402
from sheaf.operators import sampling as SM  # noqa: E402
from sheaf.operators import silhouette as S  # noqa: E402
from sheaf.operators import wordcount as W  # noqa: E402
from sheaf.session import build_session  # noqa: E402


def _task_records(log_dir: str) -> tuple[dict, dict]:
    """job group -> stage -> records read per task (input + shuffle); job group -> shuffle records read."""
    stage_group: dict[int, int] = {}
    out: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
    shuffled: dict[int, int] = defaultdict(int)
    paths = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p)]
    for path in sorted(paths):  # Spark 4 writes rolling files inside one folder per application
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = int(ev.get("Properties", {}).get("spark.jobGroup.id", "-1") or -1)
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    read = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    n = (m.get("Input Metrics") or {}).get("Records Read", 0) + read
                    sid = ev["Stage ID"]
                    out[stage_group.get(sid, -1)][sid].append(n)
                    shuffled[stage_group.get(sid, -1)] += read
    return out, shuffled


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000
    log_dir = tempfile.mkdtemp(prefix="sheaf-skew-")
    spark = build_session(
        "local[8]",
        app_name="sheaf-skew",
        shuffle_partitions=32,
        conf={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{log_dir}",
            "spark.eventLog.compress": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    )
    df = spark.range(rows, numPartitions=16).select(
        (F.col("id") % 1000).alias("product_id"),
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 100_000).alias("user_id"),
        (F.col("id") % 7).cast("float").alias("rating"),
    )
    # A third of all tokens are one word; a third of all points are one cluster.
    tokens = spark.range(rows, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, F.lit("the")).otherwise((F.col("id") % 50_000).cast("string")).alias("word")
    )
    points = spark.range(rows, numPartitions=16).select(
        "id",
        F.array((F.col("id") % 97).cast("double"), (F.col("id") % 89).cast("double")).alias("point"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(1 + F.col("id") % 50).cast("int").alias("cluster"),
    )

    def ratings_job(strategy: str):
        centred = R.center_ratings_by_user(df, strategy=strategy, broadcast_max_rows=1000)
        return R.max_norm_rating(centred)

    runs = {
        "ratings, join (hot users split off)": lambda: ratings_job("join"),
        "ratings, lazy_join (plain shuffle join)": lambda: ratings_job("lazy_join"),
        "word count, hot word": lambda: W.word_count(tokens),
        "stratified sample t=20, hot cluster": lambda: SM.stratified_sample(points, 20, 7),
        "exact silhouette, hot cluster": lambda: S.exact_silhouette(points),
    }
    for group, (name, build) in enumerate(runs.items(), start=1):
        spark.sparkContext.setJobGroup(str(group), name)
        build().write.format("noop").mode("overwrite").save()
    spark.stop()

    records, shuffled = _task_records(log_dir)
    for group, name in enumerate(runs, start=1):
        worst = 0.0
        for tasks in records.get(group, {}).values():
            total = sum(tasks)
            if total >= rows // 2 and len(tasks) > 1:  # stages that move the input rows themselves
                worst = max(worst, max(tasks) / total)
        print(f"{name}: largest single-task share of a full-data stage {worst:.1%},"
              f" rows shuffled {shuffled.get(group, 0):,} of {rows:,}")


if __name__ == "__main__":
    main()
