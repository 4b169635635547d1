"""Session helpers.

Library operators never create or configure a session; they take the
caller's.  ``build_session`` is for tests, the bench and scripts only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators are designed around.  AQE re-plans joins from
# measured (not estimated) sizes and splits skewed join partitions; the
# session time zone is pinned so results compare with DuckDB.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "sheaf",
    shuffle_partitions: int | None = 8,
    driver_memory: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    settings = dict(RECOMMENDED_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        settings["spark.driver.memory"] = driver_memory
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is
    used as is; when it is unset there, this is an error, since a folder
    local to the driver machine would not survive a lost executor.  Only a
    ``local`` master (tests, scripts) gets a scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not str(sc.master).startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is unset: set it to a folder shared by the driver and all executors"
            )
        configured = tempfile.mkdtemp(prefix="sheaf-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()
