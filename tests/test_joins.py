from __future__ import annotations

from sheaf.operators.joins import broadcast_if_small, materialize


def test_materialize_writes_under_checkpoint_dir(spark):
    df = spark.range(100).selectExpr("id", "id * 2 AS twice")
    out = materialize(df)
    assert sorted(r.twice for r in out.collect()) == [2 * i for i in range(100)]
    files = out.inputFiles()
    ckpt = spark.sparkContext.getCheckpointDir().split(":", 1)[-1].lstrip("/")
    assert files and all(f.split(":", 1)[-1].lstrip("/").startswith(ckpt) for f in files)


def test_broadcast_if_small_bound(spark):
    df = spark.range(10).selectExpr("id AS k", "id AS v")
    side, small = broadcast_if_small(df, max_rows=10)
    assert small and side.count() == 10
    side, small = broadcast_if_small(df, max_rows=9)
    assert not small and side.count() == 10


class _FakeContext:
    def __init__(self, master):
        self.master = master
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path


class _FakeSession:
    def __init__(self, master, configured=None):
        self.sparkContext = _FakeContext(master)
        self.conf = {"spark.checkpoint.dir": configured} if configured else {}


def test_checkpoint_dir_from_session_and_no_local_fallback_on_a_cluster():
    import pytest

    from sheaf.session import ensure_checkpoint_dir

    assert ensure_checkpoint_dir(_FakeSession("yarn", "hdfs:///shared/ckpt")) == "hdfs:///shared/ckpt"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_FakeSession("spark://master:7077"))
    assert ensure_checkpoint_dir(_FakeSession("local[2]")).startswith(("/tmp", "/"))


def test_drop_materialized_removes_the_application_tables(spark):
    import os

    from sheaf.operators.joins import drop_materialized

    from sheaf.sources.text import write_text_lines

    out = materialize(spark.range(10))
    folder = os.path.dirname(out.inputFiles()[0].split(":", 1)[-1])
    text = write_text_lines(spark.range(3).selectExpr("CAST(id AS STRING) AS line")).split(":", 1)[-1]
    assert os.path.isdir(folder) and os.path.isdir(text)
    assert drop_materialized(spark)
    assert not os.path.exists(folder) and not os.path.exists(text)
    assert not drop_materialized(spark)  # nothing left
