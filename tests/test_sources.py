from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.errors import PySparkException

from sheaf.sources import parse_labeled_points, parse_points, parse_ratings, read_text_lines
from sheaf.sources.text import lines_from_column


def _lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_parse_ratings_ignores_extra_fields(spark):
    rows = parse_ratings(_lines(spark, ["p1,u1,3.5,extra", "p2,u1,4"])).collect()
    assert [(r.product_id, r.user_id, r.rating) for r in rows] == [("p1", "u1", 3.5), ("p2", "u1", 4.0)]
    assert parse_ratings(_lines(spark, ["a,b,1"])).schema.simpleString() == (
        "struct<product_id:string,user_id:string,rating:float>"
    )


@pytest.mark.parametrize("bad", ["p1,u1,x", "p1,u1"])
def test_parse_ratings_fails_fast(spark, bad):
    with pytest.raises(PySparkException):
        parse_ratings(_lines(spark, [bad])).collect()


def test_parse_labeled_points(spark):
    rows = parse_labeled_points(_lines(spark, ["40.7267,-74.0345,1", "1,2,3,,"])).collect()
    assert [(r.point, r.cluster) for r in rows] == [([40.7267, -74.0345], 1), ([1.0, 2.0], 3)]


@pytest.mark.parametrize("bad", ["1.0  2.0", "1.0 x", "1.0 NaN"])
def test_parse_points_rejects_empty_or_bad_tokens(spark, bad):
    with pytest.raises(PySparkException):
        parse_points(_lines(spark, [bad])).collect()


def test_parse_labeled_points_rejects_nan(spark):
    with pytest.raises(PySparkException, match="NaN coordinate"):
        parse_labeled_points(_lines(spark, ["1.0,NaN,2"])).collect()


def test_parse_points(spark):
    assert parse_points(_lines(spark, ["1.5 -2 3e2"])).first().point == [1.5, -2.0, 300.0]


def test_read_text_lines_line_breaks(spark):
    folder = tempfile.mkdtemp(prefix="sheaf-text-")
    path = os.path.join(folder, "mixed.txt")
    with open(path, "wb") as fh:
        fh.write(b"a\rb\r\nc\n\nd\n")
    got = [r.value for r in read_text_lines(spark, path).collect()]
    assert got == ["a", "b", "c", "", "d"]


def test_read_text_lines_glob_and_gzip(spark):
    import gzip

    folder = tempfile.mkdtemp(prefix="sheaf-text-")
    with gzip.open(os.path.join(folder, "z.txt.gz"), "wb") as fh:
        fh.write(b"x\ny")
    with open(os.path.join(folder, "p.txt"), "wb") as fh:
        fh.write(b"hello world\n")
    got = sorted(r.value for r in read_text_lines(spark, os.path.join(folder, "*"), num_partitions=3).collect())
    assert got == ["hello world", "x", "y"]


def test_lines_from_column_keeps_line_numbers(spark):
    df = spark.createDataFrame([(7, "x\ny\n"), (8, "")], "doc_id long, text string")
    rows = lines_from_column(df).orderBy("doc_id", "line_no").collect()
    assert [(r.doc_id, r.line_no, r.line) for r in rows] == [(7, 0, "x"), (7, 1, "y")]


def test_numbered_lines_do_not_depend_on_the_splits(spark, tmp_path):
    """The registered round trip, with files cut into splits inside their lines."""
    import __spark_entry__ as E

    from .conftest import SF0001

    def numbered():
        return sorted(tuple(r) for r in E.queries()["numbered_text_lines"](spark, SF0001).collect())

    whole = numbered()
    assert [i for i, _ in whole] == list(range(len(whole)))
    longest = max(len(line) for _, line in whole)
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(8192))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        assert numbered() == whole
        path = str(tmp_path / "long.txt")
        with open(path, "w") as f:
            f.writelines(f"{n} " + "x" * (40_000 if n % 3 == 0 else 5) + "\n" for n in range(40))  # lines longer than a split
        lines = read_text_lines(spark, path, with_ids=True).collect()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert longest > 100
    assert sorted((r.id, int(r.value.split()[0])) for r in lines) == [(n, n) for n in range(40)]
