from __future__ import annotations

import hashlib
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sheaf.functions import java_split, seeded_uniform, silhouette_value, sqdist, text_to_lines, utf16_length


def java_split_reference(s: str, sep: str) -> list[str]:
    """Java String.split(literal) semantics, written out for the test."""
    if s == "":
        return [""]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def _split(spark, values, sep):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", java_split("v", sep).alias("t")).orderBy("i").collect()
    return [r["t"] for r in rows]


def test_java_split_space_edge_cases(spark):
    values = ["a  b", " a", "a  ", "", "   ", "hello world"]
    assert _split(spark, values, " ") == [["a", "", "b"], ["", "a"], ["a"], [""], [], ["hello", "world"]]


def test_java_split_comma(spark):
    assert _split(spark, ["1,2,3,,", ",x", ",,"], ",") == [["1", "2", "3"], ["", "x"], []]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab ,", max_size=8), min_size=1, max_size=40))
def test_java_split_matches_java_rule(spark, values):
    for sep in (" ", ","):
        assert _split(spark, values, sep) == [java_split_reference(v, sep) for v in values]


def test_text_to_lines(spark):
    df = spark.createDataFrame(
        [(0, "a\rb\r\nc\n\nd\n"), (1, ""), (2, "\n"), (3, "abc"), (4, "x\r\n\r\n")], "i int, t string"
    )
    got = [r["l"] for r in df.select("i", text_to_lines("t").alias("l")).orderBy("i").collect()]
    assert got == [["a", "b", "c", "", "d"], [], [""], ["abc"], ["x", ""]]


def test_utf16_length_counts_surrogates(spark):
    df = spark.createDataFrame([("\U0001F600a",), ("abc",), ("",)], "w string")
    assert [r[0] for r in df.select(utf16_length("w")).collect()] == [3, 3, 0]


def test_seeded_uniform_is_md5_prefix(spark):
    df = spark.createDataFrame([(i,) for i in range(50)], "id long")
    rows = df.select("id", seeded_uniform("id", 7, "md5").alias("u")).orderBy("id").collect()
    for r in rows:
        expected = int(hashlib.md5(f"7:{r['id']}".encode()).hexdigest()[:13], 16) / 2**52
        assert r["u"] == expected
        assert 0.0 <= r["u"] < 1.0


def test_seeded_uniform_xxhash64_is_stable_and_uniform(spark):
    df = spark.range(0, 20000)
    u = df.select(seeded_uniform("id", 7).alias("u"))
    first = [r.u for r in u.orderBy("id").limit(20).collect()]
    again = [r.u for r in df.repartition(5).select("id", seeded_uniform("id", 7).alias("u")).orderBy("id").limit(20).collect()]
    assert first == again
    stats = u.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0.0 <= stats[0] and stats[1] < 1.0 and abs(stats[2] - 0.5) < 0.02
    other = df.select(seeded_uniform("id", 8).alias("u")).orderBy("id").limit(20).collect()
    assert [r.u for r in other] != first
    with pytest.raises(ValueError):
        seeded_uniform("id", 7, "sha1")


def test_sqdist_and_length_check(spark):
    df = spark.createDataFrame([([1.0, 2.0], [4.0, 6.0])], "p array<double>, q array<double>")
    assert df.select(sqdist("p", "q")).first()[0] == 25.0
    bad = spark.createDataFrame([([1.0, 2.0], [4.0])], "p array<double>, q array<double>")
    with pytest.raises(PySparkException):
        bad.select(sqdist("p", "q")).collect()


def test_silhouette_value(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 2.0), (2.0, 1.0), (3.0, 3.0)], "a double, b double")
    got = [r[0] for r in df.select(silhouette_value("a", "b")).collect()]
    assert math.isnan(got[0])
    assert got[1:] == [0.5, -0.5, 0.0]


def test_no_python_udf_in_string_functions(spark):
    df = spark.createDataFrame([("a b",)], "v string")
    plan = df.select(java_split("v"), text_to_lines("v"), utf16_length("v"))._jdf.queryExecution().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
