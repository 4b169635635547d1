from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from sheaf.operators import ratings as R
from sheaf.sources import tables

from .conftest import SF001, needs

SCHEMA = "product_id string, user_id string, rating float"


def _ratings(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_centering_single_rating_and_duplicates(spark):
    df = _ratings(spark, [("p1", "u1", 4.0), ("p1", "u2", 2.0), ("p1", "u2", 2.0), ("p2", "u2", 5.0)])
    for strategy in R.STRATEGIES:
        out = R.center_ratings_by_user(df, strategy=strategy).orderBy("user_id", "product_id").collect()
        assert len(out) == 4  # every row kept, duplicates too
        assert [r.norm_rating for r in out] == pytest.approx([0.0, -1.0, -1.0, 2.0])


def test_float32_arithmetic(spark):
    df = _ratings(spark, [("p", "u", 0.1), ("q", "u", 0.2), ("r", "u", 0.4)])
    out = {r.product_id: r.norm_rating for r in R.center_ratings_by_user(df).collect()}
    import numpy as np

    mean = np.float32(np.mean(np.array([0.1, 0.2, 0.4], dtype=np.float32).astype(np.float64)))
    assert out["p"] == float(np.float32(0.1) - mean)


def test_top_products_edge_cases(spark):
    df = _ratings(
        spark,
        [("b", "u1", 1.0), ("a", "u2", 1.0), ("c", "u3", float("nan")), ("d", "u4", 3.0), ("d", "u5", 9.0)],
    )
    maxima = R.max_norm_rating(R.center_ratings_by_user(df))
    assert R.top_products(maxima, 0).collect() == []
    allrows = R.top_products(maxima, 100).collect()
    assert [r.product_id for r in allrows] == ["a", "b", "d", "c"]  # ties by id, NaN last
    assert [r["rank"] for r in allrows] == [1, 2, 3, 4]
    assert math.isnan(allrows[-1].max_norm_rating)


def test_rank_products_with_nan_and_ties(spark):
    maxima = spark.createDataFrame(
        [("d", 1.0), ("a", 2.0), ("c", float("nan")), ("b", 2.0), ("e", None)], "product_id string, max_norm_rating float"
    )
    ranked = {r["rank"]: r.product_id for r in R.rank_products(maxima.repartition(3)).collect()}
    assert ranked == {1: "a", 2: "b", 3: "d", 4: "c", 5: "e"}
    assert R.rank_products(maxima.limit(0)).collect() == []


@pytest.mark.parametrize("fraction", [0, -0.1, 1.5])
def test_hot_fraction_is_validated(spark, fraction):
    with pytest.raises(ValueError):
        R.attach_user_mean(_ratings(spark, [("p", "u", 1.0)]), hot_fraction=fraction)


def test_user_keys_of_other_types_are_split_too(spark):
    rows = [("p", i % 3 == 0 and None or f"2024-01-{1 + i % 5:02d}", float(i % 4)) for i in range(60)]
    df = _ratings(spark, rows).withColumn("user_id", F.to_date("user_id"))
    want = R.attach_user_mean(df, strategy="lazy_join").collect()
    assert sorted(R.attach_user_mean(df, broadcast_max_rows=1).collect(), key=str) == sorted(want, key=str)
    assert len(want) == 60


def test_strategies_agree_and_partitioning_does_not_matter(spark):
    rows = [(f"p{i % 7}", f"u{i % 5}", float(i % 11)) for i in range(200)]
    df = _ratings(spark, rows)
    a = R.top_normalized_ratings(df, 5, strategy="join").collect()
    b = R.top_normalized_ratings(df, 5, materialize_input=True).collect()
    c = R.top_normalized_ratings(df.repartition(13), 5).collect()
    d = R.top_normalized_ratings(df, 5, strategy="lazy_join").collect()
    e = R.top_normalized_ratings(df, 5, broadcast_max_rows=2).collect()  # over the bound: shuffle join
    assert a == b == c == d == e


def test_partial_max_rounds_to_final_max(spark):
    rows = [(f"p{i % 7}", f"u{i % 5}", float(i % 11)) for i in range(200)]
    centred = R.center_ratings_by_user(_ratings(spark, rows).repartition(4))
    partial = R.partial_max_by_partition(centred)
    final = {r.product_id: r.max_norm_rating for r in R.max_norm_rating(centred).collect()}
    again = {r.product_id: r.m for r in partial.groupBy("product_id").agg({"partial_max_norm_rating": "max"})
             .withColumnRenamed("max(partial_max_norm_rating)", "m").collect()}
    assert final == again


@needs(SF001)
def test_golden_top2_sf001(spark):
    top = R.top_normalized_ratings(tables.ratings(spark, SF001), 2).collect()
    assert [(r.product_id, round(r.max_norm_rating, 4)) for r in top] == [(1685, 31.8), (719, 31.375)]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_broadcast_only_within_the_bound(spark):
    df = _ratings(spark, [("p", "u1", 1.0), ("q", "u2", 2.0), ("r", "u3", 3.0)])
    small = _plan(R.center_ratings_by_user(df, broadcast_max_rows=3))
    large = _plan(R.center_ratings_by_user(df, broadcast_max_rows=2))
    lazy = _plan(R.center_ratings_by_user(df, strategy="lazy_join"))
    assert "Window" not in small + large + lazy
    assert "broadcast" in small.lower() and "Union" not in small
    assert "Union" in large  # hot users broadcast, the rest through a shuffle join
    assert "broadcast" not in lazy.lower() and "Union" not in lazy


def test_hot_user_split(spark):
    n = 3000
    df = spark.range(n).select(
        (F.col("id") % 97).cast("string").alias("product_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("user_id"),
        (F.col("id") % 7).cast("float").alias("rating"),
    )
    split = R.center_ratings_by_user(df, broadcast_max_rows=10, hot_fraction=0.05)
    lazy = R.center_ratings_by_user(df, strategy="lazy_join")
    key = ["product_id", "user_id", "rating", "norm_rating"]
    assert sorted(split.select(key).collect()) == sorted(lazy.select(key).collect())
    pdf = df.toPandas()
    means = pdf.groupby("user_id")["rating"].transform(lambda r: r.astype("float64").mean()).astype("float32")
    want = sorted(zip(pdf.product_id, pdf.user_id, pdf.rating, (pdf.rating - means).astype("float32")))
    got = sorted((r.product_id, r.user_id, r.rating, r.norm_rating) for r in split.select(key).collect())
    assert [(a, b, float(c), float(d)) for a, b, c, d in want] == got
    confs = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    saved = {c: spark.conf.get(c, None) for c in confs}
    try:
        for c in confs:  # keep the cold side a shuffle join, as it is at scale
            spark.conf.set(c, "-1")
        agg = R.center_ratings_by_user(df, broadcast_max_rows=10, hot_fraction=0.05).groupBy("user_id").count()
        assert {r.user_id: r["count"] for r in agg.collect()}["hot"] == n // 3
        plan = agg._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, v in saved.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan


def test_report_lines_use_java_float_text(spark):
    top = spark.createDataFrame(
        [(1, "p9", 31.666666), (2, "p1", 2.0), (3, "p3", 1.0e-4)], "rank int, product_id string, max_norm_rating float"
    )
    lines = [r.line for r in R.report_lines(top).orderBy("rank").collect()]
    assert lines == [
        "Product p9 maxNormRating 31.666666",
        "Product p1 maxNormRating 2.0",
        "Product p3 maxNormRating 1.0E-4",
    ]
