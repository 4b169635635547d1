"""op11: hard negatives against brute force and SQL."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sheaf.llm import anchortree, oracle, queries
from sheaf.llm.common import reach_workers
from tests.conftest import SF001, needs

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
SCHEMA = "vec_id long, embedding array<float>, label int, score long, block string"


def brute(rows, every=50):
    kept = [
        (i, lab, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, lab, *_ in rows
        if v is not None and lab is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    anchors = {(i, lab, tuple(q)) for i, lab, q in kept if i is not None and i % every == 0}
    for i, lab, q in anchors:
        scored = [(sum(a * b for a, b in zip(q, r)), j, m == lab) for j, m, r in kept if j != i and len(r) == len(q)]
        scored.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        for ps, p, _ in [x for x in scored if x[2]][:5]:
            near = [x for x in scored if not x[2] and 50 * ps <= 100 * x[0] <= 95 * ps][:3]
            out += [(i, p, k + 1, n, ps, ns) for k, (ns, n, _) in enumerate(near)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def clusters(seed: int, n: int, d: int = 8, spread: float = 0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d)) / 2
    pick = rng.integers(0, 12, n)
    x = centres[pick] + rng.normal(size=(n, d)) * spread
    x[n // 2 : n // 2 + n // 8] = x[0]  # many ties
    return [(k, [float(v) for v in x[k]], int(rng.integers(0, 4)), 7, "clash") for k in range(n)]


def odd_rows():
    nan, inf = float("nan"), float("inf")
    return [
        (None, [0.5] * 8, 1, 0, None), (100, None, 1, 0, None), (150, [0.5] * 8, None, 0, None), (200, [nan] * 8, 1, 0, None), (250, [0.1] * 7 + [None], 1, 0, None),
        (300, [inf] + [0.1] * 7, 2, 0, None), (350, [], 1, 0, None), (351, [], 1, 0, None), (352, [], 2, 0, None), (400, [0.5, 0.25], 1, 0, None),
        (401, [0.5, 0.5], 1, 0, None), (402, [0.25, 0.25], 2, 0, None), (10_000, [3e6] * 8, 1, 0, None), (10_001, [2e6] * 8, 1, 0, None), (10_002, [1.5e6] * 8, 3, 0, None),
    ]


@pytest.mark.parametrize("block,group_bytes", [(1024, 64 << 20), (5, 600)])
def test_equals_brute_force(spark, block, group_bytes):
    reach_workers(spark)
    rows = clusters(1, 600) + odd_rows() + clusters(1, 600)[:60]  # repeated rows
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for every in (50, 20):
        out = anchortree.hard_negatives(df, F.col("vec_id") % every == 0, F.col("label"), block=block, group_bytes=group_bytes)
        assert found(out) == brute(rows, every)


def test_empty_and_no_anchor(spark):
    reach_workers(spark)
    for rows in ([], [(3, [0.5], 1, 0, None)], [(50, [0.5], 1, 0, None)]):
        df = spark.createDataFrame(rows, SCHEMA)
        assert found(anchortree.hard_negatives(df, F.col("vec_id") % 50 == 0, F.col("label"))) == []


def test_bounds_rule_out_most_of_clustered_rows():
    rows = clusters(2, 4000, d=32, spread=0.002)
    x = np.floor(256 * np.array([r[1] for r in rows]))
    labels, ids = np.array([r[2] for r in rows]), np.arange(len(x))
    own = np.arange(0, 4000, 20)
    parent, edge = anchortree.spanning_tree(x[own])
    tree = anchortree.Block(0, ids[own], labels[own], x[own], parent, edge, np.full(len(own), -(2**62)))
    places = anchortree.Places(tree.floor, 5)

    def wanted(nodes, low, high):
        return (tree.labels[nodes][:, None] == labels) & (high >= places.floor[nodes][:, None])

    norm = np.sqrt((x * x).sum(1))
    places.add([(a, s, ids[r]) for a, r, s in tree.walk(x, norm, wanted)])
    first, tree.scored = tree.scored, 0
    seen = list(tree.walk(x, norm, wanted))  # with the last places known, few pairs are scored
    assert tree.scored < 0.5 * first
    exact = x[own] @ x.T
    for a, r, s in seen:
        assert (exact[a, r] == s).all()
    mask = (labels[own][:, None] == labels) & (exact >= places.floor[:, None])
    assert mask.sum() <= sum(len(a) for a, _, _ in seen)


@needs(SF001)
def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF001}/embeddings.parquet'")
    want = sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({oracle.OP11})").fetchall(), key=str)
    assert want and found(queries.op11_anchor_tree(spark, SF001)) == want
