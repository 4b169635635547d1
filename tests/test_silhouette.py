from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheaf.operators import sampling as SM
from sheaf.operators import silhouette as S
from sheaf.sources import tables

from .conftest import SF001, needs

SCHEMA = "id long, point array<double>, cluster int"


def brute_force(points, clusters, sample_idx, norm):
    """Reference definition, pair by pair: mean silhouette of ``points``
    against the sample rows ``sample_idx`` with normaliser ``norm[c]``."""
    sample_p = points[sample_idx]
    sample_c = clusters[sample_idx]
    s_vals = []
    for p, c in zip(points, clusters):
        d = ((sample_p - p) ** 2).sum(axis=1)
        a = d[sample_c == c].sum() / norm[c]
        others = [d[sample_c == q].sum() / norm[q] for q in np.unique(sample_c) if q != c]
        b = min(others) if others else 0.0
        m = max(a, b)
        s_vals.append(float("nan") if m == 0 else (b - a) / m)
    return float(np.mean(s_vals)), s_vals


def _blobs(seed=3, n=240, d=3, labels=(0, 2, 5), offset=0.0):
    rng = np.random.default_rng(seed)
    clusters = rng.choice(labels, size=n, p=[0.6, 0.3, 0.1])
    centres = {c: rng.normal(0, 4, size=d) for c in labels}
    pts = np.array([centres[c] + rng.normal(0, 1, size=d) for c in clusters]) + offset
    return pts, clusters


def _df(spark, pts, clusters):
    rows = [(i, [float(x) for x in p], int(c)) for i, (p, c) in enumerate(zip(pts, clusters))]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("method", ["codegen", "arrow", "lambda"])
def test_exact_matches_pairwise(spark, method):
    pts, cl = _blobs()
    df = _df(spark, pts, cl)
    sizes = {c: int((cl == c).sum()) for c in np.unique(cl)}
    want, per_point = brute_force(pts, cl, np.arange(len(pts)), sizes)
    got = S.exact_silhouette_scores(df, method=method).orderBy("id").collect()
    assert [r.s for r in got] == pytest.approx(per_point, rel=1e-9, abs=1e-12)
    assert S.exact_silhouette(df, method=method).first().silhouette == pytest.approx(want, rel=1e-9)


@pytest.mark.parametrize("normalizer", ["expected", "actual"])
def test_approx_matches_pairwise_on_same_sample(spark, normalizer):
    pts, cl = _blobs(seed=5, n=300, d=4)
    df = _df(spark, pts, cl)
    t = 25
    sample = SM.stratified_sample(df, t, seed=9).select("id").collect()
    idx = np.array(sorted(r.id for r in sample))
    sizes = {c: int((cl == c).sum()) for c in np.unique(cl)}
    sample_sizes = {c: int((cl[idx] == c).sum()) for c in np.unique(cl)}
    norm = {c: min(t, sizes[c]) for c in sizes} if normalizer == "expected" else sample_sizes
    want, _ = brute_force(pts, cl, idx, norm)
    for method in ("codegen", "arrow", "lambda"):
        got = S.approx_silhouette(df, t, 9, normalizer=normalizer, method=method).first().silhouette
        assert got == pytest.approx(want, rel=1e-9), method


def test_sample_silhouette_matches_pairwise(spark):
    pts, cl = _blobs(seed=8, n=200, d=2)
    df = _df(spark, pts, cl)
    sample = sorted(r.id for r in SM.stratified_sample(df, 15, seed=1).select("id").collect())
    idx = np.array(sample)
    norm = {c: int((cl[idx] == c).sum()) for c in np.unique(cl[idx])}
    want, _ = brute_force(pts[idx], cl[idx], np.arange(len(idx)), norm)
    got = S.exact_silhouette_sample(df, 15, 1).first()
    assert got.n_points == len(idx)
    assert got.silhouette == pytest.approx(want, rel=1e-9)


def test_translation_and_relabelling_invariance(spark):
    pts, cl = _blobs(seed=2)
    base = S.exact_silhouette(_df(spark, pts, cl)).first().silhouette
    moved = S.exact_silhouette(_df(spark, pts + 1e6, cl)).first().silhouette
    relabelled = S.exact_silhouette(_df(spark, pts, np.array([{0: 0, 2: 1, 5: 2}[c] for c in cl]))).first().silhouette
    assert moved == pytest.approx(base, abs=1e-6)
    assert relabelled == pytest.approx(base, rel=1e-12)


def test_one_cluster_and_identical_points(spark):
    one = spark.createDataFrame([(0, [0.0, 0.0], 1), (1, [1.0, 0.0], 1)], SCHEMA)
    assert S.exact_silhouette(one).first().silhouette == -1.0
    same = spark.createDataFrame([(0, [2.0, 2.0], 1), (1, [2.0, 2.0], 1)], SCHEMA)
    assert math.isnan(S.exact_silhouette(same).first().silhouette)


def test_cluster_with_empty_sample(spark):
    # A cluster with no sampled point: moments are taken without it.
    pts = spark.createDataFrame([(0, [0.0], 0), (1, [1.0], 0), (2, [10.0], 1)], SCHEMA)
    moments = S.cluster_moments(pts.where("cluster = 0"), 1)
    scored = S.silhouette_scores(pts, moments, F.col("n"), 1).orderBy("id").collect()
    # point 2's own cluster is not in the sample: a = 0; b = mean sq dist to cluster 0
    assert (scored[2].a, scored[2].b) == (0.0, pytest.approx((100.0 + 81.0) / 2))


def test_stratified_sample_rules(spark):
    pts, cl = _blobs(seed=4, n=150)
    df = _df(spark, pts, cl)
    sizes = {c: int((cl == c).sum()) for c in np.unique(cl)}
    everything = SM.stratified_sample(df, max(sizes.values()), seed=3).count()
    assert everything == len(pts)
    capped = SM.sample_cluster_sizes(SM.stratified_sample(df, 5, seed=3)).collect()
    assert all(r.sample_size <= 5 for r in capped)
    again = SM.sample_cluster_sizes(SM.stratified_sample(df.repartition(7), 5, seed=3)).collect()
    assert sorted(capped) == sorted(again)  # independent of the partition layout
    with pytest.raises(ValueError):
        SM.stratified_sample(df, 0, seed=3)


def test_null_labels_and_null_coordinates_fail_everywhere(spark):
    rows = [(0, [0.0, 1.0], 0), (1, [1.0, 1.0], None)]
    df = spark.createDataFrame(rows, SCHEMA)
    for run in (lambda: S.exact_silhouette(df).collect(), lambda: SM.stratified_sample(df, 5, 1).collect()):
        with pytest.raises(Exception, match="null label"):
            run()
    holes = spark.createDataFrame([(0, [0.0, None], 0), (1, [1.0, 4.0], 0), (2, [2.0, 6.0], 0)], SCHEMA)
    for dim in (2, None):
        with pytest.raises(Exception):
            S.cluster_moments(holes, dim).collect()


def test_unequal_dimensions_fail(spark):
    df = spark.createDataFrame([(0, [0.0, 1.0], 0), (1, [1.0], 1)], SCHEMA)
    with pytest.raises(Exception):
        S.exact_silhouette(df, dim=2).collect()


@needs(SF001)
def test_golden_embeddings_sf001(spark):
    pts = tables.labeled_points(spark, SF001)
    assert S.exact_silhouette(pts).first().silhouette == pytest.approx(-0.005164044364, abs=1e-11)
    approx = S.approx_silhouette(pts, 20, 7, draw="md5").first().silhouette
    assert round(approx, 6) == -0.217199
    assert SM.stratified_sample(pts, 20, 7, draw="md5").count() == 177


def test_arrow_blocks_and_many_clusters(spark):
    rng = np.random.default_rng(11)
    pts = rng.normal(0, 3, size=(400, 5))
    cl = rng.integers(0, 60, size=400)
    df = _df(spark, pts, cl)
    arrow = S.exact_silhouette(df, method="arrow", block_clusters=25).first().silhouette  # three blocks
    lam = S.exact_silhouette(df, method="lambda").first().silhouette
    sizes = {c: int((cl == c).sum()) for c in np.unique(cl)}
    want, _ = brute_force(pts, cl, np.arange(len(pts)), sizes)
    assert arrow == pytest.approx(want, rel=1e-9)
    assert lam == pytest.approx(want, rel=1e-9)


@pytest.mark.parametrize("method", ["codegen", "arrow", "lambda"])
def test_distance_sums_match_pairwise(spark, method):
    pts, cl = _blobs(seed=12, n=60, d=3)
    df = _df(spark, pts, cl)
    sample_idx = np.arange(0, 60, 3)
    sample = df.where(F.col("id") % 3 == 0)
    moments = S.cluster_moments(sample, 3)
    got = {(r.id, r.sample_cluster): r.dist_sum for r in
           S.distance_sums_by_cluster(df, moments, 3, method=method).collect()}
    assert len(got) == len(pts) * len(np.unique(cl[sample_idx]))
    for (i, c), v in got.items():
        members = pts[sample_idx][cl[sample_idx] == c]
        assert v == pytest.approx(((members - pts[i]) ** 2).sum(), rel=1e-9, abs=1e-9)


def test_cap_per_cluster_above_window_group_limit_threshold(spark):
    from pyspark.sql import functions as F

    # Cluster 0 holds a third of the rows, spread over 8 partitions; t is above Spark's threshold.
    n = 9000
    df = spark.range(n).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0).otherwise(1 + F.col("id") % 5).cast("int").alias("cluster"),
        ((F.col("id") * 7919) % 1009).cast("double").alias("u"),
    ).repartition(8)
    t = 1200
    capped = SM.cap_per_cluster(df, t)
    plan = capped._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapIn" not in plan and "WindowExec" not in plan
    assert SM.cap_per_cluster(df, n).count() == n  # t >= |C|: whole clusters
    got = sorted((r.cluster, r.id) for r in capped.collect())
    pdf = df.toPandas().sort_values(["cluster", "u", "id"])
    want = sorted((int(c), int(i)) for c, i in pdf.groupby("cluster").head(t)[["cluster", "id"]].itertuples(index=False))
    assert got == want
    assert SM.sample_cluster_sizes(capped).where("cluster = 0").first().sample_size == t


def test_models_above_a_block_are_evaluated_block_by_block(spark, monkeypatch):
    from sheaf.operators import clustering as CL

    assert SM.model_block_rows(100_000, 768) == (1 << 24) // 768
    assert SM.model_block_rows(10, 768) == 10
    assert SM.model_block_rows(10, None) == 10
    rows = [(i, [float(i), float(i % 3)], i % 7) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, point array<double>, cluster int")
    scores = lambda **kw: [(r.id, r.a, r.b, r.s) for r in S.exact_silhouette_scores(df, **kw).orderBy("id").collect()]
    near = lambda **kw: [(r.id, r.nearest) for r in CL.assign_nearest(df, CL.centroids(df, 2), **kw).orderBy("id").collect()]
    sums = lambda **kw: sorted(
        (r.id, r.sample_cluster, r.dist_sum) for r in S.distance_sums_by_cluster(df, S.cluster_moments(df, 2), 2, **kw).collect()
    )
    whole, nearest, dist = scores(), near(), sums()
    small = lambda rows, dim: SM.model_block_rows(rows, dim, max_values=4)  # two clusters of dimension 2 per block
    monkeypatch.setattr(S, "model_block_rows", small)
    monkeypatch.setattr(CL, "model_block_rows", small)
    for method in ("codegen", "arrow", "lambda"):
        np.testing.assert_allclose(scores(method=method), whole, rtol=1e-12)
        assert near(method=method) == nearest
        np.testing.assert_allclose(sums(method=method), dist, rtol=1e-12)


def test_more_than_a_hundred_thousand_clusters(spark):
    n = 100_001
    df = spark.range(2 * n).select(
        "id", F.array((F.col("id") % n).cast("double")).alias("point"), (F.col("id") % n).cast("int").alias("cluster")
    )
    sized = SM.attach_cluster_size(df, broadcast_max_rows=1000)  # beyond the broadcast bound
    assert sized.agg(F.min("cluster_size"), F.max("cluster_size"), F.count("*")).first() == (2, 2, 2 * n)
    blocks = list(S.moment_blocks(S.cluster_moments(df, 1), F.col("n"), block_clusters=60_000, dim=1))
    assert [len(b) for b in blocks] == [60_000, 40_001]
    few = df.where("id < 3")
    scored = S.silhouette_scores(few, S.cluster_moments(df, 1), F.col("n"), 1)  # every cluster against three points
    assert [(r.a, r.b, r.s) for r in scored.orderBy("id").collect()] == [(0.0, 1.0, 1.0)] * 3


def test_distances_far_from_the_origin_agree_on_every_path(spark):
    rows = [(0, [1e8], 0), (1, [1e8 + 1e-3], 1), (2, [-3e8], 2), (3, [1e160], 0), (4, [float("inf")], 1)]
    pts = spark.createDataFrame(rows, "id long, point array<double>, cluster int")
    moments = S.cluster_moments(pts.where("id < 3"), 1)
    got = [
        [(r.id, r.a, r.b, str(r.s)) for r in S.silhouette_scores(pts, moments, F.col("n"), 1, method=m).orderBy("id").collect()]
        for m in ("codegen", "arrow", "lambda")
    ]
    assert got[0] == got[1] == got[2]
    assert got[0][3][1] == float("inf") and 0 < got[0][0][2] < 1e-5


def test_empty_inputs_give_empty_or_null_results(spark):
    from sheaf.operators import ratings as R

    pts = spark.createDataFrame([], "id long, point array<double>, cluster int")
    for df in (S.exact_silhouette(pts), S.approx_silhouette(pts, 5, 1), S.exact_silhouette_sample(pts, 5, 1)):
        row = df.first()
        assert row.n_points == 0 and row.silhouette is None
    assert SM.stratified_sample(pts, 5, 1).count() == 0
    assert SM.cluster_sizes(pts).count() == 0
    rt = spark.createDataFrame([], "product_id string, user_id string, rating float")
    assert R.top_normalized_ratings(rt, 5).collect() == []
    assert R.user_mean_rating(rt).count() == 0
    assert R.center_ratings_by_user(rt).count() == 0


@settings(max_examples=12, deadline=None)
@given(
    rows=st.lists(
        st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 4)), min_size=0, max_size=60
    ),
    t=st.integers(1, 6),
)
def test_places_in_order_equal_the_window_limit(spark, rows, t):
    # Threshold 0 forces the range-partitioned places for every t; ties in u are broken by id.
    data = [(i, c, float(u)) for i, (c, u) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, cluster int, u double").repartition(3)
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    saved = spark.conf.get(key)
    try:
        spark.conf.set(key, "0")
        got = sorted(r.id for r in SM.cap_per_cluster(df, t).collect())
    finally:
        spark.conf.set(key, saved)
    groups = {}
    for i, c, u in sorted(data, key=lambda r: (r[2], r[0])):
        groups.setdefault(c, []).append(i)
    want = sorted(i for ids in groups.values() for i in ids[:t])
    assert got == want


def test_report_holds_both_silhouettes_of_one_sample(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=3) + 4 * (i % 4)], i % 4) for i in range(400)] + [(400, [9.0, 9.0, 9.0], 4)]
    points = spark.createDataFrame(rows, "id long, point array<double>, cluster int")
    for t in (1, 7, 1000):
        row = S.silhouette_report(points, t, seed=5).first()
        approx, own = S.approx_silhouette(points, t, 5).first(), S.exact_silhouette_sample(points, t, 5).first()
        for got, want in ((row.approx_silhouette, approx.silhouette), (row.sample_silhouette, own.silhouette)):
            assert got == pytest.approx(want, nan_ok=True)
        assert (row.n_points, row.n_sample) == (approx.n_points, own.n_points)
    empty = S.silhouette_report(points.where("false"), 5, seed=5).first()
    assert (empty.approx_silhouette, empty.n_points, empty.sample_silhouette, empty.n_sample) == (None, 0, None, 0)


def test_report_draws_its_sample_once(spark, monkeypatch):
    drawn = []
    real = S.stratified_sample
    monkeypatch.setattr(S, "stratified_sample", lambda *a, **k: drawn.append(1) or real(*a, **k))
    points = spark.createDataFrame([(i, [float(i)], i % 2) for i in range(50)], "id long, point array<double>, cluster int")
    S.silhouette_report(points, 5, seed=1).collect()
    assert drawn == [1]
