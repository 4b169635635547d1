from __future__ import annotations

import numpy as np
import pytest

from sheaf.operators import clustering as C
from sheaf.operators import sampling as SM
from sheaf.operators import silhouette as S
from sheaf.plans.ksweep import k_sweep_silhouette

SCHEMA = "id long, point array<double>"


def _blobs(spark, k=3, n_per=60, seed=1):
    rng = np.random.default_rng(seed)
    centres = np.array([[0.0, 0.0], [20.0, 0.0], [0.0, 20.0], [20.0, 20.0]])[:k]
    rows, truth = [], []
    for c in range(k):
        for _ in range(n_per):
            p = centres[c] + rng.normal(0, 0.5, 2)
            rows.append((len(rows), [float(x) for x in p]))
            truth.append(c)
    return spark.createDataFrame(rows, SCHEMA), np.array(truth)


def test_kmeans_recovers_blobs_up_to_relabelling(spark):
    df, truth = _blobs(spark)
    model = C.kmeans_fit(df, 3, max_iter=20, seed=3)
    got = np.array([r.cluster for r in C.kmeans_assign(model, df).orderBy("id").collect()])
    # same partition: a bijection between labels
    pairs = set(zip(truth.tolist(), got.tolist()))
    assert len(pairs) == 3 and len({g for _, g in pairs}) == 3


def test_k_equals_one(spark):
    df, _ = _blobs(spark, k=2)
    model = C.kmeans_fit(df, 1, max_iter=5)
    assert {r.cluster for r in C.kmeans_assign(model, df).collect()} == {0}
    mean = np.mean([r.point for r in df.collect()], axis=0)
    assert C.kmeans_centres(spark, model).first().centre == pytest.approx(mean.tolist())
    assert C.kmeans_centres(spark, C.kmeans_fit(df.limit(0), 1, max_iter=5)).first().centre == []


def test_duplicates_with_more_centres_than_points(spark):
    df = spark.createDataFrame([(0, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [5.0, 5.0])], SCHEMA)
    model = C.kmeans_fit(df, 5, max_iter=5, seed=1)
    used = {r.cluster for r in C.kmeans_assign(model, df).collect()}
    assert len(used) == 2


@pytest.mark.parametrize("method", ["auto", "codegen", "arrow", "lambda"])
def test_assign_nearest_matches_numpy(spark, method):
    df, _ = _blobs(spark, k=4, n_per=20, seed=7)
    centres = spark.createDataFrame([(10, [1.0, 1.0]), (11, [19.0, 2.0]), (12, [3.0, 18.0])],
                                    "cluster int, centre array<double>")
    got = {r.id: r.nearest for r in C.assign_nearest(df, centres, method=method).collect()}
    cen = {10: np.array([1.0, 1.0]), 11: np.array([19.0, 2.0]), 12: np.array([3.0, 18.0])}
    for r in df.collect():
        p = np.array(r.point)
        want = min(cen, key=lambda c: (((p - cen[c]) ** 2).sum(), c))
        assert got[r.id] == want


def test_k_sweep_prefers_true_k(spark):
    df, _ = _blobs(spark, k=3, n_per=40, seed=2)
    pts = df.selectExpr("id", "point")
    out = k_sweep_silhouette(pts, k_start=2, h=3, max_iter=20, m=90, seed=5).orderBy("k").collect()
    assert [r.k for r in out] == [2, 3, 4]
    assert [r.t for r in out] == [45, 30, 22]
    best = max(out, key=lambda r: r.silhouette)
    assert best.k == 3
    assert all(r.n_points == 120 for r in out)


def test_k_sweep_rejects_t_zero(spark):
    df, _ = _blobs(spark, k=2, n_per=5)
    with pytest.raises(ValueError):
        k_sweep_silhouette(df, k_start=2, h=2, max_iter=2, m=2)


def test_far_centres_have_one_answer_on_every_path(spark):
    centres = spark.createDataFrame([(0, [1e8]), (1, [1e8 + 1e-3]), (2, [-3e8])], "cluster int, centre array<double>")
    pts = [(i, [1e8 + 1e-3 * (i + 0.25) / 200]) for i in range(200)] + [(200, [1e160]), (201, [float("inf")])]
    points = spark.createDataFrame(pts, "id int, point array<double>")
    from sheaf.operators.clustering import assign_nearest

    got = [
        {r.id: r.nearest for r in assign_nearest(points, centres, method=m).collect()} for m in ("codegen", "arrow", "lambda")
    ]
    assert got[0] == got[1] == got[2]


def _labelled(spark, n=300, null=False):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(n, 3)) + 6 * (np.arange(n) % 5)[:, None]
    rows = [(i, [float(v) for v in x[i]], i % 2, i % 5, 0, 3) for i in range(n)]
    return spark.createDataFrame(rows, "id long, point array<double>, two int, five int, one int, cluster int")


def test_silhouettes_of_several_labellings_equal_one_by_one(spark):
    points = _labelled(spark)
    size_of = {"two": 40, "five": 11, "one": 9}
    for normalizer in ("expected", "actual"):
        got = {r.labelling: r for r in S.approx_silhouettes(points, size_of, 3, normalizer=normalizer).collect()}
        assert set(got) == set(size_of)
        for name, t in size_of.items():
            single = points.select("id", "point", points[name].alias("cluster"))
            want = S.approx_silhouette(single, t, 3, normalizer=normalizer).first()
            assert got[name].silhouette == pytest.approx(want.silhouette, abs=1e-9, nan_ok=True)
            assert (got[name].t, got[name].n_points) == (t, want.n_points)


def test_samples_of_several_labellings_equal_one_by_one(spark):
    points = _labelled(spark)
    for sizes in ({"two": 7, "five": 3}, {"two": 2000, "five": 3}):  # above and below the window's map-side limit
        both = SM.stratified_samples(points.drop("cluster"), sizes, 5).collect()
        for name, t in sizes.items():
            want = SM.stratified_sample(points, t, 5, cluster=name).collect()
            assert sorted((r.id, r.cluster, r.cluster_size) for r in both if r.labelling == name) == sorted(
                (r.id, r[name], r.cluster_size) for r in want
            )
    with pytest.raises(Exception, match="null label"):
        SM.stratified_samples(points.selectExpr("id", "point", "nullif(two, 1) AS two"), {"two": 5}, 1).collect()


def test_sweep_scores_are_the_pairwise_ones_of_its_labels(spark):
    """Labels as data: the labels of each k are recorded, and SQL scores them pair by pair."""
    import duckdb

    from sheaf.plans import ksweep, oracle

    points = _labelled(spark, 160).select("id", "point")
    kept = {}
    real = ksweep.approx_silhouettes

    def recorded(labelled, size_of, *args, **kwargs):
        kept["labels"] = labelled.select("id", "point", *size_of).toPandas()
        return real(labelled, size_of, *args, **kwargs)

    ksweep.approx_silhouettes = recorded
    try:
        out = ksweep.k_sweep_silhouette(points, k_start=1, h=4, max_iter=5, m=60, seed=oracle.SAMPLE_SEED, draw="md5").collect()
    finally:
        ksweep.approx_silhouettes = real
    con = duckdb.connect()
    con.register("labels", kept["labels"])
    for row in out:
        pts = f"pts AS (SELECT id, CAST(point AS DOUBLE[]) AS point, cluster_{row.k} AS cluster FROM labels)"
        con.execute(f"CREATE OR REPLACE TABLE embeddings AS SELECT id AS vec_id, point AS embedding, cluster_{row.k} AS label FROM labels")
        sample = oracle.SAMPLE.replace("least(20.0", f"least({row.t}.0").replace("rn <= 20", f"rn <= {row.t}")
        norm = f"least({row.t}.0, CAST(sc.size AS DOUBLE))"
        sql = oracle._with(pts, sample, oracle._silhouette_ctes("pts", "sample", norm)) + " SELECT avg(s), count(*) FROM s"
        want, n = con.execute(sql).fetchone()
        assert row.silhouette == pytest.approx(want, abs=1e-9) and row.n_points == n == 160


def test_sweep_passes_do_not_grow_with_h_and_nothing_stays_cached(spark, monkeypatch):
    from sheaf.plans import ksweep

    points = _labelled(spark, 60).select("id", "point")
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    calls = []
    monkeypatch.setattr(S, "stratified_samples", lambda *a, f=S.stratified_samples, **k: calls.append("sample") or f(*a, **k))
    monkeypatch.setattr(S, "cluster_moments", lambda *a, f=S.cluster_moments, **k: calls.append("moments") or f(*a, **k))
    for h in (1, 5):
        calls.clear()
        assert len(ksweep.k_sweep_silhouette(points, 1, h, 3, 30).collect()) == h
        assert calls == ["sample", "moments"]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached
    monkeypatch.setattr(ksweep, "approx_silhouettes", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ksweep.k_sweep_silhouette(points, 1, 2, 3, 30)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached
