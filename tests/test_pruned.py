"""Pruned nearest search equals a full scan, and computes few of the distances."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheaf.operators import clustering as C
from sheaf.operators import silhouette as S
from sheaf.operators.pruned import MIN_MEANS, PrunedMeans


def full_scan(points, means, weight, offset, skip=None):
    """First least value per point, NaN behind infinity."""
    value, where = np.full(len(points), np.nan), np.full(len(points), -1)
    with np.errstate(over="ignore", invalid="ignore"):
        for i, p in enumerate(points):
            diff = p - means
            d = weight * (diff * diff).sum(1) + offset
            rank = np.isnan(d).astype(int)
            if skip is not None and skip[i] >= 0:
                rank[skip[i]] = 2
            order = np.lexsort((np.arange(len(d)), np.where(np.isnan(d), 0, d), rank))
            if rank[order[0]] < 2:
                value[i], where[i] = d[order[0]], order[0]
    return value, where


@pytest.mark.parametrize("seed", range(6))
def test_equals_a_full_scan(seed):
    rng = np.random.default_rng(seed)
    k, d = int(rng.integers(1, 900)), int(rng.integers(1, 9))
    means = rng.normal(size=(k, d)) + 5 * rng.integers(0, 6, size=(k, 1))
    means[rng.integers(0, k, k // 5)] = means[0]  # ties
    if seed % 2:
        means[rng.integers(0, k, 3), 0] = [np.nan, np.inf, -np.inf]
        means[rng.integers(0, k), 0] = 1e200
    weight, offset = (np.ones(k), np.zeros(k)) if seed < 2 else (rng.uniform(0.1, 9, k), rng.uniform(0, 30, k))
    points = np.concatenate([rng.normal(size=(80, d)) * 9, means[rng.integers(0, k, 20)], np.full((1, d), 1e200), np.full((1, d), np.inf), np.full((1, d), np.nan)])
    for skip in (None, rng.integers(-1, k, len(points))):
        got = PrunedMeans(means, weight, offset).best(points, skip)
        want = full_scan(points, means, weight, offset, skip)
        np.testing.assert_array_equal(got[1], want[1])
        np.testing.assert_array_equal(got[0], want[0])


def test_a_hundred_thousand_clusters_with_a_small_share_of_the_distances():
    rng = np.random.default_rng(1)
    means = rng.normal(size=(100_000, 6)) * 0.3 + 8 * rng.normal(size=(400, 6))[rng.integers(0, 400, 100_000)]
    points = means[rng.integers(0, len(means), 300)] + rng.normal(size=(300, 6)) * 0.05
    pruned = PrunedMeans(means, np.ones(len(means)), np.zeros(len(means)))
    value, where = pruned.best(points)
    share = pruned.computed / (len(points) * len(means))
    want = full_scan(points, means, np.ones(len(means)), np.zeros(len(means)))
    np.testing.assert_array_equal(where, want[1])
    np.testing.assert_array_equal(value, want[0])
    assert share < 0.02, share


def test_operators_on_many_clusters(spark):
    rng = np.random.default_rng(2)
    k = MIN_MEANS + 200
    x = rng.normal(size=(3 * k, 4)) * 0.2 + 5 * rng.normal(size=(k, 4))[np.arange(3 * k) % k]
    rows = [(i, [float(v) for v in x[i]], (i % k) * 2 + 1) for i in range(3 * k)]
    points = spark.createDataFrame(rows, "id long, point array<double>, cluster int").repartition(3)
    centres = C.centroids(points, 4)
    got = {r.id: r.nearest for r in C.assign_nearest(points, centres).collect()}
    table = sorted((r.cluster, r.centre) for r in centres.collect())
    ids, means = np.array([c for c, _ in table]), np.array([m for _, m in table])
    _, where = full_scan(x, means, np.ones(k), np.zeros(k))
    assert got == {i: ids[where[i]] for i in range(len(x))}

    scored = S.exact_silhouette_scores(points, method="arrow").collect()
    labels = (np.arange(3 * k) % k)
    pair = ((x[:, None] - x[None]) ** 2).sum(2)
    sums = np.stack([pair[:, labels == c].mean(1) for c in range(k)], axis=1)
    for r in scored:
        own = labels[r.id]
        assert r.a == pytest.approx(sums[r.id, own], abs=1e-9)
        assert r.b == pytest.approx(np.delete(sums[r.id], own).min(), abs=1e-9)
    in_blocks = S.exact_silhouette_scores(points, method="arrow", block_clusters=MIN_MEANS + 50)
    both = in_blocks.select("id", F.round("s", 9).alias("s")).collect()
    assert {r.id: r.s for r in both} == {r.id: round(r.s, 9) for r in scored}
