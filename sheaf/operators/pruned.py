"""Exact nearest search over many cluster means, pruned by distance bounds.

The value of mean j for a point p is ``weight_j * ||p - mean_j||^2 + offset_j``
(weight 1 and offset 0: the nearest centre).  The means are grouped about
2 sqrt(k) pivots.  For a group of radius r whose pivot lies at distance
D from p, every mean is at least ``max(0, D - r)`` away, so a group whose
bound is above the best value found so far is passed over.  What remains is
computed by differences, as without pruning, and equal values go to the
smaller position: the result is the one of a full scan.

NaN ranks above every number, infinity included; a point or mean that is
not finite has no bounds and is compared with everything.
"""

from __future__ import annotations

import numpy as np

#: From this many means on, groups pay.
MIN_MEANS = 512
#: Values of a block of differences.
BLOCK_VALUES = 1 << 21


class PrunedMeans:
    """k means of ``dim`` coordinates with weights and offsets, in groups."""

    def __init__(self, means: np.ndarray, weight: np.ndarray, offset: np.ndarray):
        k = len(means)
        self.computed = 0  # distances to means, for measuring
        n = max(1, 2 * int(np.sqrt(k)))
        finite = np.flatnonzero(np.isfinite(means).all(1))
        rng = np.random.default_rng(5)  # any choice of pivots is right
        pivots = means[np.sort(rng.choice(finite, min(n, len(finite)), replace=False))] if len(finite) else means[:0]
        group, gap = np.full(k, len(pivots)), np.full(k, np.inf)
        step = max(1, BLOCK_VALUES // max(1, pivots.size))
        for at in range(0, len(finite), step):
            part = finite[at : at + step]
            d = _distances(means[part], pivots)
            group[part] = d.argmin(1)
            gap[part] = d[np.arange(len(part)), group[part]]
        order = np.argsort(group, kind="stable")  # ascending positions within a group
        used, first = np.unique(group[order], return_index=True)
        self.members = np.split(order, first[1:])
        self.means, self.weight, self.offset = means, weight, offset
        # the group without a pivot (means that are not finite) has no bound
        self.pivots = np.array([pivots[g] if g < len(pivots) else np.full(means.shape[1], np.nan) for g in used]).reshape(len(used), means.shape[1])
        self.radius = np.array([gap[m].max() for m in self.members])
        self.least_weight = np.array([weight[m].min() for m in self.members])
        self.least_offset = np.array([offset[m].min() for m in self.members])

    def best(self, points: np.ndarray, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(value, position) of the least mean of each point; position -1 when there is none.

        ``skip``: a position that a point must not take (-1: none).
        """
        n = len(points)
        value, where = np.full(n, np.nan), np.full(n, -1)
        with np.errstate(over="ignore", invalid="ignore"):
            far = _distances(points, self.pivots)
            bound = np.maximum(far * (1 - 1e-9) - self.radius * (1 + 1e-9), 0.0)
            bound = self.least_weight * bound * bound * (1 - 1e-9) + self.least_offset * (1 - 1e-9)
        bound[~np.isfinite(far)] = np.nan  # no bound
        near = np.where(np.isnan(far), np.inf, far).argmin(1)
        for g in np.unique(near):
            self._look(points, np.flatnonzero(near == g), g, value, where, skip)
        for g in range(len(self.members)):
            open_ = (near != g) & ~((bound[:, g] > value) & (where >= 0))
            rows = np.flatnonzero(open_)
            if len(rows):
                self._look(points, rows, g, value, where, skip)
        return value, where

    def _look(self, points: np.ndarray, rows: np.ndarray, g: int, value: np.ndarray, where: np.ndarray, skip: np.ndarray | None) -> None:
        members = self.members[g]
        means, weight, offset = self.means[members], self.weight[members], self.offset[members]
        step = max(1, BLOCK_VALUES // max(1, means.size))
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            self.computed += len(part) * len(members)
            with np.errstate(over="ignore", invalid="ignore"):
                diff = points[part][:, None, :] - means
                found = weight * (diff * diff).sum(2) + offset
            rank = np.where(np.isnan(found), 1, 0)  # NaN behind infinity
            if skip is not None:
                rank[members == skip[part][:, None]] = 2
            low = np.where(rank == 0, found, np.inf)
            pick = low.argmin(1)
            lost = np.flatnonzero(rank[np.arange(len(part)), pick] > 0)  # the least is infinity, NaN or left out
            pick[lost] = rank[lost].argmin(1)
            kind = rank[np.arange(len(part)), pick]
            new, place = found[np.arange(len(part)), pick], members[pick]
            old, had = value[part], where[part]
            better = (new < old) | (np.isnan(old) & ~np.isnan(new)) | (had < 0)
            same = (new == old) | (np.isnan(new) & np.isnan(old))
            better |= same & (place < had)
            better &= kind < 2
            value[part[better]], where[part[better]] = new[better], place[better]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all rows of ``a`` to all rows of ``b``, by differences, in blocks."""
    out = np.empty((len(a), len(b)))
    step = max(1, BLOCK_VALUES // max(1, b.size))
    with np.errstate(over="ignore", invalid="ignore"):
        for at in range(0, len(a), step):
            diff = a[at : at + step, None, :] - b
            out[at : at + step] = np.sqrt((diff * diff).sum(2))
    return out
