"""Dense-vector column functions over ``array<double>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheaf.functions._util import as_col


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v)


def sqdist(p: Column | str, q: Column | str) -> Column:
    """Squared Euclidean distance; raises when the lengths differ."""
    p, q = as_col(p), as_col(q)
    return F.when(
        F.size(p) != F.size(q),
        F.raise_error(F.lit("sqdist: vectors of different length")),
    ).otherwise(_sum(F.zip_with(p, q, lambda x, y: (x - y) * (x - y))))


def silhouette_value(a: Column | str, b: Column | str) -> Column:
    """``(b - a) / max(a, b)`` with 0/0 giving NaN, as in float arithmetic.

    ANSI mode raises on division by zero, so the zero case is explicit.
    """
    a, b = as_col(a), as_col(b)
    m = F.greatest(a, b)
    return F.when(m == 0, F.lit(float("nan"))).otherwise((b - a) / F.nullif(m, F.lit(0.0)))
