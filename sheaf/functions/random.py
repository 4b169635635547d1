"""Seeded, retry-stable pseudo-random draws.

A task that is re-run after an executor loss must draw the same values,
so draws are hashes of a stable row key, never ``rand()`` or
``monotonically_increasing_id``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheaf.functions._util import as_col

_TWO_POW_52 = float(2**52)
_TWO_POW_53 = float(2**53)
DRAWS = ("xxhash64", "md5")


def seeded_uniform(key: Column | str, seed: int, draw: str = "xxhash64") -> Column:
    """Uniform double in [0, 1) from a seeded hash of ``key``.

    ``xxhash64`` (default): the low 53 bits of Spark's 64-bit xxHash of
    (seed, key), practically free per row.  ``md5``: the first 52 bits of
    md5("seed:key"), about 1 microsecond per row but reproducible in any SQL
    engine with ``md5`` (the DuckDB oracle uses it).
    """
    if draw == "xxhash64":
        bits = F.xxhash64(F.lit(int(seed)), as_col(key)).bitwiseAND(F.lit((1 << 53) - 1))
        return bits.cast("double") / F.lit(_TWO_POW_53)
    if draw == "md5":
        text = F.concat(F.lit(f"{int(seed)}:"), as_col(key).cast("string"))
        top52 = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")
        return top52.cast("double") / F.lit(_TWO_POW_52)
    raise ValueError(f"draw must be one of {DRAWS}")


def hash_bucket(n_buckets: int, *keys: Column | str, seed: int = 42) -> Column:
    """Stable bucket in [0, n_buckets) from a 64-bit hash of the keys."""
    if n_buckets < 1:
        raise ValueError("n_buckets must be >= 1")
    return F.pmod(F.xxhash64(F.lit(seed), *[as_col(k) for k in keys]), F.lit(n_buckets)).cast("int")
