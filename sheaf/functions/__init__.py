"""Scalar column functions (all built-in Spark expressions, no UDF)."""

from sheaf.functions.random import hash_bucket, seeded_uniform
from sheaf.functions.strings import java_split, text_to_lines, utf16_length
from sheaf.functions.vectors import silhouette_value, sqdist

__all__ = [
    "hash_bucket",
    "java_split",
    "seeded_uniform",
    "silhouette_value",
    "sqdist",
    "text_to_lines",
    "utf16_length",
]
