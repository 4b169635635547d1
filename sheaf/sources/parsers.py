"""Positional line parsers with explicit result types.

Malformed input fails the query (ANSI casts and array indexing raise),
matching the fail-fast behaviour of the reference programs.  A NaN
coordinate is rejected as well: the nearest-cluster minimum would treat
it differently from Java's ``Math.min`` (Spark orders NaN above every
number), so such a point has no well-defined silhouette.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.strings import java_split


def _no_nan(point: Column) -> Column:
    return F.when(
        F.exists(point, lambda x: F.isnan(x)), F.raise_error(F.lit("NaN coordinate in a point"))
    ).otherwise(point)


def parse_ratings(df: DataFrame, value: str = "value", keep: Iterable[str] = ()) -> DataFrame:
    """``product,user,rating[,ignored...]`` -> product_id, user_id, rating:float."""
    tokens = java_split(value, ",")
    return df.select(
        *keep,
        tokens[0].alias("product_id"),
        tokens[1].alias("user_id"),
        tokens[2].cast("float").alias("rating"),
    )


def parse_labeled_points(df: DataFrame, value: str = "value", keep: Iterable[str] = ()) -> DataFrame:
    """``x1,...,xd,label`` -> point:array<double> (all but last), cluster:int (last)."""
    tokens = F.col("_tokens")
    return (
        df.select(*keep, java_split(value, ",").alias("_tokens"))
        .select(
            *keep,
            _no_nan(F.transform(F.slice(tokens, 1, F.size(tokens) - 1), lambda x: x.cast("double"))).alias("point"),
            F.element_at(tokens, -1).cast("int").alias("cluster"),
        )
    )


def parse_points(df: DataFrame, value: str = "value", keep: Iterable[str] = (), sep: str = " ") -> DataFrame:
    """``x1 x2 ... xd`` -> point:array<double>; an empty token is an error."""
    return df.select(
        *keep,
        _no_nan(F.transform(java_split(value, sep), lambda x: x.cast("double"))).alias("point"),
    )
