"""Normalised-rating top-T.

ratings(product_id, user_id, rating:float)
  -> centre each rating on its user's mean rating (float32 arithmetic)
  -> maximum centred rating per product
  -> products by that maximum, descending (NaN last), top T.

Scale notes.  The user mean is a partial (map-side) aggregate, so a user
holding a third of all rows costs one hash-table entry per task, not one
task.  It is then joined back on the user key:

* ``join`` (default): the means (one row per user, with its rating count)
  are written once to the checkpoint folder and broadcast only when a
  bounded count shows at most ``broadcast_max_rows`` users, so the ratings
  are never shuffled.  Above the bound, hot users (more than twice the even
  share of a shuffle partition, or ``hot_fraction`` of all ratings) are
  broadcast and joined map-side, and only the other users' ratings go
  through a shuffle join, in which no key can hold more than that share.
* ``lazy_join``: the same join with no job at plan time; AQE converts it
  to a broadcast join from measured sizes, after both sides were shuffled.

There is no window strategy (``avg over partitionBy(user)``): it would
put all rows of a user, possibly a third of the table, into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaf.operators.joins import DEFAULT_BROADCAST_MAX_ROWS, hot_share, join_group_values, materialize
from sheaf.operators.ordering import number_in_order

STRATEGIES = ("join", "lazy_join")


def _mean_of(rating: str) -> Column:
    # Mean accumulated in double, then narrowed to float like the reference.
    return F.avg(F.col(rating).cast("double")).cast("float")


def user_mean_rating(
    ratings: DataFrame, user: str = "user_id", rating: str = "rating"
) -> DataFrame:
    """(user_id, mean_rating:float) per user."""
    return ratings.groupBy(user).agg(_mean_of(rating).alias("mean_rating"))


def _user_key(ratings: DataFrame, user: str) -> list[Column]:
    """A null-free join key (user with a type default, user is null).

    Plain equality on it lets the means aggregate's hash partitioning serve
    the join directly, while null users still form their own group.  Types
    without a plain default are wrapped in a struct, which is never null.
    """
    dtype = ratings.schema[user].dataType
    if isinstance(dtype, T.StringType):
        default = F.lit("")
    elif isinstance(dtype, (T.IntegralType, T.FractionalType)):
        default = F.lit(0).cast(dtype)
    else:
        return [F.struct(F.col(user)).alias("_uk"), F.col(user).isNull().alias("_un")]
    return [F.coalesce(F.col(user), default).alias("_uk"), F.col(user).isNull().alias("_un")]


def attach_user_mean(
    ratings: DataFrame,
    user: str = "user_id",
    rating: str = "rating",
    strategy: str = "join",
    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
    hot_fraction: float | None = None,
) -> DataFrame:
    """Add ``mean_rating`` (float), the mean rating of the row's user; every row kept.

    ``join``: per-user means (one partial aggregate), joined back through a
    size-checked broadcast, or a shuffle join with hot users split off.
    ``lazy_join``: a plain join, planned by Spark/AQE.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    hot_share(ratings.sparkSession, hot_fraction)  # refuse a bad fraction on every path
    keyed = ratings.select("*", *_user_key(ratings, user))
    means = keyed.groupBy("_uk", "_un").agg(_mean_of(rating).alias("_mean"), F.count(F.lit(1)).alias("_n"))
    if strategy == "lazy_join":
        joined = keyed.join(means.drop("_n"), ["_uk", "_un"])
    else:
        joined = join_group_values(keyed, means, ["_uk", "_un"], "_n", broadcast_max_rows, hot_fraction)
    return joined.select(*[F.col(c) for c in ratings.columns], F.col("_mean").alias("mean_rating"))


def center_ratings_by_user(
    ratings: DataFrame,
    user: str = "user_id",
    rating: str = "rating",
    strategy: str = "join",
    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
    hot_fraction: float | None = None,
) -> DataFrame:
    """Add ``norm_rating = rating - mean rating of the user`` (float); every row kept."""
    with_mean = attach_user_mean(ratings, user, rating, strategy, broadcast_max_rows, hot_fraction)
    return with_mean.select(
        *[F.col(c) for c in ratings.columns],
        (F.col(rating) - F.col("mean_rating")).alias("norm_rating"),
    )


def rating_deviation(ratings: DataFrame, **kwargs) -> DataFrame:
    """(product_id, norm_rating) pairs, the reference's intermediate RDD."""
    return center_ratings_by_user(ratings, **kwargs).select("product_id", "norm_rating")


def max_norm_rating(
    centred: DataFrame, product: str = "product_id", value: str = "norm_rating"
) -> DataFrame:
    """(product_id, max_norm_rating) – NaN wins, as with ``Math.max``."""
    return centred.groupBy(product).agg(F.max(value).alias("max_norm_rating"))


def max_of_partials(
    partials: DataFrame, product: str = "product_id", value: str = "partial_max_norm_rating"
) -> DataFrame:
    """Round 2 of the two-round maximum: (product_id, max_norm_rating) from the partial maxima."""
    return max_norm_rating(partials, product, value)


def partial_max_by_partition(
    centred: DataFrame, product: str = "product_id", value: str = "norm_rating"
) -> DataFrame:
    """Round 1 of the two-round maximum: the maximum per product inside each partition.

    Catalyst already does this as the partial ``HashAggregate`` of
    ``max_norm_rating``; this explicit form exposes the intermediate
    result, which depends on the partition layout.
    """
    return centred.groupBy(F.spark_partition_id().alias("partition_id"), F.col(product)).agg(
        F.max(value).alias("partial_max_norm_rating")
    )


def _rank_order(value: str, key: str) -> list[Column]:
    # Descending by value via the negated key, so NaN (largest) sorts last;
    # ties broken by the key for a deterministic result.
    return [(-F.col(value)).asc_nulls_last(), F.col(key).asc_nulls_last()]


def rank_products(
    maxima: DataFrame, product: str = "product_id", value: str = "max_norm_rating"
) -> DataFrame:
    """All products with their 1-based ``rank`` (bigint): value descending (NaN last), then product id.

    A range-partitioned sort, written once, plus the rows of the partitions before each one.
    """
    ranked = number_in_order(maxima.select(product, value), _rank_order(value, product))
    return ranked.select("rank", product, value)


def top_products(
    maxima: DataFrame, t: int, product: str = "product_id", value: str = "max_norm_rating"
) -> DataFrame:
    """First ``t`` products with a 1-based ``rank``; ``t <= 0`` gives no rows.

    ``orderBy().limit()`` plans a ``TakeOrderedAndProject``: each task keeps
    its own top t, so at most t rows per task are ever moved.
    """
    t = max(int(t), 0)
    order = _rank_order(value, product)
    top = maxima.orderBy(*order).limit(t)
    return top.select(
        F.row_number().over(Window.orderBy(*order)).alias("rank"), F.col(product), F.col(value)
    )


def top_normalized_ratings(
    ratings: DataFrame,
    t: int,
    strategy: str = "join",
    user: str = "user_id",
    product: str = "product_id",
    rating: str = "rating",
    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
    materialize_input: bool = False,
) -> DataFrame:
    """Q1: top-T products by maximum user-mean-centred rating.

    ``materialize_input`` writes the ratings once to the checkpoint folder
    first: worth it when they come out of an expensive join, which the
    means branch and the centring branch would otherwise both re-run.
    """
    if materialize_input:
        ratings = materialize(ratings.select(product, user, rating))
    centred = center_ratings_by_user(
        ratings, user=user, rating=rating, strategy=strategy, broadcast_max_rows=broadcast_max_rows
    )
    return top_products(max_norm_rating(centred, product=product), t, product=product)


# The wording of the reference's printed report line.
REPORT_PRODUCT = "Product "
REPORT_VALUE = " maxNormRating "


def report_lines(top: DataFrame, product: str = "product_id", value: str = "max_norm_rating") -> DataFrame:
    """(rank, line) with ``line = "Product <id> maxNormRating <value>"``, the printed report.

    Casting a float to string gives Java's ``Float.toString`` form, as the
    reference's string concatenation does.
    """
    line = F.concat(F.lit(REPORT_PRODUCT), F.col(product).cast("string"), F.lit(REPORT_VALUE), F.col(value).cast("string"))
    return top.select("rank", line.alias("line"))
