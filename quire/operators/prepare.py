"""Item indexing and per-user centring.

``index_items`` gives the same ids as ``StringIndexer(handleInvalid="skip")`` with
the default ``frequencyDesc`` order (most rated first, ties by the string), but it
never brings the label list to the driver and never puts all items in one task:
items are range-partitioned on the sort order, numbered inside each partition, and
shifted by the sizes of the partitions before them (a table with one row per
partition, so broadcasting it has a proven bound).

``user_means`` aggregates per user and joins the means back, instead of an
unordered window: the aggregate is partial before its shuffle, and the join back
(``skew.join_small``) broadcasts the per-user table when it is within a row bound
and otherwise salts hot users, so a user with a third of all ratings never lands
whole in one task. The per-user and per-item tables are checkpointed (one
row per key) because each is read three times: total, hot keys, join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.skew import join_small
from quire.session import ensure_checkpoint_dir

_PART_BITS = 33  # monotonically_increasing_id = partition index << 33 | row in partition


def dense_index(
    df: DataFrame, order: Sequence[Column], out: str, num_partitions: int | None = None
) -> DataFrame:
    """Add ``out`` = 0..n-1 following ``order`` (which must be a total order).

    Range partitioning puts consecutive keys into consecutive partitions; after a
    local sort, the row position inside a partition is the low part of
    ``monotonically_increasing_id``. The numbered frame is checkpointed (reliable
    storage) so partition sizes and positions come from one materialisation.
    Without ``num_partitions`` AQE may coalesce the range partitions; coalesced
    partitions are contiguous ranges in order, so the numbering is unchanged.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    numbered = (
        ranged
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    numbered = numbered.withColumn("_pid", F.shiftright("_mid", _PART_BITS)).withColumn(
        "_pos", F.col("_mid") - F.shiftleft(F.col("_pid"), _PART_BITS)
    )
    sizes = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_size"))
    # One row per partition: the running total is a window over n rows at most.
    offsets = sizes.select(
        "_pid",
        F.coalesce(
            F.sum("_size").over(
                Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("_offset"),
    )
    return (
        numbered.join(F.broadcast(offsets), "_pid")
        .withColumn(out, F.col("_offset") + F.col("_pos"))
        .drop("_mid", "_pid", "_pos", "_offset")
    )


def item_index(
    ratings: DataFrame, isbn: str = "isbn", out: str = "item_id", with_counts: bool = False
) -> DataFrame:
    """(isbn, item_id): items by rating count descending, ties by ISBN ascending;
    NULL ISBNs are skipped. ``with_counts`` keeps the count as ``_n``."""
    counts = (
        ratings.filter(F.col(isbn).isNotNull())
        .groupBy(isbn)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    indexed = dense_index(counts, [F.desc("_n"), F.asc(isbn)], out)
    cols = [isbn, F.col(out).cast("int").alias(out)] + (["_n"] if with_counts else [])
    return indexed.select(*cols)


def index_items(ratings: DataFrame, isbn: str = "isbn", out: str = "item_id") -> DataFrame:
    """Ratings with ``item_id``; rows with a NULL ISBN are dropped (``skip``)."""
    base = ratings.filter(F.col(isbn).isNotNull())
    items = item_index(base, isbn, out, with_counts=True)
    return join_small(base, items.drop("_n"), isbn, "inner", counts=items)


def user_means(ratings: DataFrame, user: str = "user_id", rating: str = "book_rating") -> DataFrame:
    """(user, user_mean, _n): one row per user, checkpointed."""
    ensure_checkpoint_dir(ratings.sparkSession)
    return (
        ratings.groupBy(user)
        .agg(F.avg(rating).alias("user_mean"), F.count(F.lit(1)).alias("_n"))
        .checkpoint(eager=True)
    )


INT_MIN, INT_MAX = -(2**31), 2**31 - 1


def center_ratings(
    ratings: DataFrame,
    user: str = "user_id",
    rating: str = "book_rating",
    out: str = "norm",
    index_users: bool | str = False,
) -> DataFrame:
    """Add ``user_mean`` and ``out`` = rating - user mean (NULL rating stays NULL). Rows
    without user have the mean of all such rows, as a window over the user gives, and no
    ``user_idx``.

    ``index_users`` adds ``user_idx``, a dense int id per user (ids in user
    order), for ALS, which only takes int ids. It is numbered on the per-user
    table that is built anyway, so it rides on the same join. ``"auto"`` numbers
    users only when some id does not fit in an int.
    """
    means = user_means(ratings, user, rating)
    without = means.filter(F.col(user).isNull()).select("user_mean").first()
    if index_users == "auto":
        lo, hi = means.agg(F.min(user), F.max(user)).first()
        index_users = lo is not None and (lo < INT_MIN or hi > INT_MAX)
    if index_users:
        means = dense_index(means.filter(F.col(user).isNotNull()), [F.asc(user)], "user_idx").withColumn(
            "user_idx", F.col("user_idx").cast("int")
        )
    joined = join_small(ratings, means.drop("_n"), user, "inner", counts=means)
    if without:
        alone = ratings.filter(F.col(user).isNull()).withColumn("user_mean", F.lit(without[0]).cast("double"))
        joined = joined.unionByName(alone, allowMissingColumns=True)
    return joined.withColumn(out, F.col(rating).cast("double") - F.col("user_mean"))


def prepare(
    ratings: DataFrame,
    user: str = "user_id",
    isbn: str = "isbn",
    rating: str = "book_rating",
    index_users: bool | str = False,
) -> DataFrame:
    """Index items, then centre per user: the user-item table every model uses.

    Rows with a NULL ISBN are skipped by the indexer, so they take no part in the
    means either; both the index and the means are aggregated from that filtered
    input, and the input is joined with each (no join is computed twice).
    """
    base = ratings.filter(F.col(isbn).isNotNull())
    return center_ratings(index_items(base, isbn), user, rating, index_users=index_users)


def ui_matrix(df: DataFrame, columns: Sequence[str] = ("user_id", "isbn", "book_rating")) -> DataFrame:
    return df.select(*columns)
