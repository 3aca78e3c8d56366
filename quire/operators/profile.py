"""Profiling: table counts, activity histograms, top lists, matrix sparsity.

Every operator is a group-by with partial (map-side) aggregation followed, for the
top lists, by ``TakeOrderedAndProject``: each task keeps its k best rows and the
final merge sees at most k rows per task. Ties are always broken by the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.predicates import positive


def table_counts(users: DataFrame, books: DataFrame, ratings: DataFrame) -> DataFrame:
    """(metric, n) for users, books and ratings."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("metric"), "n")
        for name, df in (("users", users), ("books", books), ("ratings", ratings))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def ratings_per(df: DataFrame, key: str, rating: str = "book_rating") -> DataFrame:
    """(key, n_ratings) over positive ratings."""
    return df.filter(positive(rating)).groupBy(key).agg(F.count(F.lit(1)).alias("n_ratings"))


def activity_histogram(df: DataFrame, key: str, rating: str = "book_rating") -> DataFrame:
    """(bin, n): how many keys have exactly ``bin`` positive ratings. Both steps
    aggregate partially; the second works on one row per key."""
    return histogram_of_counts(ratings_per(df, key, rating))


def histogram_of_counts(per_key: DataFrame, n_col: str = "n_ratings") -> DataFrame:
    """(bin, n) from a per-key count table (keys with a zero count are left out)."""
    positive_keys = per_key.filter(F.col(n_col) > 0)
    return positive_keys.groupBy(F.col(n_col).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def _rank_top(df: DataFrame, order: list, k: int) -> DataFrame:
    top = df.orderBy(*order).limit(k)
    # At most k rows: a single-partition window here is bounded by construction.
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("int"))


def top_users(df: DataFrame, k: int = 10, user: str = "user_id", rating: str = "book_rating") -> DataFrame:
    """(rank, user_id, n_ratings): the k users with most positive ratings."""
    return top_of_counts(ratings_per(df, user, rating), user, k)


def top_of_counts(per_key: DataFrame, key: str, k: int = 10, n_col: str = "n_ratings") -> DataFrame:
    """(rank, key, n_ratings): the k keys with the highest positive count."""
    ranked = per_key.filter(F.col(n_col) > 0)
    return _rank_top(ranked, [F.desc(n_col), F.asc(key)], k).select("rank", key, n_col)


def top_rated_books(
    ratings: DataFrame,
    books: DataFrame,
    k: int = 10,
    isbn: str = "isbn",
    title: str = "book_title",
    author: str = "book_author",
    rating: str = "book_rating",
) -> DataFrame:
    """(rank, isbn, book_title, book_author, n_ratings): the k most-rated books.

    Same result as joining ratings with the catalogue and counting per ISBN, but
    ratings are counted per ISBN first (partial aggregation, no skew), so the join
    sees one row per ISBN. A catalogue with repeated ISBNs fans the count out,
    exactly as the join-then-count does; title and author come from one of them.
    """
    return top_books_of_counts(ratings_per(ratings, isbn, rating), books, k, isbn, title, author)


def top_books_of_counts(
    per_book: DataFrame,
    books: DataFrame,
    k: int = 10,
    isbn: str = "isbn",
    title: str = "book_title",
    author: str = "book_author",
) -> DataFrame:
    """``top_rated_books`` from a per-ISBN positive count table.

    The catalogue is reduced to one row per ISBN first (number of copies, and the
    smallest (title, author), nulls last), so a repeated ISBN cannot pile up in one join task;
    the count is then n_ratings x copies, exactly what join-then-count gives."""
    per_book = per_book.filter(F.col("n_ratings") > 0)
    catalogue = books.groupBy(isbn).agg(
        F.count(F.lit(1)).alias("_copies"),
        F.min(F.struct(F.isnull(title), title, F.isnull(author), author)).alias("_book"),
    )
    per_isbn = per_book.join(catalogue, isbn, "inner").select(
        isbn,
        F.col(f"_book.{title}").alias(title),
        F.col(f"_book.{author}").alias(author),
        (F.col("n_ratings") * F.col("_copies")).alias("n_ratings"),
    )
    return _rank_top(per_isbn, [F.desc("n_ratings"), F.asc(isbn)], k).select(
        "rank", isbn, title, author, "n_ratings"
    )


def activity_table(
    ratings: DataFrame, user: str = "user_id", isbn: str = "isbn", rating: str = "book_rating", kept: Column | None = None
) -> DataFrame:
    """(by_book, user, isbn, n_rows, n_ratings, rows_kept, ratings_kept): for every user
    (``by_book`` false) and every book (true) its rows and its positive ratings, of all
    rows and of those where ``kept`` holds. One scan: grouping sets count each row once
    per entity before the shuffle. The row counts, histograms and top lists of a profile,
    before and after cleaning, all derive from this table."""
    rows = ratings.select(
        F.col(user).alias("_user"), F.col(isbn).alias("_isbn"), positive(rating).alias("_rated"), (F.lit(True) if kept is None else kept).alias("_kept")
    )
    counted = rows.groupingSets([[F.col("_user")], [F.col("_isbn")]], "_user", "_isbn").agg(
        (F.grouping("_user") == 1).alias("by_book"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("_rated").alias("n_ratings"),
        F.count_if("_kept").alias("rows_kept"),
        F.count_if(F.col("_rated") & F.col("_kept")).alias("ratings_kept"),
    )
    counts = ["n_rows", "n_ratings", "rows_kept", "ratings_kept"]
    return counted.select("by_book", F.col("_user").alias(user), F.col("_isbn").alias(isbn), *counts)


def sparsity(df: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """(n_users, n_items, n_ratings, sparsity) in one job; the reference runs three. An
    empty table yields a NULL sparsity instead of a division error.

    Users and items are counted from their own per-key tables: two scans of one column
    each, hash aggregates on both sides of the shuffle, no row expanded. A null user or
    item is none, its row a rating."""
    none = F.lit(0).cast("bigint")
    users = df.groupBy(user).agg(F.count(F.lit(1)).alias("_n"))
    users = users.agg(F.count(user).alias("n_users"), F.coalesce(F.sum("_n"), none).alias("n_ratings"))
    items = df.groupBy(item).agg(F.any_value(F.lit(1)).alias("_one")).agg(F.count(item).alias("n_items"))
    parts = users.select("n_users", none.alias("n_items"), "n_ratings").unionByName(
        items.select(none.alias("n_users"), "n_items", none.alias("n_ratings"))
    )
    counts = parts.agg(*[F.sum(c).alias(c) for c in ("n_users", "n_items", "n_ratings")])
    cells = F.col("n_users").cast("double") * F.col("n_items").cast("double")
    return counts.withColumn(
        "sparsity", F.lit(1.0) - F.try_divide(F.col("n_ratings").cast("double"), cells)
    )
