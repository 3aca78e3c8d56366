"""Rule-based cleaning: orphan, invalid-identifier, range and all-zero rules.

The reference deletes rows in place, in this order: ratings of books missing from
the catalogue, ratings of books with an invalid ISBN, the invalid books, out-of-range
ages and years (set to NULL), ratings of users whose ratings sum to zero, ratings of
books whose ratings sum to zero, and finally zero ratings. Here every delete is a
filter or a join over immutable DataFrames, and ``tag_rating_rules`` records for
each rating the first rule that removes it, so the per-rule counts and the clean
table come from one plan.

Scale notes: the catalogue rules are decided per distinct ISBN (an aggregate of
the ratings, joined with the distinct catalogue), and only the bad ISBNs are
joined back to the ratings. The all-zero rules aggregate partially before their
shuffle. Each set joined back goes through ``skew.join_small``: counted, and
broadcast when within a row bound (the usual case: the full ratings are scanned
but not shuffled), otherwise joined by a shuffle that salts the hot keys named by
the per-key counts, so a user or book with a third of all ratings is joined by
many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.predicates import (
    AGE_MAX,
    AGE_MIN,
    NON_DIGIT,
    YEAR_MAX,
    invalid_isbn,
    null_above,
    null_out_of_range,
)
from quire.operators.skew import join_small
from quire.session import ensure_checkpoint_dir

# Rule names, in the order the reference applies them.
RULES = ("orphan", "invalid_isbn", "zero_user", "zero_item", "zero_rating")


def _bool(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def catalogue_has_null(books: DataFrame, isbn: str = "isbn") -> bool:
    """``NOT IN`` against a list holding NULL is never true, so such a catalogue
    deletes no orphan. One short job, stopped at the first NULL found."""
    return books.select(isbn).filter(F.col(isbn).isNull()).limit(1).count() > 0


def invalid_books(books: DataFrame, isbn: str = "isbn", pattern: str = NON_DIGIT) -> DataFrame:
    return books.filter(_bool(invalid_isbn(isbn, pattern)))


def count_invalid_books(books: DataFrame, isbn: str = "isbn", pattern: str = NON_DIGIT) -> DataFrame:
    return invalid_books(books, isbn, pattern).agg(F.count(F.lit(1)).alias("n_invalid_books"))


def invalid_book_ratings(
    ratings: DataFrame, books: DataFrame, isbn: str = "isbn", pattern: str = NON_DIGIT
) -> DataFrame:
    """Ratings whose ISBN is one of the catalogue's invalid ISBNs (semi join)."""
    keys = invalid_books(books, isbn, pattern).select(isbn).distinct()
    return _by_key(ratings, keys, isbn, "left_semi")


def _by_key(rows: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    """Semi or anti join with a set of keys: broadcast when small, else hot keys salted."""
    ensure_checkpoint_dir(rows.sparkSession)
    counts = lambda: key_counts(rows.filter(F.col(key).isNotNull()), key)
    return join_small(rows, keys, key, how, counts=counts).select(*rows.columns)


def drop_orphans(ratings: DataFrame, books: DataFrame, isbn: str = "isbn") -> DataFrame:
    """``DELETE ... WHERE isbn NOT IN (SELECT isbn FROM books)`` as an anti join
    with the orphan ISBNs (decided per distinct ISBN, see ``bad_isbns``). A rating
    with a NULL ISBN is not deleted by ``NOT IN``, and a catalogue holding a NULL
    ISBN deletes nothing."""
    orphans = bad_isbns(ratings, books, isbn).filter(F.col("_rule") == "orphan").select(isbn)
    return _by_key(ratings, orphans, isbn, "left_anti")


def all_zero_keys(df: DataFrame, key: str, rating: str = "book_rating") -> DataFrame:
    """Keys whose ratings sum to exactly 0 (``HAVING SUM(rating) = 0``); a group
    of only NULL ratings sums to NULL and is not selected."""
    return df.groupBy(key).agg(F.sum(rating).alias("_sum")).filter(F.col("_sum") == 0).select(key)


def drop_all_zero(df: DataFrame, key: str, rating: str = "book_rating") -> DataFrame:
    return _by_key(df, all_zero_keys(df, key, rating), key, "left_anti")


def drop_zero(df: DataFrame, rating: str = "book_rating") -> DataFrame:
    """``DELETE WHERE rating = 0``: NULL ratings stay."""
    return df.filter(~_bool(F.col(rating) == 0))


def bad_isbns(
    ratings: DataFrame,
    books: DataFrame,
    isbn: str = "isbn",
    pattern: str = NON_DIGIT,
    rated: DataFrame | None = None,
) -> DataFrame:
    """(isbn, _rule): every rated ISBN the first two rules delete, decided once per
    ISBN instead of once per rating.

    Distinct rated ISBNs (partial aggregation) meet distinct catalogue ISBNs; only
    the ISBNs that are orphans or invalid come out. That set is usually far smaller
    than the ratings, so joining it back lets AQE broadcast it and the ratings are
    never shuffled for the catalogue rules; when it is large the join shuffles.
    ``rated`` may pass the distinct rated ISBNs when they are already at hand.
    """
    null_in_catalogue = catalogue_has_null(books, isbn)
    if rated is None:
        rated = ratings.select(isbn).filter(F.col(isbn).isNotNull()).distinct()
    catalogue = (
        books.select(isbn).filter(F.col(isbn).isNotNull()).distinct().withColumn("_in", F.lit(True))
    )
    per_isbn = rated.join(catalogue, isbn, "left")
    in_catalogue = F.col("_in").isNotNull()
    rule = F.when(~in_catalogue & F.lit(not null_in_catalogue), F.lit("orphan")).when(
        in_catalogue & _bool(invalid_isbn(F.col(isbn), pattern)), F.lit("invalid_isbn")
    )
    return per_isbn.select(isbn, rule.alias("_rule")).filter(F.col("_rule").isNotNull())


def key_counts(df: DataFrame, key: str, rating: str | None = None, alive=None) -> DataFrame:
    """(key, _n[, _sum]): rows per key, and the sum of ``rating`` over the rows
    where ``alive`` holds; checkpointed, since totals, hot keys and the rule all
    read it."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    if rating is not None:
        value = F.col(rating) if alive is None else F.when(alive, F.col(rating))
        aggs.append(F.sum(value).alias("_sum"))
    return df.groupBy(key).agg(*aggs).checkpoint(eager=True)


def tag_rating_rules(
    ratings: DataFrame,
    books: DataFrame,
    user: str = "user_id",
    isbn: str = "isbn",
    rating: str = "book_rating",
    pattern: str = NON_DIGIT,
    fused: bool = False,
) -> DataFrame:
    """Ratings plus ``dropped_by``: the first rule that deletes the row, or NULL.

    ``fused=True`` skips the two all-zero group rules. With no NULL and no
    negative rating they are subsumed by the final zero-rating delete (a group
    summing to 0 holds only zeros), which saves two aggregations and joins.
    """
    ensure_checkpoint_dir(ratings.sparkSession)
    bad = bad_isbns(ratings, books, isbn, pattern)
    tagged = join_small(
        ratings, bad, isbn, "left", counts=lambda: key_counts(ratings.filter(F.col(isbn).isNotNull()), isbn)
    ).withColumnRenamed("_rule", "dropped_by")

    if not fused:
        for key, rule in ((user, "zero_user"), (isbn, "zero_item")):
            alive = F.col("dropped_by").isNull()
            counts = key_counts(tagged.filter(F.col(key).isNotNull()), key, rating, alive)
            # HAVING SUM(rating) = 0 over the rows still alive; a key with no alive
            # row sums to NULL and is not selected.
            zero = counts.filter(F.col("_sum") == 0).select(
                key, F.lit(True).alias("_zero")
            )
            tagged = (
                join_small(tagged, zero, key, "left", counts=counts)
                .withColumn(
                    "dropped_by",
                    F.when(
                        F.col("dropped_by").isNull() & F.col("_zero").isNotNull(), F.lit(rule)
                    ).otherwise(F.col("dropped_by")),
                )
                .drop("_zero")
            )

    zero_rating = F.col("dropped_by").isNull() & _bool(F.col(rating) == 0)
    return tagged.withColumn(
        "dropped_by", F.when(zero_rating, F.lit("zero_rating")).otherwise(F.col("dropped_by"))
    ).select(*ratings.columns, "dropped_by")


def clean_ratings(ratings: DataFrame, books: DataFrame, **kwargs) -> DataFrame:
    tagged = tag_rating_rules(ratings, books, **kwargs)
    return tagged.filter(F.col("dropped_by").isNull()).select(*ratings.columns)


def rule_counts(tagged: DataFrame) -> DataFrame:
    """(rule, n_rows): rows removed by each rule, and the rows ``kept``."""
    return tagged.groupBy(F.coalesce(F.col("dropped_by"), F.lit("kept")).alias("rule")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def clean_books(
    books: DataFrame,
    isbn: str = "isbn",
    year: str = "year_of_publication",
    pattern: str = NON_DIGIT,
    year_max: int = YEAR_MAX,
) -> DataFrame:
    """Drop books with an invalid ISBN (NULL ISBN stays), NULL out years above the cap."""
    kept = books.filter(~_bool(invalid_isbn(isbn, pattern)))
    return kept.withColumn(year, null_above(year, year_max))


def clean_users(users: DataFrame, age: str = "age", lo: int = AGE_MIN, hi: int = AGE_MAX) -> DataFrame:
    """Users are never deleted; ages outside [lo, hi] become NULL."""
    return users.withColumn(age, null_out_of_range(age, lo, hi))


def clean(
    ratings: DataFrame, books: DataFrame, users: DataFrame, **kwargs
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All rules: (clean ratings, clean books, clean users)."""
    return clean_ratings(ratings, books, **kwargs), clean_books(books), clean_users(users)
