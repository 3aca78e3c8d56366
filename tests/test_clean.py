"""Cleaning rules on micro-fixtures: NULL semantics, identifier and range rules,
sequential deletes against the fused filter."""

from pyspark.sql import functions as F

from quire.operators import clean as C

RATINGS = "user_id bigint, isbn string, book_rating int"
BOOKS = "isbn string, book_title string, book_author string, year_of_publication int"


def _key(t):
    return tuple((x is not None, str(x)) for x in t)


def _set(df, cols=None):
    cols = cols or df.columns
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=_key)


def test_not_in_with_null_in_catalogue_deletes_nothing(spark):
    ratings = spark.createDataFrame([(1, "0000000001", 5), (2, "0000000099", 3)], RATINGS)
    books = spark.createDataFrame([("0000000001", "a", "x", 2000), (None, "b", "y", 2000)], BOOKS)
    assert C.drop_orphans(ratings, books).count() == 2
    tagged = C.tag_rating_rules(ratings, books)
    assert tagged.filter(F.col("dropped_by") == "orphan").count() == 0


def test_rating_with_null_isbn_is_not_an_orphan(spark):
    ratings = spark.createDataFrame([(1, None, 5), (1, "0000000099", 3)], RATINGS)
    books = spark.createDataFrame([("0000000001", "a", "x", 2000)], BOOKS)
    kept = C.drop_orphans(ratings, books)
    assert _set(kept) == [(1, None, 5)]
    tagged = C.tag_rating_rules(ratings, books)
    assert {r["isbn"]: r["dropped_by"] for r in tagged.collect()} == {None: None, "0000000099": "orphan"}


def test_invalid_isbn_rule(spark):
    books = spark.createDataFrame(
        [("", "e", "a", 1), ("12a", "f", "a", 1), ("000000000X", "g", "a", 1), ("0000000001", "h", "a", 1), (None, "n", "a", 1)],
        BOOKS,
    )
    assert _set(C.invalid_books(books), ["isbn"]) == sorted([("",), ("000000000X",), ("12a",)], key=_key)
    assert _set(C.clean_books(books), ["isbn"]) == sorted([(None,), ("0000000001",)], key=_key)


def test_range_rules(spark):
    users = spark.createDataFrame([(1, None), (2, 5), (3, 6), (4, 80), (5, 81)], "user_id bigint, age int")
    assert _set(C.clean_users(users)) == sorted([(1, None), (2, None), (3, 6), (4, 80), (5, None)], key=_key)
    books = spark.createDataFrame(
        [("01", "t", "a", None), ("02", "t", "a", 0), ("03", "t", "a", 2025), ("04", "t", "a", 2026)], BOOKS
    )
    years = {r["isbn"]: r["year_of_publication"] for r in C.clean_books(books).collect()}
    assert years == {"01": None, "02": 0, "03": 2025, "04": None}


def test_null_ratings_and_zero_sums(spark):
    # user 1: only NULL -> SUM is NULL -> kept; user 2: {0, NULL} -> SUM = 0 -> both go;
    # item 2 then holds only user 3's zero -> zero item; user 4's zero on item 4 goes last.
    ratings = spark.createDataFrame(
        [(1, "0000000001", None), (2, "0000000001", 0), (2, "0000000002", None), (3, "0000000002", 0),
         (3, "0000000003", 4), (4, "0000000003", 2), (4, "0000000004", 0), (3, "0000000004", 6)],
        RATINGS,
    )
    books = spark.createDataFrame([(f"000000000{i}", "t", "a", 2000) for i in (1, 2, 3, 4)], BOOKS)
    tags = {(r["user_id"], r["isbn"]): r["dropped_by"] for r in C.tag_rating_rules(ratings, books).collect()}
    assert tags == {
        (1, "0000000001"): None,
        (2, "0000000001"): "zero_user",
        (2, "0000000002"): "zero_user",
        (3, "0000000002"): "zero_item",
        (3, "0000000003"): None,
        (4, "0000000003"): None,
        (4, "0000000004"): "zero_rating",
        (3, "0000000004"): None,
    }
    assert C.drop_zero(ratings).count() == 5


def test_zero_item_rule_runs_after_zero_user_rule(spark):
    # User 7 sums to 0 and goes first; item 1 then holds only user 8's zero, so it sums
    # to 0 only after the user rule has run.
    ratings = spark.createDataFrame(
        [(7, "0000000001", 0), (8, "0000000001", 0), (8, "0000000002", 5), (9, "0000000002", 1)], RATINGS
    )
    books = spark.createDataFrame([(f"000000000{i}", "t", "a", 2000) for i in (1, 2)], BOOKS)
    tags = {(r["user_id"], r["isbn"]): r["dropped_by"] for r in C.tag_rating_rules(ratings, books).collect()}
    assert tags[(7, "0000000001")] == "zero_user"
    assert tags[(8, "0000000001")] == "zero_item"
    assert tags[(8, "0000000002")] is None


def test_sequential_equals_fused_without_nulls(spark):
    from conftest import SF0001
    from quire.plans import fixtures as fx

    ratings, books = fx.ratings(spark, SF0001), fx.books(spark, SF0001)
    a = _set(C.clean_ratings(ratings, books))
    b = _set(C.clean_ratings(ratings, books, fused=True))
    assert a == b and len(a) == 3931
    counts = {r["rule"]: r["n_rows"] for r in C.rule_counts(C.tag_rating_rules(ratings, books)).collect()}
    assert counts == {"orphan": 320, "invalid_isbn": 446, "zero_user": 352, "zero_item": 131, "zero_rating": 202, "kept": 3931}


def test_small_rule_sets_are_broadcast_and_ratings_not_shuffled(spark):
    from conftest import SF0001
    from quire.plans import fixtures as fx

    tagged = C.tag_rating_rules(fx.ratings(spark, SF0001), fx.books(spark, SF0001))
    tagged.collect()
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 3  # bad ISBNs, zero users, zero items
    assert "SortMergeJoin" not in plan
