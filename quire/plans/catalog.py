"""Registered queries: one per operator of the blueprint, each (spark, sf_dir) -> DataFrame.

Every query reads the whole driver tables through the fixture views and returns
named columns; doubles are rounded to 6 decimals so that Spark and the SQL oracle
(see ``oracle.py``, same keys) can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import clean as C
from quire.operators import dump as D
from quire.operators import evaluate as E
from quire.operators import prepare as P
from quire.operators import profile as PR
from quire.operators import recommend as R
from quire.operators import splits as S
from quire.operators import train as T
from quire.operators.dedup import insert_or_ignore
from quire.operators.topk import top_items
from quire.plans import fixtures as fx
from quire.plans import reports as RP
from quire import schemas
from quire.sources import read_dump_statements

Query = Callable[[SparkSession, str], DataFrame]


def _r(c: str, digits: int = 6):
    return F.round(F.col(c).cast("double"), digits).alias(c)


# ------------------------------------------------------------------ profile

def q_top_books(spark, d):
    return PR.top_rated_books(fx.ratings(spark, d), fx.books(spark, d), k=10)


def q_top_users(spark, d):
    return PR.top_users(fx.ratings(spark, d), k=10)


def q_hist_users(spark, d):
    return PR.activity_histogram(fx.ratings(spark, d), "user_id")


def q_hist_books(spark, d):
    return PR.activity_histogram(fx.ratings(spark, d), "isbn")


def q_table_counts(spark, d):
    return PR.table_counts(fx.users(spark, d), fx.books(spark, d), fx.ratings(spark, d))


def q_sparsity(spark, d):
    s = PR.sparsity(fx.normed(spark, d), "user_id", "item_id")
    return s.select("n_users", "n_items", "n_ratings", _r("sparsity"))


def q_ratings_per_user(spark, d):
    return PR.ratings_per(fx.ratings(spark, d), "user_id")


# ------------------------------------------------------------------ clean

def q_invalid_isbn(spark, d):
    return C.count_invalid_books(fx.books(spark, d))


def q_invalid_book_ratings(spark, d):
    rated = C.invalid_book_ratings(fx.ratings(spark, d), fx.books(spark, d))
    return rated.agg(F.count(F.lit(1)).alias("n_ratings"))


def q_orphan_ratings(spark, d):
    tagged = C.tag_rating_rules(fx.ratings(spark, d), fx.books(spark, d))
    return tagged.filter(F.col("dropped_by") == "orphan").select("user_id", "isbn", "book_rating")


def q_drop_orphans(spark, d):
    return C.drop_orphans(fx.ratings(spark, d), fx.books(spark, d)).select("user_id", "isbn", "book_rating")


def q_clean_counts(spark, d):
    return C.rule_counts(C.tag_rating_rules(fx.ratings(spark, d), fx.books(spark, d)))


def q_clean_ratings(spark, d):
    return fx.clean(spark, d).select("user_id", "isbn", "item_key", "book_rating")


def q_clean_ratings_fused(spark, d):
    fused = C.clean_ratings(fx.ratings(spark, d), fx.books(spark, d), fused=True)
    return fused.select("user_id", "isbn", "item_key", "book_rating")


def q_clean_books(spark, d):
    return C.clean_books(fx.books(spark, d))


def q_clean_users(spark, d):
    return C.clean_users(fx.users(spark, d))


def q_clean_age(spark, d):
    """P5 alone: ages outside 6..80 become NULL."""
    return C.clean_users(fx.users(spark, d)).select("user_id", "age")


def q_clean_year(spark, d):
    """P6 alone, on the whole catalogue: years above 2025 become NULL."""
    from quire.functions.predicates import YEAR_MAX, null_above

    books = fx.books(spark, d)
    return books.select("isbn", null_above("year_of_publication", YEAR_MAX).alias("year_of_publication"))


def q_zero_users(spark, d):
    return C.all_zero_keys(fx.ratings(spark, d), "user_id")


def q_zero_items(spark, d):
    return C.all_zero_keys(fx.ratings(spark, d), "isbn")


def q_drop_zero_users(spark, d):
    return C.drop_all_zero(fx.ratings(spark, d), "user_id").select("user_id", "isbn", "book_rating")


def q_drop_zero(spark, d):
    return C.drop_zero(fx.ratings(spark, d)).select("user_id", "isbn", "book_rating")


def q_dedup_ratings(spark, d):
    return fx.ratings(spark, d).select("user_id", "isbn", "item_key", "book_rating")


# ------------------------------------------------------------------ prepare

def q_index_items(spark, d):
    return P.item_index(fx.clean(spark, d))


def q_center_ratings(spark, d):
    n = fx.normed(spark, d)
    return n.select("user_id", "isbn", "item_id", "book_rating", _r("user_mean"), _r("norm"))


def q_ui_matrix(spark, d):
    return P.ui_matrix(fx.clean(spark, d))


def q_split_sizes(spark, d):
    return S.split_sizes(S.hash_splits(fx.normed(spark, d), k=5, seed=42))


# ------------------------------------------------------------------ evaluate

def q_rmse_by_user(spark, d):
    return E.rmse_by(fx.preds(spark, d), "user_id").select("user_id", _r("rmse"))


def q_rmse_by_item(spark, d):
    return E.rmse_by(fx.preds(spark, d), "item_id").select("item_id", _r("rmse"))


def q_rmse_by_user_raw(spark, d):
    rm = E.rmse_by(fx.preds(spark, d), "user_id", label="book_rating", drop="any")
    return rm.select("user_id", _r("rmse"))


def q_macro_rmse(spark, d):
    ev = E.evaluate(fx.preds(spark, d))
    return ev.select(_r("ub_rmse"), _r("ib_rmse"), _r("rmse"), "n_pred")


def q_global_rmse(spark, d):
    return E.global_rmse(fx.preds(spark, d)).select(_r("rmse"))


def q_rmse_hist(spark, d):
    return E.rmse_histogram_table(fx.preds(spark, d))


def _baseline_cross(spark, d):
    tagged = S.hash_splits(fx.normed(spark, d), k=5, seed=42, mask=True)
    return E.cross_evaluate(T.item_mean_cross_predict(tagged, wide=True))


def q_cross_eval(spark, d):
    return _baseline_cross(spark, d).select("model", _r("ub_rmse_avg"), _r("ib_rmse_avg"))


def q_best_model(spark, d):
    return E.best_models(_baseline_cross(spark, d)).select("method", "model", _r("rmse"))


# ------------------------------------------------------------------ recommend

def q_sample_users(spark, d):
    return R.sample_users(fx.clean(spark, d), 250, seed=42, method="hash")


def q_items_lookup(spark, d):
    return R.items_lookup(fx.normed(spark, d), fx.books(spark, d))


def q_items_lookup_nobooks(spark, d):
    return R.items_lookup(fx.normed(spark, d), None)


def _baseline_scores(spark, d):
    # Score rounded to 9 decimals so that float summation order cannot reorder ties.
    return fx.preds(spark, d).select("user_id", "item_id", F.round("prediction", 9).alias("score"))


def q_rec_topk(spark, d):
    ranked = R.rank_topk(_baseline_scores(spark, d), k=10)
    return ranked.select("user_id", "item_id", F.col("rank").cast("int").alias("rank"), _r("score"))


def q_rec_lines(spark, d):
    lookup = R.items_lookup(fx.normed(spark, d), fx.books(spark, d))
    return R.lines_for_scores(_baseline_scores(spark, d), lookup, k=10)


def q_factor_topk(spark, d):
    """Bounded top-k search over factors of whole numbers (exact in any order of addition):
    a user's rating count and sum against an item's greatest rating and rating count."""
    normed = fx.normed(spark, d)
    pair = lambda a, b: F.array(a.cast("double"), b.cast("double")).alias("features")
    n, rating = F.count(F.lit(1)), F.col("book_rating")
    users = normed.groupBy(F.col("user_id").alias("id")).agg(pair(n, F.sum(rating)))
    items = normed.groupBy(F.col("item_id").alias("id")).agg(pair(F.max(rating), n))
    lists = top_items(users, items, k=10).withColumnRenamed("id", "user_id")
    return R.explode_recs(lists).select("user_id", "item_id", "rank", "score")


# ------------------------------------------------------------------ dump

def q_dump_normalize(spark, d):
    return D.normalize_dump(fx.dump_lines(spark, d)).select("source", "value")


def q_dump_insert_count(spark, d):
    return D.count_inserts(D.normalize_dump(fx.dump_lines(spark, d)), by=["source"])


def q_dump_parse(spark, d):
    lines = D.normalize_dump(fx.dump_lines(spark, d))
    rows = D.parse_dump_rows(lines, "BX_Book_Ratings", schemas.RATINGS)
    n = fx.n_raw_ratings(spark, d)
    return insert_or_ignore(rows, ["user_id", "isbn"], ["load_order"], rows=n).select(
        "user_id", "isbn", "book_rating"
    )


def q_dump_parse_books(spark, d):
    lines = D.normalize_dump(fx.dump_lines(spark, d))
    return D.parse_dump_rows(lines, "BX_Books", schemas.BOOKS).drop("load_order")


def q_dump_statements(spark, d):
    """Statements over several lines and file splits, parsed."""
    statements = read_dump_statements(spark, fx.statement_dump(spark, d))
    return D.parse_dump_rows(statements, "BX-Books", schemas.BOOKS).drop("load_order")


# ------------------------------------------------------------------ reports

def _clean_tables(spark, d):
    return C.clean_users(fx.users(spark, d)), C.clean_books(fx.books(spark, d))


def q_basics_report(spark, d):
    return RP.basics_report(*_clean_tables(spark, d), fx.clean(spark, d))


def q_basics_delta(spark, d):
    users, books = fx.users(spark, d), fx.books(spark, d)
    tagged = C.tag_rating_rules(fx.ratings(spark, d), books)
    return RP.basics_delta((users, books), _clean_tables(spark, d), tagged)


def q_model_report(spark, d):
    best = E.best_models(_baseline_cross(spark, d))
    lookup = R.items_lookup(fx.normed(spark, d), fx.books(spark, d))
    lines = R.lines_for_scores(_baseline_scores(spark, d), lookup, k=10).select(
        F.lit("UBCF").alias("method"), "*"
    )
    return RP.model_report(best, fx.preds(spark, d), lines)


QUERIES: dict[str, Query] = {
    "top_books": q_top_books,
    "top_users": q_top_users,
    "hist_users": q_hist_users,
    "hist_books": q_hist_books,
    "table_counts": q_table_counts,
    "sparsity": q_sparsity,
    "ratings_per_user": q_ratings_per_user,
    "invalid_isbn": q_invalid_isbn,
    "invalid_book_ratings": q_invalid_book_ratings,
    "orphan_ratings": q_orphan_ratings,
    "drop_orphans": q_drop_orphans,
    "clean_counts": q_clean_counts,
    "clean_ratings": q_clean_ratings,
    "clean_ratings_fused": q_clean_ratings_fused,
    "clean_books": q_clean_books,
    "clean_users": q_clean_users,
    "clean_age": q_clean_age,
    "clean_year": q_clean_year,
    "zero_users": q_zero_users,
    "zero_items": q_zero_items,
    "drop_zero_users": q_drop_zero_users,
    "drop_zero": q_drop_zero,
    "dedup_ratings": q_dedup_ratings,
    "index_items": q_index_items,
    "center_ratings": q_center_ratings,
    "ui_matrix": q_ui_matrix,
    "split_sizes": q_split_sizes,
    "rmse_by_user": q_rmse_by_user,
    "rmse_by_item": q_rmse_by_item,
    "rmse_by_user_raw": q_rmse_by_user_raw,
    "macro_rmse": q_macro_rmse,
    "global_rmse": q_global_rmse,
    "rmse_hist": q_rmse_hist,
    "cross_eval": q_cross_eval,
    "best_model": q_best_model,
    "sample_users": q_sample_users,
    "items_lookup": q_items_lookup,
    "items_lookup_nobooks": q_items_lookup_nobooks,
    "rec_topk": q_rec_topk,
    "rec_lines": q_rec_lines,
    "factor_topk": q_factor_topk,
    "dump_normalize": q_dump_normalize,
    "dump_insert_count": q_dump_insert_count,
    "dump_parse": q_dump_parse,
    "dump_parse_books": q_dump_parse_books,
    "dump_statements": q_dump_statements,
    "basics_report": q_basics_report,
    "basics_delta": q_basics_delta,
    "model_report": q_model_report,
}
