"""ALS invariants, recommendation lines on micro-fixtures, and plan checks."""

import os

import numpy as np
from pyspark.sql import functions as F

from conftest import SF0001
from quire.operators import evaluate as E
from quire.operators import profile as PR
from quire.operators import recommend as R
from quire.operators import splits as S
from quire.operators import train as T
from quire.plans import fixtures as fx
from quire.sources import load_model, save_model


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_als_invariants(spark, tmp_dir):
    normed = fx.normed(spark, SF0001).cache()
    tagged = S.hash_splits(normed, k=1)
    model = T.train_als(T.fold_frame(tagged, 1, "train"), seed=7)
    # non-negative factors
    for fac in (model.userFactors, model.itemFactors):
        mins = fac.select(F.array_min("features").alias("m")).agg(F.min("m")).first()[0]
        assert mins >= 0.0
    # save / load predicts the same
    path = os.path.join(tmp_dir, "model")
    save_model(model, path)
    again = load_model(path)
    test = T.fold_frame(tagged, 1, "test")
    a = {(r["user_id"], r["item_id"]): r["prediction"] for r in T.predict(model, test).collect()}
    b = {(r["user_id"], r["item_id"]): r["prediction"] for r in T.predict(again, test).collect()}
    assert a == b and len(a) > 0
    # top-k equals brute force over the factors
    users = normed.select("user_id").distinct().orderBy("user_id").limit(20)
    recs = R.explode_recs(R.recommend(model, users, 10)).collect()
    uf = {r["id"]: np.array(r["features"]) for r in model.userFactors.collect()}
    itf = {r["id"]: np.array(r["features"]) for r in model.itemFactors.collect()}
    ids = np.array(sorted(itf))
    mat = np.stack([itf[i] for i in ids])
    by_user = {}
    for r in recs:
        by_user.setdefault(r["user_id"], []).append((r["score"], r["item_id"]))
    for u, got in by_user.items():
        scores = mat @ uf[u]
        best = np.sort(scores)[::-1][:10]
        assert np.allclose(sorted([s for s, _ in got], reverse=True), best, atol=1e-5)
    normed.unpersist()


def test_lines_micro(spark):
    lookup = spark.createDataFrame(
        [(1, "0001", "A very long title indeed"), (2, "0002", ""), (3, "0003", "Short")],
        "item_id int, isbn string, book_title string",
    )
    scores = spark.createDataFrame(
        [(10, 1, 0.5), (10, 2, 0.9), (10, 3, 0.5), (10, 99, 0.1), (11, 3, 1.0)],
        "user_id bigint, item_id int, score double",
    )
    lines = {r["user_id"]: (r["n_items"], r["line"]) for r in R.lines_for_scores(scores, lookup, k=10).collect()}
    # rank: 2 (0.9), then tie 0.5 broken by item id: 1 before 3, then 99 (missing lookup)
    assert lines[10] == (4, "Item2  A very long   Short  Item99" + "  " * 6)
    assert lines[11] == (1, "Short" + "  " * 9)


def test_lines_are_as_wide_as_asked(spark):
    lookup = spark.createDataFrame([(i, f"{i}", f"T{i}") for i in range(30)], "item_id int, isbn string, book_title string")
    scores = spark.createDataFrame([(1, i, float(-i)) for i in range(30)], "user_id bigint, item_id int, score double")
    for k in (3, 20):
        row = R.lines_for_scores(scores, lookup, k=k).first()
        assert row["n_items"] == k and row["line"] == "  ".join(f"T{i}" for i in range(k))


def test_lookup_dedups_catalogue(spark):
    rated = spark.createDataFrame([("0001", 0), ("0002", 1)], "isbn string, item_id int")
    books = spark.createDataFrame([("0001", "B"), ("0001", "A"), ("0003", "C")], "isbn string, book_title string")
    got = sorted(tuple(r) for r in R.items_lookup(rated, books).collect())
    assert got == [("0001", 0, "A"), ("0002", 1, "Unknown")]
    nob = sorted(tuple(r) for r in R.items_lookup(rated, None).collect())
    assert nob == [("0001", 0, "0001"), ("0002", 1, "0002")]


def test_plans_have_no_python_and_use_partial_topk(spark):
    preds = fx.preds(spark, SF0001)
    lookup = R.items_lookup(fx.normed(spark, SF0001), fx.books(spark, SF0001))
    scores = preds.select("user_id", "item_id", F.col("prediction").alias("score"))
    lines = R.lines_for_scores(scores, lookup)
    lines.collect()
    plan = _plan(lines)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "WindowGroupLimit" in plan
    top = PR.top_users(fx.ratings(spark, SF0001))
    top.collect()
    assert "TakeOrderedAndProject" in _plan(top)


def test_evaluation_identities(spark):
    preds = fx.preds(spark, SF0001).cache()
    per_user = E.rmse_by(preds, "user_id")
    mean_of_users = per_user.agg(F.avg("rmse")).first()[0]
    ev = E.evaluate(preds).first()
    assert abs(ev["ub_rmse"] - mean_of_users) < 1e-12
    hist = E.rmse_histogram_table(preds).agg(F.sum("n_ubcf"), F.sum("n_ibcf")).first()
    assert hist[0] == per_user.count()
    assert hist[1] == E.rmse_by(preds, "item_id").count()
    ratings = fx.ratings(spark, SF0001)
    h = PR.activity_histogram(ratings, "user_id").agg(F.sum(F.col("bin") * F.col("n")), F.sum("n")).first()
    assert h[0] == ratings.filter("book_rating > 0").count()
    assert h[1] == ratings.filter("book_rating > 0").select("user_id").distinct().count()
    preds.unpersist()


def test_cross_evaluate_and_best(spark):
    tagged = S.hash_splits(fx.normed(spark, SF0001), k=3)
    res = E.cross_evaluate(T.item_mean_cross_predict(tagged)).collect()
    assert sorted(r["model"] for r in res) == [1, 2, 3]
    best = {r["method"]: r["model"] for r in E.best_models(spark.createDataFrame(res)).collect()}
    assert best["UBCF"] == min(res, key=lambda r: (r["ub_rmse_avg"], r["model"]))["model"]
    assert best["IBCF"] == min(res, key=lambda r: (r["ib_rmse_avg"], r["model"]))["model"]


def test_top_list_ties_at_rank_ten_break_by_key(spark):
    # eleven books with one rating each: the tie at rank 10 goes to the smaller ISBN
    ratings = spark.createDataFrame(
        [(u, f"{i:010d}", 5) for i, u in zip(range(11), range(100, 111))], "user_id bigint, isbn string, book_rating int"
    )
    books = spark.createDataFrame(
        [(f"{i:010d}", f"t{i}", "a") for i in range(11)], "isbn string, book_title string, book_author string"
    )
    top = PR.top_rated_books(ratings, books, k=10).orderBy("rank").collect()
    assert [r["isbn"] for r in top] == [f"{i:010d}" for i in range(10)]
    assert [r["rank"] for r in top] == list(range(1, 11))


def test_duplicate_catalogue_isbn_fans_out_like_the_join(spark):
    ratings = spark.createDataFrame([(1, "0000000001", 5), (2, "0000000001", 3)], "user_id bigint, isbn string, book_rating int")
    books = spark.createDataFrame(
        [("0000000001", "B", "x"), ("0000000001", "A", "y")], "isbn string, book_title string, book_author string"
    )
    row = PR.top_rated_books(ratings, books).first()
    # join then count: two catalogue rows x two ratings
    assert row["n_ratings"] == 4 and (row["book_title"], row["book_author"]) == ("A", "y")


def test_cold_start_rows_are_dropped(spark):
    train = spark.createDataFrame(
        [(1, 0, 1.0), (1, 1, -1.0), (2, 0, 0.5), (2, 1, 0.2), (3, 1, 0.3)], "user_id bigint, item_id int, norm double"
    )
    test = spark.createDataFrame(
        [(1, 1, 0.0), (9, 0, 1.0), (2, 7, 1.0)], "user_id bigint, item_id int, norm double"
    )
    model = T.train_als(train, seed=3, rank=2, maxIter=3)
    preds = T.predict(model, test).collect()
    assert [(r["user_id"], r["item_id"]) for r in preds] == [(1, 1)]


def test_user_ids_beyond_int_range_are_indexed_for_als(spark):
    from quire.operators import prepare as P

    big = 2**40
    ratings = fx.clean(spark, SF0001).withColumn("user_id", F.col("user_id") + F.lit(big))
    normed = P.prepare(ratings, index_users="auto")
    assert "user_idx" in normed.columns
    n_users = normed.select("user_id").distinct().count()
    assert sorted(r[0] for r in normed.select("user_idx").distinct().collect()) == list(range(n_users))
    assert "user_idx" not in P.prepare(fx.clean(spark, SF0001), index_users="auto").columns
    model = T.train_als(normed, seed=1, user="user_idx", maxIter=3)
    users = normed.select("user_id", "user_idx").distinct().orderBy("user_id").limit(15)
    lookup = R.items_lookup(normed, fx.books(spark, SF0001))
    lines = R.model_lines(model, users, lookup, k=10).collect()
    assert len(lines) == 15 and all(r["user_id"] >= big for r in lines)
    assert all(r["n_items"] == 10 for r in lines)


def test_global_rmse_equals_regression_evaluator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator

    tagged = S.hash_splits(fx.normed(spark, SF0001), k=1)
    model = T.train_als(T.fold_frame(tagged, 1, "train"), seed=5, maxIter=5)
    preds = T.predict(model, T.fold_frame(tagged, 1, "test"))
    ours = E.global_rmse(preds).first()["rmse"]
    theirs = RegressionEvaluator(metricName="rmse", labelCol="norm", predictionCol="prediction").evaluate(
        preds.na.drop(subset=["prediction"])
    )
    assert abs(ours - theirs) < 1e-9


def test_top_books_prefer_a_title_that_is_there(spark):
    from quire.operators.profile import top_rated_books

    ratings = spark.createDataFrame([(1, "a", 5)], "user_id bigint, isbn string, book_rating int")
    books = spark.createDataFrame([("a", None, "A"), ("a", "T", None), ("a", "T", "B")], "isbn string, book_title string, book_author string")
    row = top_rated_books(ratings, books).collect()[0]
    assert (row["book_title"], row["book_author"], row["n_ratings"]) == ("T", "B", 3)


def test_rows_without_rating_do_not_train(spark):
    rows = spark.createDataFrame([(1, 1, 1.0), (2, 2, 2.0), (1, 2, None), (None, 1, 1.0)], "user_id int, item_id int, norm double")
    model = T.train_als(rows, rank=2, maxIter=1)
    assert model.userFactors.count() == 2 and model.itemFactors.count() == 2
