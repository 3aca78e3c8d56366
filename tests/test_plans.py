"""Plans that must keep their shape: scans, joins and shuffles counted."""

import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from quire.operators import evaluate as E
from quire.operators import profile as PR
from quire.operators import recommend as R
from quire.operators import skew
from quire.operators import splits as S
from quire.operators import train as T
from quire.plans import fixtures as fx


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    return plan_of(df).count("FileScan parquet")


@pytest.fixture(scope="module")
def preds(spark, tmp_path_factory):
    path = os.path.join(str(tmp_path_factory.mktemp("plans")), "preds")
    fx.preds(spark, SF0001).withColumn("fold", F.lit(1)).withColumn("model", F.lit(2)).write.parquet(path)
    return spark.read.parquet(path)


def test_evaluation_scans_the_predictions_once(spark, preds):
    assert scans(E.evaluate(preds, by=["model", "fold"])) == 1
    assert scans(E.evaluate(preds)) == 1
    assert scans(E.cross_evaluate(preds)) == 1
    assert scans(E.rmse_histogram_table(preds)) == 1


def test_evaluation_with_nulls_and_empty_predictions(spark):
    schema = "user_id bigint, item_id int, norm double, prediction double"
    rows = [(1, 1, 1.0, 2.0), (1, 2, None, 1.0), (None, 1, 0.0, 3.0), (2, None, 5.0, 5.0), (3, 3, 1.0, None), (4, 4, 1.0, float("nan"))]
    got = E.evaluate(spark.createDataFrame(rows, schema)).first()
    # users: 1 -> 1, null -> 3, 2 -> 0; items: 1 -> sqrt(5), 2 -> none, null -> 0
    assert got["ub_rmse"] == pytest.approx(4 / 3) and got["ib_rmse"] == pytest.approx(5**0.5 / 2)
    assert got["rmse"] == pytest.approx((10 / 3) ** 0.5) and got["n_pred"] == 4
    empty = E.evaluate(spark.createDataFrame([], schema)).first()
    assert tuple(empty) == (None, None, None, 0)


def test_sparsity_expands_no_rows(spark):
    rows = [(1, "a"), (1, "b"), (2, None), (None, "a"), (2, "a")]
    df = spark.createDataFrame(rows, "user_id bigint, item_id string")
    got = PR.sparsity(df)
    assert "Expand" not in plan_of(got) and "SortAggregate" not in plan_of(got)
    assert tuple(got.first()) == (2, 2, 5, 1 - 5 / 4)
    assert tuple(PR.sparsity(df.limit(0)).first()) == (0, 0, 0, None)


def test_activity_of_raw_and_kept_rows_in_one_scan(spark, tmp_dir):
    rows = [(1, "a", 5, None), (1, "b", 0, "zero"), (2, "a", 3, "orphan"), (None, "a", 2, None), (2, "b", None, None)]
    path = os.path.join(tmp_dir, "tagged")
    spark.createDataFrame(rows, "user_id bigint, isbn string, book_rating int, dropped_by string").write.parquet(path)
    table = PR.activity_table(spark.read.parquet(path), kept=F.col("dropped_by").isNull())
    assert scans(table) == 1
    got = {(r["by_book"], r["user_id"], r["isbn"]): tuple(r)[3:] for r in table.collect()}
    assert got == {
        (False, 1, None): (2, 1, 1, 1),
        (False, 2, None): (2, 1, 1, 0),
        (False, None, None): (1, 1, 1, 1),
        (True, None, "a"): (3, 3, 2, 2),
        (True, None, "b"): (2, 0, 1, 0),
    }


def test_cross_scoring_joins_each_side_once_and_equals_the_models(spark):
    tagged = S.random_split_mask(fx.normed(spark, SF0001), k=3, keys=("user_id", "isbn"))
    models = T.train_folds(tagged, k=3, seed=5, maxIter=3)
    got = T.cross_predict(models, tagged)
    assert len(re.findall(r"\w+Join\b", plan_of(got))) == 2
    keys = ["user_id", "item_id", "fold", "model"]
    ours = {tuple(r[c] for c in keys): r["prediction"] for r in got.collect()}
    theirs = {}
    for m, model in models.items():
        for r in T.predict(model, S.test_rows(tagged, 3)).collect():
            theirs[r["user_id"], r["item_id"], r["fold"], m] = r["prediction"]
    assert ours.keys() == theirs.keys() and len(ours) > 500
    assert all(abs(ours[k] - theirs[k]) < 1e-5 for k in ours)
    own = T.cross_predict(models, tagged, own_fold_only=True).collect()
    assert {tuple(r[c] for c in keys) for r in own} == {k for k in ours if k[2] == k[3]}


def test_cross_scoring_salts_hot_keys_beyond_the_bound(spark):
    tagged = S.random_split_mask(fx.normed(spark, SF0001), k=2, keys=("user_id", "isbn"))
    models = T.train_folds(tagged, k=2, seed=5, maxIter=2)
    want = sorted(map(str, T.cross_predict(models, tagged).collect()))
    held = {skew.BROADCAST_ROWS_CONF: "0", skew.MIN_ROWS_CONF: "3", skew.SHARE_CONF: "1000"}
    for key, value in held.items():
        spark.conf.set(key, value)
    try:
        salted = T.cross_predict(models, tagged)
        assert "_salt" in plan_of(salted) and sorted(map(str, salted.collect())) == want
    finally:
        for key in held:
            spark.conf.unset(key)


def test_user_sample_shuffles_n_rows_a_task(spark):
    ratings = fx.clean(spark, SF0001)
    sample = R.sample_users(ratings, 25, seed=42, method="hash")
    key = F.md5(F.concat_ws(":", F.col("user_id").cast("string"), F.lit("42")))
    whole = ratings.select("user_id").distinct().orderBy(key, "user_id").limit(25)
    assert [r[0] for r in sample.collect()] == [r[0] for r in whole.collect()]
    local = R._least_per_task(ratings.repartition(4).select("user_id", key.alias("_key")), 25, ["_key", "user_id"])
    assert local.count() <= 4 * 25
    nulls = spark.createDataFrame([(None,), (None,), (1,)], "user_id bigint")
    assert R.sample_users(nulls, 5, seed=1, method="hash").count() == 2


def test_keyed_draws_do_not_depend_on_partitioning(spark):
    normed = fx.normed(spark, SF0001).select("user_id", "isbn")
    keys = ("user_id", "isbn")
    a = S.random_split_mask(normed.repartition(3), k=4, keys=keys)
    b = S.random_split_mask(normed.repartition(11, "isbn"), k=4, keys=keys)
    assert a.exceptAll(b).count() == 0
    sizes = S.split_sizes(S.random_splits(normed, k=4, keys=keys)).filter("split = 'test'").collect()
    total = normed.count()
    assert len(sizes) == 4 and all(0.17 < r["n_rows"] / total < 0.23 for r in sizes)
    rows = S.as_rows(a, 4).groupBy("fold", "split").count().collect()
    assert {(r["fold"], r["split"]): r["count"] for r in rows}[1, "test"] == {r["fold"]: r["n_rows"] for r in sizes}[1]


def test_broadcasts_are_bounded_by_bytes(spark):
    rows, size = skew.measured(spark.createDataFrame([(1, "x" * 1000, [1.0] * 100, ["ab", None])], "a int, b string, c array<double>, d array<string>"))
    assert rows == 1 and 1800 < size < 1900
    big = spark.range(50).withColumn("k", F.col("id") % 5)
    small = spark.range(5).select(F.col("id").alias("k"), F.lit("y" * 5000).alias("v"))
    spark.conf.set(skew.BROADCAST_BYTES_CONF, "10000")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = skew.join_small(big, small, "k")
        assert "BroadcastHashJoin" not in plan_of(joined) and joined.count() == 50
    finally:
        spark.conf.unset(skew.BROADCAST_BYTES_CONF)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_cross_scoring_keeps_a_test_row_one_row(spark):
    tagged = S.random_split_mask(fx.normed(spark, SF0001), k=3, keys=("user_id", "isbn"))
    models = T.train_folds(tagged, k=3, seed=5, maxIter=3)
    long_, wide = T.cross_predict(models, tagged), T.cross_predict(models, tagged, wide=True)
    keys = ["user_id", "item_id", "fold"]
    ours = {(*[r[c] for c in keys], m): r[f"prediction_{m}"] for r in wide.collect() for m in models}
    theirs = {(*[r[c] for c in keys], r["model"]): r["prediction"] for r in long_.collect()}
    assert {k: v for k, v in ours.items() if v is not None} == theirs
    want = {r["model"]: r for r in E.cross_evaluate(long_).collect()}
    got = {r["model"]: r for r in E.cross_evaluate(wide).collect()}
    assert want.keys() == got.keys() == {1, 2, 3}
    assert all(abs(got[m][c] - want[m][c]) < 1e-9 for m in want for c in ("ub_rmse_avg", "ib_rmse_avg"))
    rows = S.as_rows(tagged, 3)
    assert {(*[r[c] for c in keys], r["model"]): r["prediction"] for r in T.cross_predict(models, rows).collect()} == theirs
    own = {(*[r[c] for c in keys], r["model"]): r["prediction"] for r in T.cross_predict(models, tagged, own_fold_only=True).collect()}
    assert own == {k: v for k, v in theirs.items() if k[2] == k[3]}
    # The products of all models stay out of whole-stage code: one method of all is never compiled.
    products = next(line for line in plan_of(wide).splitlines() if "AS _value_1#" in line)
    assert "*(" not in products.split("Project")[0]
