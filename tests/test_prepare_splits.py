"""Item index, centring and splits."""

from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from conftest import SF0001
from quire.operators import prepare as P
from quire.operators import splits as S
from quire.plans import fixtures as fx


def test_dense_index_equals_string_indexer(spark):
    clean = fx.clean(spark, SF0001)
    ours = {r["isbn"]: r["item_id"] for r in P.item_index(clean).collect()}
    model = StringIndexer(inputCol="isbn", outputCol="idx", handleInvalid="skip").fit(clean)
    theirs = {label: i for i, label in enumerate(model.labels)}
    assert ours == theirs


def test_dense_index_with_many_partitions_and_ties(spark):
    df = spark.createDataFrame([(f"k{i:04d}", i % 7) for i in range(500)], "k string, n int")
    out = P.dense_index(df, [F.desc("n"), F.asc("k")], "idx", num_partitions=13)
    got = [r["k"] for r in out.orderBy("idx").collect()]
    want = [r["k"] for r in df.orderBy(F.desc("n"), F.asc("k")).collect()]
    assert got == want
    assert sorted(r["idx"] for r in out.collect()) == list(range(500))


def test_center_ratings_means_and_nulls(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, "b", 4), (1, "c", None), (2, "a", 5)], "user_id bigint, isbn string, book_rating int")
    out = {(r["user_id"], r["isbn"]): (r["user_mean"], r["norm"]) for r in P.center_ratings(df).collect()}
    assert out[(1, "a")] == (3.0, -1.0)
    assert out[(1, "c")] == (3.0, None)
    assert out[(2, "a")] == (5.0, 0.0)


def test_random_splits_partition_each_fold(spark):
    normed = fx.normed(spark, SF0001)
    n = normed.count()
    tagged = S.random_splits(normed, k=5, seed=42).cache()
    sizes = {(r["fold"], r["split"]): r["n_rows"] for r in S.split_sizes(tagged).collect()}
    for f in range(1, 6):
        assert sizes[(f, "train")] + sizes[(f, "test")] == n
        assert 0.7 < sizes[(f, "train")] / n < 0.9
        # train and test of one fold are disjoint and cover the input
        keys = tagged.filter(F.col("fold") == f).groupBy("user_id", "isbn").count()
        assert keys.filter("count > 1").count() == 0
    # folds are independent draws: test sets differ
    t1 = tagged.filter("fold = 1 and split = 'test'").select("user_id", "isbn")
    t2 = tagged.filter("fold = 2 and split = 'test'").select("user_id", "isbn")
    assert t1.subtract(t2).count() > 0
    tagged.unpersist()


def test_hash_splits_are_deterministic(spark):
    normed = fx.normed(spark, SF0001)
    a = S.hash_splits(normed, k=2).groupBy("fold", "split").count().collect()
    b = S.hash_splits(normed.repartition(3), k=2).groupBy("fold", "split").count().collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_mask_layout_equals_row_layout(spark):
    normed = fx.normed(spark, SF0001)
    rows = S.random_splits(normed, k=5, seed=42)
    masked = S.random_split_mask(normed, k=5, seed=42)
    key = ["user_id", "isbn", "fold", "split"]
    a = rows.select(*key)
    b = S.as_rows(masked, 5).select(*key)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    for f in (1, 3):
        for split in ("train", "test"):
            x = S.fold_rows(rows, f, split).select(*key)
            y = S.fold_rows(masked, f, split).select(*key)
            assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0
    t = S.test_rows(masked, 5).select(*key)
    assert t.exceptAll(rows.filter("split = 'test'").select(*key)).count() == 0
    assert t.count() == rows.filter("split = 'test'").count()


def test_split_mask_of_many_folds(spark):
    import pytest

    from quire.operators import splits

    df = spark.range(2000).withColumnRenamed("id", "x")
    masked = splits.random_split_mask(df, k=40).cache()
    for fold in (1, 33, 40):
        test, train = (splits.fold_rows(masked, fold, side).count() for side in ("test", "train"))
        assert test + train == 2000 and 300 < test < 500
    with pytest.raises(ValueError):
        splits.random_split_mask(df, k=64)


def test_centring_keeps_rows_without_user(spark):
    from quire.operators.prepare import center_ratings

    rows = [(1, 4), (1, 8), (None, 2), (None, 6), (2, None)]
    df = spark.createDataFrame(rows, "user_id bigint, book_rating int")
    for index in (False, True):
        got = center_ratings(df, index_users=index).collect()
        assert sorted((str(r["user_id"]), str(r["norm"])) for r in got) == [
            ("1", "-2.0"), ("1", "2.0"), ("2", "None"), ("None", "-2.0"), ("None", "2.0"),
        ]


def test_hash_split_of_a_class_of_keys_is_mixed(spark):
    """Keys of one remainder are on both sides, in about the asked share."""
    keys = spark.range(4000).selectExpr("id * 10 AS user_id", "cast(id % 7 * 10 AS int) AS item_id")
    tagged = S.hash_splits(keys, k=2)
    for f in (1, 2):
        assert 0.77 < tagged.filter(f"fold = {f} AND split = 'train'").count() / 4000 < 0.83
    assert S.hash_splits(keys, k=1, train_fraction=1.0).filter("split = 'test'").isEmpty()
    assert S.hash_splits(keys, k=1, train_fraction=0.0).filter("split = 'train'").isEmpty()
