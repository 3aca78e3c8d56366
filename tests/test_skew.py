"""A key holding a third of all rows: results stay whole and exact, the hot group
is reduced before the shuffle, and AQE splits it on joins."""

import pytest
from pyspark.sql import functions as F

from quire.operators import clean as C
from quire.operators import prepare as P
from quire.operators import recommend as R
from quire.operators.dedup import insert_or_ignore


@pytest.fixture()
def skewed(spark):
    # 30,000 ratings; user 1 holds 10,000 of them, book 0000000007 another 10,000.
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") < n // 3, F.lit(1)).otherwise(F.col("id") % 997 + 2).cast("bigint").alias("user_id"),
        F.when((F.col("id") >= n // 3) & (F.col("id") < 2 * n // 3), F.lit("0000000007"))
        .otherwise(F.lpad((F.col("id") % 1009).cast("string"), 10, "0"))
        .alias("isbn"),
        (F.col("id") % 11).cast("int").alias("book_rating"),
        F.col("id").alias("load_order"),
    )
    return df


def _plans(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_results_are_whole(spark, skewed):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.quire.skew.minRows": "1000",
        "spark.quire.broadcastRows": "0",  # force the shuffle path that salts
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        ratings = skewed.drop("load_order")
        centred = P.center_ratings(ratings)
        rows = centred.filter(F.col("user_id") == 1).agg(F.count(F.lit(1)), F.avg("norm")).first()
        assert rows[0] == 10000 and abs(rows[1]) < 1e-9
        assert len(centred.collect()) == 30000  # runs this plan, so AQE's final plan is kept
        plan = _plans(centred)
        assert "isFinalPlan=true" in plan
        assert "SortMergeJoin" in plan
        # the hot user is salted: the join runs on (user_id, _salt)
        assert "_salt" in plan

        books = spark.createDataFrame([(f"{i:010d}", "t", "a", 2000) for i in range(1009)] + [("0000000007", "t", "a", 2000)],
                                      "isbn string, book_title string, book_author string, year_of_publication int")
        tagged = C.tag_rating_rules(ratings, books)
        assert tagged.count() == 30000
        kept = tagged.filter(F.col("dropped_by").isNull()).count()
        assert kept == ratings.filter("book_rating <> 0").count()

        deduped = insert_or_ignore(skewed, ["user_id", "isbn"], ["load_order"])
        assert deduped.count() == skewed.select("user_id", "isbn").distinct().count()
        pair = (F.col("user_id") == 1) & (F.col("isbn") == "0000000007")
        hot = deduped.filter(pair).collect()
        assert len(hot) == 1
        assert hot[0]["load_order"] == skewed.filter(pair).agg(F.min("load_order")).first()[0]

        # hot item in the item-mean predictor: salted on (fold, item_id), same rows
        from quire.operators import splits as S
        from quire.operators import train as T

        normed = P.prepare(ratings.withColumn("item_key", F.lit(1).cast("bigint")))
        tagged = S.hash_splits(normed, k=1)
        preds = T.item_mean_predict(tagged)
        rows = preds.collect()
        assert "_salt" in _plans(preds)
        expected = tagged.filter("split = 'test'").join(
            tagged.filter("split = 'train'").select("item_id").distinct(), "item_id"
        ).count()
        assert len(rows) == expected

        scores = ratings.select("user_id", F.hash("isbn").alias("item_id"), F.col("book_rating").cast("double").alias("score"))
        top = R.rank_topk(scores, k=10)
        assert top.filter(F.col("user_id") == 1).count() == 10
        assert "WindowGroupLimit" in _plans(top)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
