"""What bounds the disk, the shuffles and the repeated work of the operators."""

import os
import threading
import time

from pyspark.sql import functions as F

from quire import schemas
from quire.operators import dedup
from quire.operators import dump as D
from quire.operators import evaluate as E
from quire.operators import splits as S
from quire.operators import train as T
from quire.session import let_go


def test_als_holds_one_iteration_and_two_fits(spark, monkeypatch):
    # A checkpoint is where ALS deletes the shuffle files behind it.
    assert T.make_als().getCheckpointInterval() == 1
    running, most, lock = [0], [0], threading.Lock()

    def fit(rows, **kwargs):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        time.sleep(0.2)
        with lock:
            running[0] -= 1
        return rows.first()["fold"]

    monkeypatch.setattr(T, "train_als", fit)
    tagged = spark.range(5).selectExpr("cast(id + 1 as int) as fold", "'train' as split")
    assert T.train_folds(tagged, k=5) == {f: f for f in range(1, 6)}
    assert most[0] == 2


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_line_is_rewritten_once(spark):
    text = "INSERT IGNORE INTO `BX-Book-Ratings` VALUES (1,'a',5),(2,'b''c',NULL);"
    lines = spark.createDataFrame([(1, text), (2, "INSERT INTO `BX-Users` VALUES (1,2);"), (3, None)], "load_order int, value string")
    built = lines.select("load_order", F.concat("value", F.lit("")).alias("value"))
    rows = D.parse_dump_rows(D.normalize_dump(built), "BX_Book_Ratings", schemas.RATINGS)
    assert _plan(rows).count("ENGINE=") == 1
    assert [tuple(r)[:3] for r in rows.collect()] == [(1, "a", 5), (2, "b'c", None)]


def test_large_dedup_is_spread_by_rows(spark, monkeypatch):
    monkeypatch.setattr(dedup, "ROWS_PER_TASK", 10)
    rows = spark.createDataFrame(
        [(i % 90 if i % 7 else None, i, -i) for i in range(400)] + [(None, None, 1)], "k int, o int, v int"
    )
    plain = dedup.insert_or_ignore(rows, ["k"], ["o"])
    spread = dedup.insert_or_ignore(rows, ["k"], ["o"], rows=401)
    assert "RepartitionByExpression" in _plan(spread) and "RepartitionByExpression" not in _plan(plain)
    assert sorted(plain.collect(), key=str) == sorted(spread.collect(), key=str)


def test_wide_cross_evaluation_equals_pairs(spark):
    rows = [(u, i, float((u * 7 + i * 3) % 11) if (u + i) % 13 else None) for u in range(40) for i in range(25) if (u * i) % 3]
    rows += [(None, 1, 2.0), (3, None, 1.0), (5, 99, 4.0), (5, 99, 4.0)]
    rated = spark.createDataFrame(rows, "user_id int, item_id int, norm double")
    long_, mask = S.hash_splits(rated, k=5), S.hash_splits(rated, k=5, mask=True)
    key = lambda r: str(tuple(r))
    cols = ["user_id", "item_id", "norm", "fold", "split"]
    assert sorted(S.as_rows(mask, 5).select(cols).collect(), key=key) == sorted(long_.select(cols).collect(), key=key)
    want = {r["model"]: r for r in E.cross_evaluate(T.item_mean_cross_predict(long_)).collect()}
    for tagged in (long_, mask):
        wide = T.item_mean_cross_predict(tagged, wide=True)
        assert wide.count() <= sum(1 for r in long_.collect() if r["split"] == "test")
        got = {r["model"]: r for r in E.cross_evaluate(wide).collect()}
        assert got.keys() == want.keys() and len(got) == 5
        for m, r in got.items():
            assert abs(r["ub_rmse_avg"] - want[m]["ub_rmse_avg"]) < 1e-9
            assert abs(r["ib_rmse_avg"] - want[m]["ib_rmse_avg"]) < 1e-9


def _shuffle_files(folder):
    return {f for _, _, files in os.walk(folder) for f in files if f.startswith("shuffle_") and f.endswith(".data")}


def test_a_fit_leaves_no_shuffles(spark):
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    folders = [d for d in local if os.path.isdir(d)]
    files = lambda: set().union(*map(_shuffle_files, folders))
    rows = [(u, i, float((u * i) % 5)) for u in range(30) for i in range(20) if (u + i) % 3]
    rated = spark.createDataFrame(rows, "user_id int, item_id int, norm double").checkpoint(eager=True)
    old = files()
    model = T.train_als(rated, maxIter=2)
    until = time.time() + 60
    while files() - old and time.time() < until:
        let_go(spark)  # cleaning is asynchronous; as long as the model held them, no pass would free them
        time.sleep(0.5)
    assert not files() - old
    assert model.userFactors.count() == 30 and model.itemFactors.count() == 20
    assert model.getUserCol() == "user_id" and model.transform(rated).filter("prediction IS NOT NULL").count() == len(rows)
