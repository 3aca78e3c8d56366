"""Model training and prediction: ALS per fold, plus an item-mean baseline.

ALS is ``pyspark.ml.recommendation.ALS`` (blocked, distributed); we only fix the
parameters and make lineage safe: a reliable checkpoint folder is ensured before
fitting, so ALS truncates its lineage every ``checkpoint_interval`` iterations and
a lost executor does not replay the whole factorisation. A checkpoint is also where
ALS deletes the shuffle files behind it: with the default of every iteration, a fit
holds one iteration's shuffles on disk, not those of all of them.

The item-mean baseline (prediction = mean centred rating of the item on the train
split) is deterministic, so evaluation and recommendation can be checked against
an SQL oracle with it.
"""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.skew import join_small
from quire.operators.splits import as_rows, fold_rows, in_train, test_folds, test_rows, tested_rows
from quire.session import ensure_checkpoint_dir, let_go
from quire.sources.artifacts import load_model, save_model

# The reference's ALS configuration.
ALS_PARAMS = {
    "rank": 10,
    "maxIter": 10,
    "regParam": 0.1,
    "coldStartStrategy": "drop",
    "nonnegative": True,
}

# Two fits fill the gaps between each other's stages; more only add to the disk held.
CONCURRENT_FITS = 2


def make_als(
    user: str = "user_id",
    item: str = "item_id",
    label: str = "norm",
    seed: int = 42,
    checkpoint_interval: int = 1,
    num_user_blocks: int | None = None,
    num_item_blocks: int | None = None,
    **overrides,
) -> ALS:
    params = dict(ALS_PARAMS)
    params.update(overrides)
    als = ALS(
        userCol=user,
        itemCol=item,
        ratingCol=label,
        seed=seed,
        checkpointInterval=checkpoint_interval,
        **params,
    )
    if num_user_blocks:
        als = als.setNumUserBlocks(num_user_blocks)
    if num_item_blocks:
        als = als.setNumItemBlocks(num_item_blocks)
    return als


def train_als(train: DataFrame, **kwargs) -> ALSModel:
    """Fit ALS. Unless given, user and item block counts follow the cluster's
    default parallelism (ALS's own default of 10 blocks would leave most of a
    large cluster idle and make each block's normal equations huge). Rows without
    user, item or rating teach nothing and are left out.

    The model is written to the checkpoint folder and read back: a fitted one keeps
    every shuffle of its ratings and of its last iteration on disk as long as it
    lives, many times the size of its factors."""
    spark = train.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quire-als-{uuid.uuid4().hex[:12]}"
    blocks = max(spark.sparkContext.defaultParallelism, 1)
    kwargs.setdefault("num_user_blocks", blocks)
    kwargs.setdefault("num_item_blocks", blocks)
    als = make_als(**kwargs)
    save_model(als.fit(train.dropna(subset=[als.getUserCol(), als.getItemCol(), als.getRatingCol()])), path)
    model = load_model(path)
    let_go(spark)
    return model


def predict(model: ALSModel, test: DataFrame) -> DataFrame:
    """Test rows plus ``prediction`` (double). Cold-start rows are dropped by the
    model's ``coldStartStrategy``."""
    return model.transform(test).withColumn("prediction", F.col("prediction").cast("double"))


def fold_frame(tagged: DataFrame, fold: int, split: str) -> DataFrame:
    """One fold's train or test rows (row layout or ``test_mask`` layout)."""
    return fold_rows(tagged, fold, split)


def train_folds(tagged: DataFrame, k: int = 5, concurrent: int | None = None, **kwargs) -> dict[int, ALSModel]:
    """One model per fold, trained on that fold's train split.

    Each fit is a distributed job of many short stages (two half-steps per
    iteration), so one fit alone leaves executors idle between stages. The folds
    are independent, so up to ``concurrent`` fits (default: CONCURRENT_FITS) are submitted
    from driver threads and Spark's scheduler interleaves their stages. Each running
    fit holds its blocks and shuffles, so their number bounds the disk, whatever k.
    """
    from concurrent.futures import ThreadPoolExecutor

    workers = max(1, min(k, concurrent or CONCURRENT_FITS))
    with ThreadPoolExecutor(max_workers=workers) as pool:
        futures = {f: pool.submit(train_als, fold_frame(tagged, f, "train"), **kwargs) for f in range(1, k + 1)}
        return {f: fut.result() for f, fut in futures.items()}


def fold_rmse(models: dict[int, ALSModel], tagged: DataFrame, label: str = "norm") -> DataFrame:
    """(fold, rmse): each model on its own test split, the reference's per-fold print."""
    scored = cross_predict(models, tagged, own_fold_only=True)
    diff = F.col(label) - F.col("prediction")
    return scored.groupBy("fold").agg(F.sqrt(F.avg(diff * diff)).alias("rmse"))


def stacked_factors(models: dict[int, ALSModel], side: str) -> DataFrame:
    """(id, _<side>_<m>...): one row per user (or item) with the factors that each model
    has for it, null where a model does not know it."""
    parts = None
    for m, model in sorted(models.items()):
        own = model.userFactors if side == "user" else model.itemFactors
        part = own.select("id", F.struct(F.lit(m).alias("key"), F.col("features").alias("value")).alias("_f"))
        parts = part if parts is None else parts.unionByName(part)
    # At most one row a model and id.
    stack = parts.groupBy("id").agg(F.map_from_entries(F.collect_list("_f")).alias("_f"))
    return stack.select("id", *[F.try_element_at("_f", F.lit(m)).alias(f"_{side}_{m}") for m in sorted(models)])


def dot(a: str, b: str, rank: int) -> Column:
    """Inner product as one arithmetic expression, null where either side is."""
    total = F.lit(0.0)
    for i in range(rank):
        total = total + F.get(a, F.lit(i)).cast("double") * F.get(b, F.lit(i)).cast("double")
    return total


def _factor_size(models: dict[int, ALSModel], side: str) -> tuple[int, int]:
    """(rows of the largest model, bytes of all models' numbers) of one side."""
    counts = {m: (x.userFactors if side == "user" else x.itemFactors).count() for m, x in models.items()}
    return max(counts.values()), sum(8 * models[m].rank * n for m, n in counts.items())


def _own_fold_predict(models: dict[int, ALSModel], tagged: DataFrame) -> DataFrame:
    """Each model on its own fold's test split: a test row meets the one row of factors of
    its fold and user, then of its fold and item."""
    first = next(iter(models.values()))
    tests = test_rows(tagged, max(models))
    columns, kind = tests.columns, tests.schema["fold"].dataType
    for key, side in ((first.getUserCol(), "user"), (first.getItemCol(), "item")):
        stack = None
        for m, model in sorted(models.items()):
            own = model.userFactors if side == "user" else model.itemFactors
            part = own.select(
                F.lit(m).cast(kind).alias("fold"),
                F.col("id").cast(tests.schema[key].dataType).alias(key),
                F.col("features").alias(f"_{side}"),
            )
            stack = part if stack is None else stack.unionByName(part)
        counts = partial(_key_counts, test_rows(tagged, max(models)), "fold", key)
        least = _factor_size(models, side)
        tests = join_small(tests, stack, ["fold", key], "inner", counts=counts, keep=False, least=least)
    value = F.lit(None).cast("double")
    for rank in sorted({x.rank for x in models.values()}):
        folds = [m for m, x in models.items() if x.rank == rank]
        value = F.when(F.col("fold").isin(folds), dot("_user", "_item", rank)).otherwise(value)
    out = _scored(tests, F.transform(F.array("fold"), lambda f: f), [value])
    out = out.select(*columns, F.col("_value_0").alias("prediction"), F.col("fold").cast("int").alias("model"))
    return out.na.drop(subset=["prediction"])


def _scored(tests: DataFrame, folds: Column, values: list[Column]) -> DataFrame:
    """The columns of ``tests`` but its factors and mask, one row for each of ``folds``, with ``values``.

    ``folds`` is to come from an array function: that keeps the products out of whole-stage
    code, where joins and products make one method, too long for the JVM to compile."""
    kept = [c for c in tests.columns if not c.startswith(("_user", "_item")) and c not in ("test_mask", "fold", "split")]
    split = F.col("split") if "split" in tests.columns else F.lit("test")
    names = [f"_value_{i}" for i in range(len(values))]
    out = tests.select(*kept, split.alias("split"), folds.alias("_folds"), *[v.alias(n) for v, n in zip(values, names)])
    return out.select(*kept, F.explode("_folds").alias("fold"), "split", *names)


def cross_predict(
    models: dict[int, ALSModel], tagged: DataFrame, own_fold_only: bool = False, wide: bool = False
) -> DataFrame:
    """Every model on every fold's test split, as one frame tagged ``model``,
    ``fold``, with ``prediction``; rows whose user or item a model does not know
    (cold start) have no row for that model.

    The factors of all models are stacked, one row per user and one per item, so
    the test rows meet each side once, whatever the number of models (two joins,
    ``join_small``: broadcast when small, else salted for hot users and items), and
    all predictions of a row come from one projection. With a ``test_mask`` a row is
    joined once, whatever the number of folds that test it.

    The default scores each model on all test sets, as the reference does (so a
    model also meets rows it trained on); ``own_fold_only`` keeps each model to
    its own fold's test split. ``wide`` keeps a test row one row, with the predictions in
    columns ``prediction_<model>``, null where a model does not know its user or item."""
    ensure_checkpoint_dir(tagged.sparkSession)
    if own_fold_only:
        return _own_fold_predict(models, tagged)
    first, k = next(iter(models.values())), max(models)
    tests = tested_rows(tagged, k)
    for key, side in ((first.getUserCol(), "user"), (first.getItemCol(), "item")):
        stack = stacked_factors(models, side).withColumnRenamed("id", key)
        stack = stack.withColumn(key, F.col(key).cast(tests.schema[key].dataType))
        # Columns of ``tests`` alone: the hot keys are those of the test rows.
        counts = partial(_key_counts, tested_rows(tagged, k), key)
        tests = join_small(tests, stack, key, "inner", counts=counts, keep=False, least=_factor_size(models, side))
    folds = test_folds(k) if "test_mask" in tests.columns else F.transform(F.array("fold"), lambda f: f)
    numbers = sorted(models)
    scored = _scored(tests, folds, [dot(f"_user_{m}", f"_item_{m}", models[m].rank) for m in numbers])
    columns = test_rows(tagged, k).columns
    if wide:
        return scored.select(*columns, *[F.col(f"_value_{i}").alias(f"prediction_{m}") for i, m in enumerate(numbers)])
    pairs = [F.struct(F.col(f"_value_{i}").alias("prediction"), F.lit(m).alias("model")) for i, m in enumerate(numbers)]
    out = scored.select(*columns, F.explode(F.array(*pairs)).alias("_s"))
    return out.select(*columns, "_s.prediction", "_s.model").na.drop(subset=["prediction"])


def _key_counts(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).checkpoint(eager=True)


def item_mean_models(tagged: DataFrame, item: str = "item_id", label: str = "norm", k: int = 5) -> DataFrame:
    """(model, item_id, prediction): for each fold, the train mean of ``label`` per item."""
    return (
        as_rows(tagged, k)
        .filter(F.col("split") == "train")
        .groupBy(F.col("fold").alias("model"), item)
        .agg(F.avg(label).alias("prediction"))
    )


def item_mean_predict(tagged: DataFrame, item: str = "item_id", label: str = "norm", k: int = 5) -> DataFrame:
    """Each fold's test rows scored by the same fold's item-mean model; items
    without train ratings are dropped (cold start).

    One aggregate per (fold, item) gives both the model (train mean) and the
    number of test rows, which names the hot items to salt on the join back."""
    tagged = as_rows(tagged, k)
    is_train = F.col("split") == "train"
    per_key = (
        tagged.groupBy("fold", item)
        .agg(
            F.avg(F.when(is_train, F.col(label))).alias("prediction"),
            F.count(F.when(is_train, F.lit(1))).alias("_n_train"),
            F.count(F.when(~is_train, F.lit(1))).alias("_n"),
        )
        .filter(F.col("_n_train") > 0)
        .drop("_n_train")
    )
    tests = tagged.filter(~is_train)
    per_key = per_key.checkpoint(eager=True)
    return join_small(tests, per_key.drop("_n"), ["fold", item], "inner", counts=per_key)


def item_mean_cross_predict(
    tagged: DataFrame, item: str = "item_id", label: str = "norm", k: int = 5, wide: bool = False
) -> DataFrame:
    """Every item-mean model on every test split, tagged ``model`` and ``fold``.
    Joined on the item only: each test row meets one model row per fold model.

    ``wide`` keeps a test row one row, with the predictions of all models in columns
    ``prediction_1`` to ``prediction_k`` (null where a model does not know the item):
    what is joined, shuffled and grouped afterwards does not grow with the models.
    The models come from one aggregate, one row per item."""
    if not wide:
        models = item_mean_models(tagged, item, label, k)
        tests = test_rows(tagged, k)
        return tests.join(models, item, "inner")
    ensure_checkpoint_dir(tagged.sparkSession)
    means = [F.avg(F.when(in_train(tagged, m), F.col(label))).alias(f"prediction_{m}") for m in range(1, k + 1)]
    per_item = tagged.groupBy(item).agg(*means, F.count(F.lit(1)).alias("_n")).checkpoint(eager=True)
    return join_small(test_rows(tagged, k), per_item.drop("_n"), item, "inner", counts=per_item, keep=False)
