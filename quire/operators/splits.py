"""Train/test splits as one frame tagged ``fold`` and ``split``.

``random_splits`` reproduces the reference: k independent 80/20 random splits with
seeds seed..seed+k-1 (test sets overlap across folds). ``hash_splits`` is a
deterministic alternative whose membership depends only on key values, so it is
reproducible across partitionings and engines.

Each row is replicated k times by a generator (no join), and the result is meant
to be written once with ``save_splits`` (partitioned by fold and split) rather
than kept as k cached pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _draw(seed: int, keys: Sequence[str]) -> F.Column:
    """A number in [0, 1): ``rand(seed)``, or a hash of the keys and the seed."""
    if not keys:
        return F.rand(seed)
    # The upper 53 bits of the hash, as many as a double holds.
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11).cast("double") / F.lit(float(1 << 53))


def random_splits(
    df: DataFrame, k: int = 5, seed: int = 42, train_fraction: float = 0.8, keys: Sequence[str] = ()
) -> DataFrame:
    """k independent random splits; fold f (1..k) draws with seed + f - 1.

    Without ``keys`` the draw is ``rand``: like ``randomSplit`` it depends on the input
    partitioning; write the result before reusing it. With ``keys`` (columns that tell
    rows apart) it is a hash of them: the same rows are drawn however they are
    partitioned, and again when a lost task is repeated. Rows of equal keys share a draw.
    """
    draws = F.array(
        *[
            F.struct(F.lit(f).alias("fold"), _draw(seed + f - 1, keys).alias("_u"))
            for f in range(1, k + 1)
        ]
    )
    return (
        df.withColumn("_draw", F.explode(draws))
        .withColumn("fold", F.col("_draw.fold"))
        .withColumn(
            "split", F.when(F.col("_draw._u") < train_fraction, "train").otherwise("test")
        )
        .drop("_draw")
    )


def hash_splits(
    df: DataFrame,
    k: int = 5,
    seed: int = 42,
    keys: Sequence[str] = ("user_id", "item_id"),
    train_fraction: float = 0.8,
    mask: bool = False,
) -> DataFrame:
    """Fold f (1..k): rows train whose md5 of "key1:key2:(seed + f - 1)", as a number in
    [0, 1), is under ``train_fraction``; the rest test. A null key is left out of the text.
    With ``mask`` the folds are the bits of one ``test_mask`` column, as in
    ``random_split_mask``, and no row is copied."""
    # Hex digits of one length compare like the numbers they write.
    bound = f"{min(max(int(train_fraction * 2**32), 0), 2**32):08x}"

    def is_train(number: F.Column) -> F.Column:
        draw = F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in keys], number.cast("string")))
        return F.lit(True) if len(bound) > 8 else F.substring(draw, 1, 8) < bound

    if mask:
        return df.withColumn("test_mask", _mask([~is_train(F.lit(seed + f - 1)) for f in range(1, k + 1)]))
    train = is_train(F.lit(seed - 1) + F.col("fold"))
    return df.withColumn("fold", F.explode(F.array(*[F.lit(f) for f in range(1, k + 1)]))).withColumn(
        "split", F.when(train, "train").otherwise("test")
    )


#: Bits of a mask that are not its sign.
MAX_FOLDS = 63


def random_split_mask(
    df: DataFrame, k: int = 5, seed: int = 42, train_fraction: float = 0.8, keys: Sequence[str] = ()
) -> DataFrame:
    """The same k independent draws as ``random_splits``, stored as one bigint column
    ``test_mask`` (bit f-1 set: the row is in fold f's test split) instead of k
    copies of every row. Written once, the splits take the input's size rather
    than k times it; a fold is a filter on one bit (see ``fold_rows``)."""
    return df.withColumn("test_mask", _mask([_draw(seed + f - 1, keys) >= train_fraction for f in range(1, k + 1)]))


def _mask(tests: Sequence[F.Column]) -> F.Column:
    """Bit f-1 set where the f-th condition holds."""
    if not 1 <= len(tests) <= MAX_FOLDS:
        raise ValueError(f"k must be from 1 to {MAX_FOLDS}, not {len(tests)}")
    bits = [F.when(t, _bit(f)).otherwise(F.lit(0).cast("bigint")) for f, t in enumerate(tests, 1)]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask.bitwiseOR(b)
    return mask


def _bit(fold: int | F.Column) -> F.Column:
    shift = F.lit(fold - 1) if isinstance(fold, int) else (fold - 1).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), shift)


def _in_test(fold: int | F.Column) -> F.Column:
    """Bit fold-1 of ``test_mask`` is set."""
    return F.col("test_mask").bitwiseAND(_bit(fold)) != 0


def fold_rows(tagged: DataFrame, fold: int, split: str) -> DataFrame:
    """One fold's train or test rows, for either layout: (fold, split) columns or
    a ``test_mask`` column. The result carries ``fold`` and ``split``."""
    if "test_mask" in tagged.columns:
        in_test = _in_test(fold)
        rows = tagged.filter(in_test if split == "test" else ~in_test)
        return rows.drop("test_mask").withColumn("fold", F.lit(fold)).withColumn("split", F.lit(split))
    return tagged.filter((F.col("fold") == fold) & (F.col("split") == split))


def test_rows(tagged: DataFrame, k: int) -> DataFrame:
    """Every (fold, test row) pair, for either layout; with a mask each row yields
    one row per fold whose test split holds it (no copies stored)."""
    if "test_mask" in tagged.columns:
        return (
            tagged.withColumn("fold", F.explode(test_folds(k)))
            .drop("test_mask")
            .withColumn("split", F.lit("test"))
        )
    return tagged.filter(F.col("split") == "test")


def test_folds(k: int) -> F.Column:
    """The folds of a row with a mask whose test split holds it."""
    return F.filter(F.array(*[F.lit(f) for f in range(1, k + 1)]), _in_test)


def tested_rows(tagged: DataFrame, k: int) -> DataFrame:
    """The rows that ``test_rows`` gives, for either layout, but with a mask each of them
    once, not once per fold."""
    if "test_mask" in tagged.columns:
        return tagged.filter(F.col("test_mask").bitwiseAND(F.lit((1 << k) - 1)) != 0)
    return test_rows(tagged, k)


def in_train(tagged: DataFrame, fold: int) -> F.Column:
    """Whether a row of either layout trains fold ``fold``."""
    if "test_mask" in tagged.columns:
        return ~_in_test(fold)
    return (F.col("fold") == fold) & (F.col("split") == "train")


def as_rows(tagged: DataFrame, k: int) -> DataFrame:
    """The (fold, split) row layout of either layout; a mask is expanded lazily,
    k rows per input row, only for consumers that need every fold at once."""
    if "test_mask" not in tagged.columns:
        return tagged
    return (
        tagged.withColumn("fold", F.explode(F.array(*[F.lit(f) for f in range(1, k + 1)])))
        .withColumn("split", F.when(_in_test(F.col("fold")), F.lit("test")).otherwise(F.lit("train")))
        .drop("test_mask")
    )


def split_sizes(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy("fold", "split").agg(F.count(F.lit(1)).alias("n_rows"))
