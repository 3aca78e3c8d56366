"""Hot keys: joining per-key aggregates back to the rows they came from.

Joining a table of one row per key (a per-user mean, a set of zero-sum users)
back to the rows it was aggregated from is the common shape in this engine. AQE's
skew-join split does not apply to it: the aggregate's output is already
partitioned by the key, so the join has no shuffle on that side to split, and a
key holding a third of all rows would be joined inside one task.

``join_small`` is the entry point: the aggregate side is measured and broadcast
when within a bound of rows and bytes (no shuffle of the big side at all), and otherwise
joined through ``join_back``, which salts hot keys explicitly. Keys with more
than ``total / (share * cores)`` rows are hot, where cores is the cluster's
default parallelism (so there are at most ``share * cores`` of them, a proven
bound for the broadcast that carries them: about 32k small rows on an
8,000-core cluster). Each hot key's rows get a salt in ``[0, n)`` from a hash of
the row, and its single row on the aggregate side is replicated n times. The
join then runs on (key, salt) and spreads the hot key over n tasks. Cold keys
keep salt 0, and when nothing is hot the plain join is used.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIN_ROWS_CONF = "spark.quire.skew.minRows"
SHARE_CONF = "spark.quire.skew.share"
DEFAULT_MIN_ROWS = 1_000_000
DEFAULT_SHARE = 4


def hot_keys(counts: DataFrame, key: str | Sequence[str], n_col: str) -> list[tuple]:
    """(key, salts) for every key whose count exceeds the hot threshold.

    ``counts`` has one row per key. One small job gives the total and the largest
    count; only when some key is hot does a second job fetch the (bounded) hot
    rows. A key is hot above ``max(total / (share * cores), minRows)`` rows, and it
    gets ``ceil(count / threshold)`` salts, at most the shuffle partition count.
    """
    spark = counts.sparkSession
    cores = max(spark.sparkContext.defaultParallelism, 1)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = int(spark.conf.get(SHARE_CONF, str(DEFAULT_SHARE)))
    min_rows = int(spark.conf.get(MIN_ROWS_CONF, str(DEFAULT_MIN_ROWS)))
    total, largest = counts.agg(F.sum(n_col), F.max(n_col)).first()
    total, largest = total or 0, largest or 0
    threshold = max(total / float(share * cores), float(min_rows), 1.0)
    if largest <= threshold:
        return []
    keys = [key] if isinstance(key, str) else list(key)
    rows = counts.filter(F.col(n_col) > F.lit(threshold)).select(*keys, n_col).collect()
    return [(*r[:-1], int(min(parts, math.ceil(r[-1] / threshold)))) for r in rows]


def join_back(
    big: DataFrame,
    small: DataFrame,
    key: str | Sequence[str],
    how: str = "inner",
    hot: Sequence[tuple] | None = None,
) -> DataFrame:
    """``big.join(small, key, how)`` where ``small`` has one row per key (one
    column or several), with the hot keys of ``big`` spread over several tasks.
    Output columns as the plain join."""
    keys = [key] if isinstance(key, str) else list(key)
    if not hot:
        return big.join(small, keys, how)
    spark = big.sparkSession
    ddl = ", ".join(f"`{k}` {big.schema[k].dataType.simpleString()}" for k in keys)
    table = F.broadcast(spark.createDataFrame(list(hot), f"{ddl}, _salts int"))
    row_hash = F.xxhash64(*[F.col(c) for c in big.columns])
    salted_big = big.join(table, keys, "left").withColumn(
        "_salt",
        F.when(F.col("_salts").isNull(), F.lit(0)).otherwise(F.pmod(row_hash, F.col("_salts")).cast("int")),
    ).drop("_salts")
    replicas = F.when(F.col("_salts").isNull(), F.array(F.lit(0))).otherwise(
        F.sequence(F.lit(0), F.col("_salts") - 1)
    )
    salted_small = small.join(table, keys, "left").withColumn("_salt", F.explode(replicas)).drop("_salts")
    return salted_big.join(salted_small, keys + ["_salt"], how).drop("_salt")


BROADCAST_ROWS_CONF = "spark.quire.broadcastRows"
DEFAULT_BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES_CONF = "spark.quire.broadcastBytes"
DEFAULT_BROADCAST_BYTES = 128 << 20


def _width(value: Column, kind: T.DataType) -> Column:
    """Bytes that a value takes, about: texts and arrays by their length."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(kind, T.StructType):
        return sum((_width(value[f.name], f.dataType) for f in kind.fields), F.lit(0))
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.NumericType, T.BooleanType, T.DatetimeType)):
            return F.lit(8) * F.greatest(F.coalesce(F.size(value), F.lit(0)), F.lit(0))
        return F.coalesce(F.aggregate(value, F.lit(0), lambda n, x: n + _width(x, kind.elementType)), F.lit(0))
    if isinstance(kind, T.MapType):
        return F.coalesce(F.octet_length(F.to_json(value)), F.lit(0))
    return F.lit(8)


def measured(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df``, from one pass over it."""
    width = sum((_width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(16))
    rows, size = df.agg(F.count(F.lit(1)), F.sum(width.cast("bigint"))).first()
    return rows, size or 0


def join_small(
    big: DataFrame,
    small: DataFrame,
    key: str | Sequence[str],
    how: str = "inner",
    counts=None,
    n_col: str = "_n",
    keep: bool = True,
    least: tuple[int, int] = (0, 0),
) -> DataFrame:
    """Join ``big`` with a one-row-per-key ``small`` side: broadcast behind a size
    check, salted shuffle join beyond it.

    ``small`` is checkpointed (it is read twice: measured, then joined), or with
    ``keep=False``, for one that is cheap to make again, computed twice. Up to
    ``spark.quire.broadcastRows`` rows and ``spark.quire.broadcastBytes`` bytes it is
    broadcast, a proven bound, and ``big`` is not shuffled at all. Beyond that the join
    shuffles through
    ``join_back``, with the hot keys taken from ``counts`` (a per-key count table,
    or a function building one, called only in that case). ``least``: rows and bytes that
    ``small`` is known to have at least; beyond a bound it is not measured.
    """
    spark = big.sparkSession
    limit = int(spark.conf.get(BROADCAST_ROWS_CONF, str(DEFAULT_BROADCAST_ROWS)))
    most = int(spark.conf.get(BROADCAST_BYTES_CONF, str(DEFAULT_BROADCAST_BYTES)))
    if keep:
        small = small.checkpoint(eager=True)
    rows, size = least
    if rows <= limit and size <= most:
        rows, size = measured(small)
    if rows <= limit and size <= most:
        keys = [key] if isinstance(key, str) else list(key)
        return big.join(F.broadcast(small), keys, how)
    if callable(counts):
        counts = counts()
    hot = hot_keys(counts, key, n_col) if counts is not None else []
    return join_back(big, small, key, how, hot)
