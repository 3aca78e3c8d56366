"""Insert-or-ignore: the first row in load order wins for each primary key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Rows a task sorts in memory.
ROWS_PER_TASK = 2_000_000


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df``, about ``rows`` rows, partitioned by ``keys`` into tasks of ROWS_PER_TASK rows
    where the session's shuffle partitions would be larger: what a task sorts then stays
    in memory, whatever the input. Otherwise ``df`` itself."""
    n = -(-rows // ROWS_PER_TASK)
    if n <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df
    return df.repartition(n, *keys)


def insert_or_ignore(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int = 0) -> DataFrame:
    """Keep, per key, the row that sorts first by ``order`` (then by every other
    column, so the choice is deterministic).

    Written as ``min(struct(order..., payload...))`` per key rather than a
    ``row_number`` window: ``min`` aggregates partially before the shuffle, so a key
    holding a third of all rows is reduced to one row per input partition instead
    of being sorted whole inside one task.

    ``rows``, the number of rows if known, keeps the sorts of a large table in memory: it
    is partitioned by key first (``spread``), and sorted once instead of on both sides of
    a shuffle. The rows of one key then meet in one task, sorted on disk if need be.
    """
    keys = list(keys)
    df = spread(df, rows, *keys)
    payload = [c for c in df.columns if c not in keys]
    ordered = list(order) + [c for c in payload if c not in order]
    first = F.min(F.struct(*[F.col(c) for c in ordered])).alias("_first")
    return df.groupBy(*keys).agg(first).select(
        *keys, *[F.col(f"_first.{c}").alias(c) for c in payload]
    )
