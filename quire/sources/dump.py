"""SQL dump files as lines of text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.statements import statements


def read_dump_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value`` plus ``load_order``, the position of the line in the input:
    (file name, start offset of the file split, row id).

    Spark packs file splits into partitions by size, not by position, so a row id
    alone does not follow file order across splits or files. The split's file and
    start offset order the splits; ``monotonically_increasing_id``, taken right at
    the scan, orders lines inside one split. No driver round trip is needed.
    """
    return _lines(spark.read.text(path))


def _lines(text: DataFrame) -> DataFrame:
    return text.withColumn(
        "load_order",
        F.struct(
            F.input_file_name().alias("file"),
            F.input_file_block_start().alias("offset"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def read_dump_statements(spark: SparkSession, path: str) -> DataFrame:
    """``value`` (a whole statement, however many lines and file splits it reaches over,
    with its ``;``) plus ``load_order``; see ``operators.statements``. Lines end at ``\n``
    only, so that a carriage return inside a text stays."""
    return statements(_lines(spark.read.option("lineSep", "\n").text(path)))


def write_lines(df: DataFrame, path: str, column: str = "value", mode: str = "overwrite") -> None:
    df.select(F.col(column).alias("value")).write.mode(mode).text(path)
