"""CSV export and import with an explicit schema.

The export format follows R's ``write.csv``: header, doubled embedded quotes and
``NA`` for missing values. With ``escape='"'`` and ``nullValue='NA'`` on both the
writer and the reader, quotes, commas, backslashes, empty strings, NULLs and
leading zeros round-trip exactly; only a literal text value ``NA`` comes back NULL.

Line breaks inside a quoted text round-trip too. A file with such texts cannot be split,
so the writer starts a new part file every ``FILE_ROWS`` rows and each file is one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quire import schemas

CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "NA",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
#: Rows of a part file.
FILE_ROWS = 1_000_000


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Distributed write: one part file per task, no coalesce to a single file."""
    df.write.mode(mode).options(**CSV_OPTIONS).option("emptyValue", '""').option(
        "maxRecordsPerFile", str(FILE_ROWS)
    ).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, line_breaks: bool = False) -> DataFrame:
    """``line_breaks``: texts may hold line breaks (a file is then read by one task)."""
    reader = spark.read.schema(schema).options(**CSV_OPTIONS).option("mode", "FAILFAST")
    return reader.option("multiLine", str(line_breaks).lower()).csv(path)


def write_ratings_csv(df: DataFrame, path: str) -> None:
    write_csv(df.select(*schemas.RATINGS.fieldNames()), path)


def read_ratings_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.RATINGS)


def read_books_csv(spark: SparkSession, path: str) -> DataFrame:
    """Titles, authors and publishers may hold line breaks."""
    return read_csv(spark, path, schemas.BOOKS, line_breaks=True)


def read_users_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.USERS)
