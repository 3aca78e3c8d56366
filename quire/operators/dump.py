"""MySQL dump lines -> portable SQL lines -> typed rows.

The rewrite is a chain of built-in ``regexp_replace`` / ``replace`` calls on each
line (a narrow, codegen'd projection: no shuffle). Parsing extracts the value
tuples of each INSERT line with ``regexp_extract_all``, explodes them and takes each
tuple apart into its fields in the same way.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.predicates import is_insert

# The line rewrite, in the order it is applied.
# (pattern, replacement, kind) with kind "regex-i" (case-insensitive regex),
# "regex" (case-sensitive regex) or "text" (literal replacement).
DUMP_RULES = (
    (r"ENGINE=\w+\s*", "", "regex-i"),
    (r"DEFAULT CHARSET=\w+\s*", "", "regex-i"),
    ("`BX-Users`", "BX_Users", "regex"),
    ("`BX-Books`", "BX_Books", "regex"),
    ("`BX-Book-Ratings`", "BX_Book_Ratings", "regex"),
    ("User-ID", "User_ID", "text"),
    ("Book-Rating", "Book_Rating", "text"),
    ("Year-Of-Publication", "Year_Of_Publication", "text"),
    ("Book-Title", "Book_Title", "text"),
    ("Book-Author", "Book_Author", "text"),
    ("Image-URL-S", "Image_URL_S", "text"),
    ("Image-URL-M", "Image_URL_M", "text"),
    ("Image-URL-L", "Image_URL_L", "text"),
    ("INSERT IGNORE INTO", "INSERT OR IGNORE INTO", "regex-i"),
    ("\\'", "''", "text"),
)

# A quoted text, with '' and backslash escapes; possessive, so that a long text neither
# backtracks nor deepens the matcher's stack.
TEXT = r"'[^'\\]*+(?:(?:''|\\.)[^'\\]*+)*+'"
# One parenthesised tuple, and one field of a tuple.
TUPLE_PATTERN = rf"(?s)\(((?:[^()'\\]++|{TEXT})*+)\)"
FIELD_PATTERN = rf"(?s)({TEXT}|[^,'\s][^,']*+)"


def normalize_line(value: Column, rules=DUMP_RULES) -> Column:
    for pattern, replacement, kind in rules:
        if kind == "text" or kind == "regex" and re.fullmatch(r"[\w`-]+", pattern):  # a pattern of plain characters
            value = F.replace(value, F.lit(pattern), F.lit(replacement))
        else:
            flags = "(?i)" if kind == "regex-i" else ""
            value = F.regexp_replace(value, flags + pattern, replacement)
    return value


def normalize_dump(lines: DataFrame, column: str = "value") -> DataFrame:
    """Every line rewritten; other columns (e.g. load order) are kept."""
    return lines.withColumn(column, normalize_line(F.col(column)))


def insert_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    return lines.filter(is_insert(column))


def count_inserts(lines: DataFrame, by: list[str] | None = None, column: str = "value") -> DataFrame:
    """(by..., n_insert_lines): lines whose upper-cased text contains INSERT."""
    flag = F.when(is_insert(column), 1).otherwise(0)
    return lines.groupBy(*(by or [])).agg(F.sum(flag).cast("bigint").alias("n_insert_lines"))


def normalize_columns(df: DataFrame) -> DataFrame:
    """Dashed column names become underscored ones."""
    return df.toDF(*[c.replace("-", "_") for c in df.columns])


def _unquoted(token: Column) -> Column:
    """The text that a quoted field stands for."""
    text = F.replace(F.substring(token, F.lit(2), F.length(token) - 2), F.lit("''"), F.lit("'"))
    plain = text
    for letter, control in (("n", "\n"), ("r", "\r"), ("t", "\t")):
        plain = F.regexp_replace(plain, rf"(?<!\\)((?:\\\\)*)\\{letter}", "$1" + control)
    return F.when(text.contains("\\"), F.regexp_replace(plain, r"(?s)\\(.)", "$1")).otherwise(text)


def _field(token: Column, kind: T.DataType) -> Column:
    """A field's value: bare NULL is null, quoted 'NULL' a text; what is no value of its
    type ends the job."""
    value = F.when(token.startswith("'"), _unquoted(token)).when(F.upper(F.trim(token)) != "NULL", F.trim(token))
    if isinstance(kind, T.StringType):
        return value
    cast = value.try_cast(kind)
    bad = F.raise_error(F.concat(F.lit(f"no {kind.simpleString()} in the dump: "), token)).cast(kind)
    return F.coalesce(cast, F.when(value.isNotNull(), bad))


def parse_dump_rows(
    lines: DataFrame,
    table: str,
    schema: T.StructType,
    column: str = "value",
    order: str = "load_order",
) -> DataFrame:
    """Typed rows of every ``INSERT ... INTO <table> [(columns)] VALUES (...),(...);``
    statement, plus ``load_order`` = (line order, tuple position) for insert-or-ignore.
    Fields stand in the schema's order, whatever columns the statement names.

    A row of ``lines`` holds whole statements' text: one that does not end with ``;`` (read
    a dump whose statements are broken over lines with ``;\n`` as line separator and put the
    ``;`` back), one without VALUES, a tuple with another number of fields and a malformed
    number end the job rather than lose rows. Run after ``normalize_dump`` or on raw lines;
    raw lines are needed where a text ends in a backslash, as the rewrite takes its last
    quote for an escaped one.
    """
    name = rf"`?\Q{table}\E`?"
    start = rf"(?is)^\s*INSERT\s+(?:\w+\s+)*INTO\s+{name}(?=[\s(])"
    body = rf"(?is)^\s*INSERT\s+(?:\w+\s+)*INTO\s+{name}(?=[\s(])\s*(?:\([^()]*\)\s*)?VALUES\s*(\(.*;)\s*$"
    # The plain test first: cheaper than the pattern on lines of other tables. No filter here:
    # the optimizer would move it, with every rule that made the line, below the rewrite and
    # evaluate them once more a condition.
    named = F.upper(F.col(column)).contains(table.upper())
    statements = lines.select(
        F.col(order).alias("_line"),
        F.col(column).alias("_value"),
        F.when(named, F.regexp_extract(F.col(column), body, 1)).alias("_body"),
    )
    broken = F.raise_error(F.concat(F.lit("statement is not whole: "), F.left(F.col("_value"), F.lit(200))))
    tuples = F.when(F.col("_body") != "", F.regexp_extract_all(F.col("_body"), F.lit(TUPLE_PATTERN), 1)).when(
        (F.col("_body") == "") & F.col("_value").rlike(start), broken.cast("array<string>")
    )
    rows = statements.select("_line", F.posexplode_outer(tuples).alias("_pos", "_tuple")).filter(
        F.col("_tuple").isNotNull()
    )
    found = F.regexp_extract_all(F.col("_tuple"), F.lit(FIELD_PATTERN), 1)
    n = len(schema.fields)
    wrong = F.raise_error(F.concat(F.lit(f"not {n} fields: "), F.col("_tuple"))).cast("array<string>")
    fields = rows.select("_line", "_pos", F.when(F.size(found) == n, found).otherwise(wrong).alias("_f"))
    return fields.select(
        *[_field(F.col("_f")[i], f.dataType).alias(f.name) for i, f in enumerate(schema.fields)],
        F.struct(F.col("_line"), F.col("_pos")).alias(order),
    )
