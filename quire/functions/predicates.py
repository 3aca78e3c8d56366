"""Row predicates and range rules used by cleaning and profiling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rules the cleaning step applies.
# An ISBN is invalid when it is empty or contains any character other than 0-9.
NON_DIGIT = "[^0-9]"
# Ages outside 6..80 are unrealistic; publication years above 2025 are too.
AGE_MIN, AGE_MAX = 6, 80
YEAR_MAX = 2025


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def invalid_isbn(c: str | Column = "isbn", pattern: str = NON_DIGIT) -> Column:
    """True for '' or a value with a character outside the allowed class.

    NULL stays NULL (unknown), as in SQL: a NULL ISBN is neither deleted nor kept
    by this rule alone; callers decide with ``coalesce``.
    """
    c = _col(c)
    return (c == F.lit("")) | c.rlike(pattern)


def positive(c: str | Column = "book_rating") -> Column:
    """Ratings that count in histograms and rankings (0 means 'no rating')."""
    return _col(c) > 0


def null_out_of_range(c: str | Column, lo: int | None, hi: int | None) -> Column:
    """Value outside [lo, hi] becomes NULL; NULL stays NULL; bounds are inclusive."""
    c = _col(c)
    out = F.lit(False)
    if lo is not None:
        out = out | (c < lo)
    if hi is not None:
        out = out | (c > hi)
    return F.when(out, F.lit(None)).otherwise(c)


def null_above(c: str | Column, hi: int) -> Column:
    return null_out_of_range(c, None, hi)


def is_insert(c: str | Column = "value") -> Column:
    """Any line whose upper-cased text contains INSERT (also true inside data)."""
    return F.upper(_col(c)).contains("INSERT")
