"""Column expressions built from pyspark.sql.functions only (JVM-side, codegen'd)."""

from quire.functions.predicates import (
    invalid_isbn,
    is_insert,
    null_above,
    null_out_of_range,
    positive,
)
from quire.functions.metrics import hist_bin, squared_error
from quire.functions.text import item_label, padded_line, short_name

__all__ = [
    "hist_bin",
    "invalid_isbn",
    "is_insert",
    "item_label",
    "null_above",
    "null_out_of_range",
    "padded_line",
    "positive",
    "short_name",
    "squared_error",
]
