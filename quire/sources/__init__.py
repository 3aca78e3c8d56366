"""Sources and sinks: Parquet tables, CSV, dump text, artifacts."""

from quire.sources.artifacts import (
    load_model,
    load_split,
    load_splits,
    read_manifest,
    save_model,
    save_parquet,
    save_splits,
    write_manifest,
)
from quire.sources.csv_io import (
    read_books_csv,
    read_csv,
    read_ratings_csv,
    read_users_csv,
    write_csv,
    write_ratings_csv,
)
from quire.sources.dump import read_dump_lines, read_dump_statements, write_lines
from quire.sources.tables import load_tables, read_table

__all__ = [
    "load_model",
    "load_split",
    "load_splits",
    "load_tables",
    "read_books_csv",
    "read_csv",
    "read_dump_lines",
    "read_dump_statements",
    "read_manifest",
    "read_ratings_csv",
    "read_table",
    "read_users_csv",
    "save_model",
    "save_parquet",
    "save_splits",
    "write_csv",
    "write_lines",
    "write_manifest",
    "write_ratings_csv",
]
