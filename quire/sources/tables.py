"""Parquet table loading (full-table reads; Catalyst prunes columns and pushes filters)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def load_tables(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: read_table(spark, folder, name) for name in names}
