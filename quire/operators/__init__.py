"""Operators: DataFrame -> DataFrame functions built on Spark SQL and pyspark.ml."""
