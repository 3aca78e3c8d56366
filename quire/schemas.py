"""Explicit schemas. Inference is never used: it turns an all-digit ISBN column
into an integer and drops leading zeros, and it reads ``NA`` as text."""

from pyspark.sql import types as T

USERS = T.StructType(
    [
        T.StructField("user_id", T.LongType(), True),
        T.StructField("age", T.IntegerType(), True),
    ]
)

BOOKS = T.StructType(
    [
        T.StructField("isbn", T.StringType(), True),
        T.StructField("book_title", T.StringType(), True),
        T.StructField("book_author", T.StringType(), True),
        T.StructField("year_of_publication", T.IntegerType(), True),
        T.StructField("publisher", T.StringType(), True),
        T.StructField("image_url_s", T.StringType(), True),
        T.StructField("image_url_m", T.StringType(), True),
        T.StructField("image_url_l", T.StringType(), True),
    ]
)

RATINGS = T.StructType(
    [
        T.StructField("user_id", T.LongType(), True),
        T.StructField("isbn", T.StringType(), True),
        T.StructField("book_rating", T.IntegerType(), True),
    ]
)

# One recommendation list, as produced by ALSModel.recommendForUserSubset.
RECOMMENDATIONS = T.StructType(
    [
        T.StructField("user_id", T.LongType(), True),
        T.StructField(
            "recommendations",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("item_id", T.IntegerType(), True),
                        T.StructField("rating", T.FloatType(), True),
                    ]
                )
            ),
            True,
        ),
    ]
)
