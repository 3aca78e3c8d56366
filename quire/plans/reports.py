"""Reports as DataFrames of text lines: (section, part, key, line).

``part`` is 0 for heading lines, 1 for data lines and 2 for closing lines; ``key``
orders lines inside a part (bin value, rank, or position of a fixed line). Sorting
by (section, part, key) gives the printed order without any window or collect.
Data lines use ``format_string`` with the reference's fixed widths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.evaluate import rmse_histogram_table
from quire.operators.profile import (
    activity_table,
    histogram_of_counts,
    top_books_of_counts,
    top_of_counts,
)
from quire.session import ensure_checkpoint_dir

# The profile report's text (sections 3.a-3.g).
COUNT_LINES = {
    "users": ("3.a", "3.a) how many users?       %d"),
    "books": ("3.b", "3.b) how many books?       %d"),
    "ratings": ("3.c", "3.c) how many ratings?     %d"),
}
HIST_ROW = "| %3d | %5d  |"
BOOK_ROW = "| %-18s | %5d  |"
USER_ROW = "| %-6s | %5d  |"
FIXED_LINES = (
    ("3.d", 0, 0, "3.d) histogram of user-ratings <table(num ratings, num users)>"),
    ("3.d", 0, 1, "(how many users have rated N times?)"),
    ("3.d", 0, 2, "+-----+-------+"),
    ("3.d", 0, 3, "| bin | N     |"),
    ("3.d", 0, 4, "+-----+-------+"),
    ("3.d", 2, 0, "+-----+-------+"),
    ("3.e", 0, 0, "3.e) histogram of book-ratings <table(num ratings, num books)>"),
    ("3.e", 0, 1, "(how many books have been rated N times?)"),
    ("3.e", 0, 2, "+-----+-------+"),
    ("3.e", 0, 3, "| bin | N     |"),
    ("3.e", 0, 4, "+-----+-------+"),
    ("3.e", 2, 0, "+-----+-------+"),
    ("3.f", 0, 0, "3.f) top-10 rated books?"),
    ("3.f", 0, 1, "+--------------------+-------+"),
    ("3.f", 0, 2, "| name               | N     |"),
    ("3.f", 0, 3, "+--------------------+-------+"),
    ("3.f", 2, 0, "+--------------------+-------+"),
    ("3.g", 0, 0, "3.g) top-10 active users?"),
    ("3.g", 0, 1, "+--------+-------+"),
    ("3.g", 0, 2, "| user id   | N     |"),
    ("3.g", 0, 3, "+--------+-------+"),
    ("3.g", 2, 0, "+--------+-------+"),
)

# The lines around a report file.
FRAME_BEGIN = "-------------------- BEGIN %s --------------------"
FRAME_END = "-------------------- END %s --------------------"
TEAM_LINE, DATE_LINE, DATABASE_LINE = "# Team: %s", "# Date: %s", "# Database name   %s"

# The model report's text (sections 6.a-6.c).
MODEL_FIXED_LINES = (
    ("6.b", 0, 0, "6.b) histogram of RMSE <table(bin, num occurrences UBCF, num occurrences IBCF)>"),
    ("6.b", 0, 1, "RMSE"),
    ("6.b", 0, 2, "      N.UBCF   N.IBCF"),
    ("6.c", 0, 0, "6.c) Top-10 recommendations   <table(user,book1,book2,book3, ..., book10)>"),
)
RMSE_LINE = "6.a) RMSE of the full model UB %s, IB %s"
RMSE_VALUE = "%.6f"
RMSE_HIST_ROW = "%.2f  %-8d %-8d"
REC_ROW = "%s  %s"
MISSING = "NA"

REPORT_SCHEMA = "section string, part int, key bigint, line string"


def _fixed(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(list(rows), REPORT_SCHEMA)


def _text(column: str):
    return F.coalesce(F.col(column).cast("string"), F.lit(MISSING))


def _number(column: str):
    return F.when(F.col(column).isNull(), MISSING).otherwise(F.format_string(RMSE_VALUE, column))


def _lines(df: DataFrame, section: str, key, line) -> DataFrame:
    return df.select(
        F.lit(section).alias("section"),
        F.lit(1).alias("part"),
        key.cast("bigint").alias("key"),
        line.alias("line"),
    )


def basics_report(
    users: DataFrame,
    books: DataFrame,
    ratings: DataFrame,
    k: int = 10,
    user: str = "user_id",
    isbn: str = "isbn",
) -> DataFrame:
    """Counts, two activity histograms and two top-k lists as report lines.

    The ratings are scanned once, into ``profile.activity_table`` (one row per user and
    per book, checkpointed); the rating count, both histograms and both top lists are
    derived from it."""
    ensure_checkpoint_dir(ratings.sparkSession)
    activity = activity_table(ratings, user, isbn).checkpoint(eager=True)
    return _basics(users, books, activity, "n_rows", "n_ratings", k, user, isbn)


def _basics(users, books, activity, n_rows: str, n_ratings: str, k: int, user: str, isbn: str) -> DataFrame:
    spark = activity.sparkSession
    counts = [F.col(n_rows).alias("n_rows"), F.col(n_ratings).alias("n_ratings")]
    per_user = activity.filter(~F.col("by_book")).select(user, *counts)
    per_book = activity.filter("by_book").select(isbn, *counts)
    totals = {
        "users": users.agg(F.count(F.lit(1)).alias("n")),
        "books": books.agg(F.count(F.lit(1)).alias("n")),
        "ratings": per_user.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("n")),
    }
    count_parts = [
        totals[metric].select(
            F.lit(section).alias("section"),
            F.lit(1).alias("part"),
            F.lit(0).cast("bigint").alias("key"),
            F.format_string(fmt, F.col("n")).alias("line"),
        )
        for metric, (section, fmt) in COUNT_LINES.items()
    ]
    hist_u = histogram_of_counts(per_user)
    hist_b = histogram_of_counts(per_book)
    tb = top_books_of_counts(per_book, books, k, isbn)
    tu = top_of_counts(per_user, user, k)
    parts = count_parts + [
        _lines(hist_u, "3.d", F.col("bin"), F.format_string(HIST_ROW, "bin", "n")),
        _lines(hist_b, "3.e", F.col("bin"), F.format_string(HIST_ROW, "bin", "n")),
        _lines(tb, "3.f", F.col("rank"), F.format_string(BOOK_ROW, _text("book_title"), "n_ratings")),
        _lines(
            tu, "3.g", F.col("rank"), F.format_string(USER_ROW, _text(user), "n_ratings")
        ),
        _fixed(spark, FIXED_LINES),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def basics_delta(
    before: tuple[DataFrame, DataFrame],
    after: tuple[DataFrame, DataFrame],
    tagged: DataFrame,
    k: int = 10,
    user: str = "user_id",
    isbn: str = "isbn",
) -> DataFrame:
    """The profile report on raw and on clean tables, tagged ``stage``. ``before`` and
    ``after`` are (users, books); ``tagged`` are the raw ratings with ``dropped_by``, null
    for the clean ones (``clean.tag_rating_rules``). They are scanned once: each user and
    book has its counts of all and of kept rows side by side."""
    ensure_checkpoint_dir(tagged.sparkSession)
    activity = activity_table(tagged, user, isbn, kept=F.col("dropped_by").isNull()).checkpoint(eager=True)
    # A key without a kept row has no positive rating left: it is in no list or histogram.
    raw = _basics(*before, activity, "n_rows", "n_ratings", k, user, isbn)
    clean = _basics(*after, activity, "rows_kept", "ratings_kept", k, user, isbn)
    return raw.select(F.lit("before").alias("stage"), "*").unionByName(clean.select(F.lit("after").alias("stage"), "*"))


def model_report(
    best: DataFrame,
    preds: DataFrame,
    lines: DataFrame,
    width: float = 0.25,
    user: str = "user_id",
    item: str = "item_id",
    label: str = "norm",
    by: list[str] | None = None,
) -> DataFrame:
    """6.a best UB and IB averages; 6.b histogram of per-user and per-item RMSE of
    ``preds`` (one count per (by..., entity) when ``by`` is given, e.g. model and
    fold); 6.c one line per (method, user) from ``lines``."""
    spark = best.sparkSession
    pivot = best.agg(
        F.max(F.when(F.col("method") == "UBCF", F.col("rmse"))).alias("ub"),
        F.max(F.when(F.col("method") == "IBCF", F.col("rmse"))).alias("ib"),
    )
    head = pivot.select(
        F.lit("6.a").alias("section"),
        F.lit(1).alias("part"),
        F.lit(0).cast("bigint").alias("key"),
        F.format_string(RMSE_LINE, _number("ub"), _number("ib")).alias("line"),
    )
    hist = rmse_histogram_table(preds, user, item, label, width=width, by=by)
    hist_lines = _lines(
        hist,
        "6.b",
        F.round(F.col("bin") / F.lit(width)),
        F.format_string(RMSE_HIST_ROW, "bin", "n_ubcf", "n_ibcf"),
    )
    rec_lines = lines.select(
        F.concat(F.lit("6.c "), F.col("method")).alias("section"),
        F.lit(1).alias("part"),
        F.col(user).cast("bigint").alias("key"),
        F.format_string(REC_ROW, _text(user), F.col("line")).alias("line"),
    )
    return head.unionByName(hist_lines).unionByName(rec_lines).unionByName(_fixed(spark, MODEL_FIXED_LINES))


def framed(report: DataFrame, name: str, team: str, date: str, database: str) -> DataFrame:
    """The report between its BEGIN and END lines, with team, date and database; once for
    each ``stage`` if it has stages."""
    rows = [("", 0, i, text) for i, text in enumerate((FRAME_BEGIN % name, TEAM_LINE % team, DATE_LINE % date, DATABASE_LINE % database))]
    frame = _fixed(report.sparkSession, [*rows, ("~", 0, 0, FRAME_END % name)])
    if "stage" in report.columns:
        frame = frame.withColumn("stage", F.explode(F.array(F.lit("before"), F.lit("after"))))
    return report.unionByName(frame)


def write_report(report: DataFrame, path: str) -> None:
    """Text file(s) in report order (a range-partitioned sort, so each task
    writes one contiguous range of lines); a ``stage`` column puts 'before' first."""
    order = [F.col("stage") != "before"] if "stage" in report.columns else []
    ordered = report.orderBy(*order, "section", "part", "key")
    ordered.select("line").write.mode("overwrite").text(path)
