"""Property tests: operators against plain-Python definitions on random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.functions.text import padded_line
from quire.operators import prepare as P
from quire.operators.dedup import insert_or_ignore
from quire.session import sizing_conf

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))

rows = st.lists(
    st.tuples(st.integers(0, 5), st.sampled_from(["a", "b", "c"]), st.integers(0, 10), st.integers(0, 1000)),
    min_size=1,
    max_size=40,
)


@SETTINGS
@given(rows)
def test_insert_or_ignore_keeps_first_row(spark, data):
    df = spark.createDataFrame(data, "user_id int, isbn string, book_rating int, load_order int")
    got = {(r["user_id"], r["isbn"]): r["book_rating"] for r in insert_or_ignore(df, ["user_id", "isbn"], ["load_order"]).collect()}
    want = {}
    for u, i, r, o in sorted(data, key=lambda t: (t[3], t[2])):
        want.setdefault((u, i), r)
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.text("xyz", min_size=1, max_size=3), st.integers(1, 4)), min_size=1, max_size=30, unique_by=lambda t: t[0]))
def test_dense_index_is_the_sorted_position(spark, data):
    df = spark.createDataFrame(data, "k string, n int")
    out = {r["k"]: r["idx"] for r in P.dense_index(df, [F.desc("n"), F.asc("k")], "idx", num_partitions=3).collect()}
    order = [k for k, _ in sorted(data, key=lambda t: (-t[1], t[0]))]
    assert out == {k: i for i, k in enumerate(order)}


@SETTINGS
@given(st.lists(st.text("ab ", max_size=4), max_size=14), st.integers(1, 12))
def test_padded_line(spark, labels, width):
    df = spark.createDataFrame([(labels,)], "l array<string>")
    got = df.select(padded_line(F.col("l"), width).alias("x")).first()["x"]
    items = (labels + [""] * width)[:width]
    assert got == "  ".join(items)


def test_sizing_conf_scales_with_input():
    small = sizing_conf(10 * 1024**2)
    big = sizing_conf(100 * 1024**4)
    assert int(small["spark.sql.shuffle.partitions"]) == 8
    assert int(big["spark.sql.shuffle.partitions"]) == 409600


def _sequential_clean(ratings, catalogue):
    """The reference's deletes in order, with SQL NULL semantics, in plain Python."""
    import re

    rows = list(ratings)
    # 1. DELETE WHERE isbn NOT IN (SELECT isbn FROM books): unknown (kept) when the
    #    rating's isbn is NULL or the list holds a NULL.
    if None not in catalogue:
        rows = [r for r in rows if r[1] is None or r[1] in catalogue]
    # 2. ratings of books with an invalid ISBN ('' or a non-digit), by IN list
    invalid = {b for b in catalogue if b is not None and (b == "" or re.search("[^0-9]", b))}
    rows = [r for r in rows if r[1] not in invalid]

    # 3./4. keys whose ratings sum to 0 (NULL sums are not 0)
    def zero_keys(idx):
        sums = {}
        for r in rows:
            if r[idx] is None:
                continue
            s = sums.setdefault(r[idx], None)
            if r[2] is not None:
                sums[r[idx]] = (s or 0) + r[2]
        return {k for k, v in sums.items() if v == 0}

    zu = zero_keys(0)
    rows = [r for r in rows if r[0] not in zu]
    zi = zero_keys(1)
    rows = [r for r in rows if r[1] not in zi]
    # 5. DELETE WHERE rating = 0 (NULL stays)
    return [r for r in rows if r[2] != 0]


ratings_rows = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(1, 4)),
        st.sampled_from([None, "", "001", "002", "003", "00X", "12a", "004"]),
        st.one_of(st.none(), st.integers(-2, 3)),
    ),
    min_size=1,
    max_size=30,
)
catalogue_rows = st.lists(st.sampled_from([None, "", "001", "002", "00X", "12a", "004"]), max_size=7)


@SETTINGS
@given(ratings_rows, catalogue_rows)
def test_rule_tagging_equals_sequential_deletes(spark, ratings, catalogue):
    from quire.operators import clean as C

    r = spark.createDataFrame(ratings, "user_id int, isbn string, book_rating int")
    b = spark.createDataFrame([(x,) for x in catalogue] or [("999",)], "isbn string")
    cat = set(catalogue) if catalogue else {"999"}
    got = sorted((tuple(x) for x in C.clean_ratings(r, b).collect()), key=repr)
    want = sorted(_sequential_clean(ratings, cat), key=repr)
    assert got == want


@SETTINGS
@given(
    st.lists(st.tuples(st.sampled_from([1, 1, 1, 1, 2, 3, None]), st.integers(0, 9)), min_size=1, max_size=60),
    st.sets(st.sampled_from([1, 2, 3, 4]), max_size=4),
    st.sampled_from(["inner", "left"]),
)
def test_join_back_equals_plain_join(spark, big_rows, small_keys, how):
    from quire.operators.skew import hot_keys, join_back

    big = spark.createDataFrame(big_rows, "k int, v int")
    small = spark.createDataFrame([(k, k * 10) for k in sorted(small_keys)] or [(99, 990)], "k int, w int")
    counts = big.groupBy("k").count().withColumnRenamed("count", "_n")
    old = spark.conf.get("spark.quire.skew.minRows", None)
    spark.conf.set("spark.quire.skew.minRows", "1")
    try:
        hot = hot_keys(counts, "k", "_n")
    finally:
        if old is None:
            spark.conf.unset("spark.quire.skew.minRows")
        else:
            spark.conf.set("spark.quire.skew.minRows", old)
    got = sorted((tuple(r) for r in join_back(big, small, "k", how, hot).select("k", "v", "w").collect()), key=repr)
    want = sorted((tuple(r) for r in big.join(small, "k", how).select("k", "v", "w").collect()), key=repr)
    assert got == want


@SETTINGS
@given(
    st.lists(
        st.tuples(st.integers(1, 4), st.sampled_from(["001", "002", "003", "00X", "12a", "004"]), st.integers(0, 3)),
        min_size=1,
        max_size=30,
    ),
    st.lists(st.sampled_from(["", "001", "002", "00X", "12a", "004"]), min_size=1, max_size=6),
)
def test_fused_cleaning_equals_sequential_without_nulls_or_negatives(spark, ratings, catalogue):
    from quire.operators import clean as C

    r = spark.createDataFrame(ratings, "user_id int, isbn string, book_rating int")
    b = spark.createDataFrame([(x,) for x in catalogue], "isbn string")
    seq = sorted(tuple(x) for x in C.clean_ratings(r, b).collect())
    fused = sorted(tuple(x) for x in C.clean_ratings(r, b, fused=True).collect())
    assert seq == fused == sorted(_sequential_clean(ratings, set(catalogue)))
