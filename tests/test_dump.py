"""Dump rewrite and INSERT parsing on micro-fixtures."""

import os

import pytest
from pyspark.sql.types import StructType

from quire import schemas
from quire.operators import dump as D
from quire.operators.dedup import insert_or_ignore
from quire.streaming.dump_stream import normalize_dump_stream

LINES = [
    "CREATE TABLE `BX-Users` (`User-ID` int(11)) Engine=InnoDB  DEFAULT CHARSET=latin1;",
    "insert ignore into `BX-Books` VALUES ('0001','It\\'s an insert story','A (b), c',1999);",
    "INSERT IGNORE INTO `BX-Book-Ratings` VALUES (1,'0001',5),(1,'0001',7),(2,'0002',NULL);",
    "-- Book-Title Image-URL-S Image-URL-M Image-URL-L Year-Of-Publication Book-Author",
]


def _lines(spark):
    return spark.createDataFrame([(i, v) for i, v in enumerate(LINES)], "load_order bigint, value string")


def test_rewrite_rules(spark):
    out = [r["value"] for r in D.normalize_dump(_lines(spark)).orderBy("load_order").collect()]
    assert out[0] == "CREATE TABLE BX_Users (`User_ID` int(11)) ;"
    assert out[1] == "INSERT OR IGNORE INTO BX_Books VALUES ('0001','It''s an insert story','A (b), c',1999);"
    assert out[2].startswith("INSERT OR IGNORE INTO BX_Book_Ratings VALUES (1,'0001',5)")
    assert out[3] == "-- Book_Title Image_URL_S Image_URL_M Image_URL_L Year_Of_Publication Book_Author"


def test_insert_detection_is_a_substring_test(spark):
    counts = D.count_inserts(D.normalize_dump(_lines(spark))).collect()[0]["n_insert_lines"]
    assert counts == 2
    flagged = D.insert_lines(spark.createDataFrame([("a title with insert inside",)], "value string"))
    assert flagged.count() == 1


def test_parse_tuples_and_insert_or_ignore(spark):
    norm = D.normalize_dump(_lines(spark))
    rows = D.parse_dump_rows(norm, "BX_Book_Ratings", schemas.RATINGS)
    assert rows.count() == 3
    first = insert_or_ignore(rows, ["user_id", "isbn"], ["load_order"]).drop("load_order")
    assert sorted(tuple(r) for r in first.collect()) == [(1, "0001", 5), (2, "0002", None)]
    books = D.parse_dump_rows(norm, "BX_Books", StructType(schemas.BOOKS.fields[:4])).collect()
    assert books[0]["book_title"] == "It's an insert story"
    assert books[0]["book_author"] == "A (b), c"
    assert books[0]["year_of_publication"] == 1999


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1, 2)], "`User-ID` int, `Book-Rating` int")
    assert D.normalize_columns(df).columns == ["User_ID", "Book_Rating"]


def test_streaming_rewrite_matches_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.sql"), "w") as f:
        f.write("\n".join(LINES) + "\n")
    sink = os.path.join(tmp_dir, "out")
    q = normalize_dump_stream(spark, src, sink, os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination(120)
    got = sorted(r["value"] for r in spark.read.text(sink).collect())
    want = sorted(r["value"] for r in D.normalize_dump(_lines(spark)).collect())
    assert got == want


def test_dump_files_round_trip_to_the_ratings_table(spark, tmp_dir):
    from conftest import SF0001
    from quire.plans import fixtures as fx
    from quire.sources import read_dump_lines, write_lines

    path = os.path.join(tmp_dir, "ratings_dump")
    lines = fx.dump_lines(spark, SF0001).filter("source = 'BX-Book-Ratings.sql'")
    # A range sort writes part files whose names follow the load order.
    write_lines(lines.orderBy("load_order"), path)
    back = D.normalize_dump(read_dump_lines(spark, path))
    rows = D.parse_dump_rows(back, "BX_Book_Ratings", schemas.RATINGS)
    got = insert_or_ignore(rows, ["user_id", "isbn"], ["load_order"]).select("user_id", "isbn", "book_rating")
    want = fx.ratings(spark, SF0001).select("user_id", "isbn", "book_rating")
    assert got.count() == want.count() == 5382
    assert got.exceptAll(want).count() == 0


def _parsed(spark, *texts):
    lines = spark.createDataFrame(list(enumerate(texts)), "load_order bigint, value string")
    rows = D.parse_dump_rows(lines, "t", StructType.fromDDL("a int, b string"))
    return sorted((tuple(r)[:2] for r in rows.collect()), key=str)


def test_parse_forms_of_insert(spark):
    want = [(1, "x, (y)"), (2, None)]
    assert _parsed(spark, "INSERT INTO t VALUES (1,'x, (y)'),(2,NULL);") == want
    assert _parsed(spark, "insert into `t`(`a`,`b`) values (1, 'x, (y)'), (2, null);") == want
    assert _parsed(spark, "INSERT IGNORE INTO t (a, b)\nVALUES\n(1,'x, (y)'),\n(2,NULL) ;") == want
    assert _parsed(spark, "INSERT INTO tt VALUES (1,'x');", "-- t") == []


def test_parse_quotes_and_escapes(spark):
    got = _parsed(spark, r"INSERT INTO t VALUES (1,'NULL'),(2,'a\\b'),(3,'it\'s'),(4,'it''s'),(5,''),(6,'a\nb'),(7,'c:\\');")
    assert got == [(1, "NULL"), (2, "a\\b"), (3, "it's"), (4, "it's"), (5, ""), (6, "a\nb"), (7, "c:\\")]
    long_ = "it''s (so), " * 20000
    assert _parsed(spark, f"INSERT INTO t VALUES (1,'{long_}');") == [(1, long_.replace("''", "'"))]


def test_parse_refuses_what_it_would_lose(spark):
    for text in ("INSERT INTO t VALUES (1,'x'),", "INSERT INTO t VALUES ('x1','x');", "INSERT INTO t VALUES (1,'x',2);"):
        with pytest.raises(Exception, match="statement is not whole|no int in the dump|not 2 fields"):
            _parsed(spark, text)
