"""Statements over several lines and file splits."""

import os
import random

import pytest
from pyspark.sql.types import StructType

from quire.operators import dump as D
from quire.operators import statements as ST
from quire.sources import read_dump_statements

NASTY = [
    ("it's; so", "a;\nb"),
    ("-- no comment", "/* nor this; */ # nor this"),
    ('"', "`"),
    ("back\\slash", "end\\"),
    ("'", "''"),
    ("x\r\ny", "\n;\n;"),
    (None, ""),
    ("long; " * 60, "\\'"),
]


def quoted(value):
    if value is None:
        return "NULL"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def dump_text(rng, n):
    """(text, rows): statements of several tuples, each on its own line, with comments."""
    rows, out = [], ["/*!40101 SET NAMES utf8; */;\n", "-- it's a comment; really\n", "SET a=1; SET b=`;`; # don't\n"]
    while len(rows) < n:
        some = [(len(rows) + i, *rng.choice(NASTY)) for i in range(rng.randrange(1, 5))]
        rows += some
        tuples = ",\n".join(f"({i},{quoted(a)},{quoted(b)})" for i, a, b in some)
        comment = rng.choice(["", "/* it's; one */ ", "-- a; 'b\n"])
        out.append(f"INSERT INTO t\n{comment}VALUES\n{tuples}\n;{rng.choice(['', chr(10), '  '])}")
    return "".join(out), rows


def brute(text):
    """The whole text in one scan."""
    state, now, out = ST.CODE, "", []
    for line in text.split("\n"):
        state, parts = ST.scan(line, state)
        for part in parts:
            if part is ST.END:
                out.append(now.strip())
                now = ""
            else:
                now += part
        now += "\n"
    return [x for x in [*out, now.strip()] if x not in ("", ";")]


@pytest.fixture()
def split_size(spark):
    def hold(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")

    yield hold
    for key in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{key}")


@pytest.mark.parametrize("size", ["37", "101", "256", "1000", "100000"])
def test_rows_do_not_depend_on_the_split_size(spark, tmp_dir, split_size, size):
    want = {}
    for name in ("a.sql", "b.sql"):
        text, rows = dump_text(random.Random(name), 25)
        want[name] = brute(text), rows
        with open(os.path.join(tmp_dir, name), "w", newline="") as f:
            f.write(text)
    split_size(size)
    got = read_dump_statements(spark, tmp_dir)
    found = {}
    for r in got.orderBy("load_order").collect():
        found.setdefault(os.path.basename(r["load_order"]["file"]), []).append(r["value"])
    assert found == {name: texts for name, (texts, _) in want.items()}
    parsed = D.parse_dump_rows(got, "t", StructType.fromDDL("i int, a string, b string"))
    rows = sorted((tuple(r)[:3] for r in parsed.collect()), key=str)
    assert rows == sorted((r for _, rows in want.values() for r in rows), key=str)


def test_scan_states():
    assert ST.scan("a 'b;", ST.CODE) == (ST.SINGLE, ["a 'b;"])
    assert ST.scan("c'' d\\", ST.SINGLE) == (ST.SINGLE, ["c'' d\\"])
    assert ST.scan("e'; f", ST.SINGLE) == (ST.CODE, ["e';", ST.END, " f"])
    assert ST.scan("x /* y; */ z", ST.CODE) == (ST.CODE, ["x ", " z"])
    assert ST.scan("x */ z;", ST.LEFT_OUT) == (ST.CODE, [" z;", ST.END])
    assert ST.scan("a--b; -- c;", ST.CODE) == (ST.CODE, ["a--b;", ST.END, " "])
    assert ST.scan("", ST.DOUBLE) == (ST.DOUBLE, [])


def test_a_long_text_neither_recurses_nor_backtracks():
    line = "'" + "a\\'" * 300_000
    assert ST.scan(line, ST.CODE)[0] == ST.SINGLE and ST.scan("*" * 300_000, ST.LEFT_OUT)[0] == ST.LEFT_OUT


def test_a_quote_that_is_never_closed_is_reported(spark, tmp_dir, split_size, monkeypatch):
    with open(os.path.join(tmp_dir, "a.sql"), "w") as f:
        f.write("INSERT INTO t VALUES ('a);\n" + "b;\n" * 500)
    split_size("100")
    monkeypatch.setattr(ST, "MAX_BYTES", 600)
    with pytest.raises(ValueError, match="has no end"):
        read_dump_statements(spark, tmp_dir)


def test_empty_file_and_text_without_end(spark, tmp_dir):
    for name, text in (("a.sql", ""), ("b.sql", "\n-- only this\n"), ("c.sql", "SELECT 1")):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(text)
    assert [r["value"] for r in read_dump_statements(spark, tmp_dir).collect()] == ["SELECT 1"]
