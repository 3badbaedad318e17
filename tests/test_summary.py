from collections import Counter

import pytest
from pyspark.sql import functions as F

from starloom.functions.text import csv_line, fields
from starloom.operators import summary as S


def test_lines_keep_the_place_of_nulls(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, 2.5, "")], "i int, d double, s string")
    lines = [r.line for r in df.select(csv_line(df.columns).alias("line")).collect()]
    assert lines == ["1,NULL,a", "NULL,2.5,"]
    back = [r.f for r in df.select(fields(csv_line(df.columns)).alias("f")).collect()]
    assert back == [["1", "NULL", "a"], ["NULL", "2.5", ""]]


@pytest.mark.parametrize("known_counts", [False, True])
def test_pages_are_whole_and_bounded_even_for_copies(spark, known_counts):
    # Two thirds of the rows sit in one cell and half of those are the same line.
    rows = [("hot", "same", 0)] * 500 + [("hot", f"v{k}", k) for k in range(500)] + [("b", f"w{k % 7}", 1) for k in range(400)]
    df = spark.createDataFrame(rows, "cell string, v string, k int")
    counts = S.count_per_cell(df) if known_counts else None
    pages = S.paged_lines(df, ["v", "k"], 50, counts=counts).collect()
    assert Counter((p.cell, line) for p in pages for line in p.lines) == Counter((c, f"{v},{k}") for c, v, k in rows)
    assert all(len(p.lines) == p.n and p.lines == sorted(p.lines) for p in pages)
    assert max(p.n for p in pages) <= 3 * 50 + 7 * 50
    assert len([p for p in pages if p.cell == "hot"]) >= 20
    text = S.text_per_cell(df, ["v", "k"], 50).collect()
    assert sum(len(t.text.split("\n")) for t in text) == len(rows)


def test_small_cell_is_one_text(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "cell string, k int")
    text = {(r.cell, r.text) for r in S.text_per_cell(df, ["k"], 10).collect()}
    assert text == {("a", "1\n2"), ("b", "3")}


def test_index_is_dense_and_in_id_order(spark):
    ids = [f"_{k:09}" for k in range(0, 3000, 7)] + ["_", "00", "1_10"]
    df = spark.createDataFrame([(i,) for i in ids + ids[:50]], "cell string")
    got = {r.cell: r.idx for r in S.index_cells(df).collect()}
    assert got == {cell: k for k, cell in enumerate(sorted(ids))}


def test_unwritten_rows(spark):
    df = spark.createDataFrame([(1, "_0"), (2, "_1"), (3, "_0")], "id int, cell string")
    written = spark.createDataFrame([("_0",), ("_0",)], "cell string")
    assert [r.id for r in S.unwritten_rows(df, written).collect()] == [2]


def test_rows_per_file_is_a_mean_of_ratios(spark):
    df = spark.createDataFrame([("ab",), ("abcd",), ("é",)], "s string")
    got = S.rows_per_file(df, F.col("s"), 1000).first().rows_per_file
    assert got == int((1000 / 2 + 1000 / 4 + 1000 / 2) / 3)


def test_balance(spark):
    df = spark.createDataFrame([("_01", "ab"), ("_01", "é"), ("_2", "x")], "cell string, s string")
    got = {r.cell: (r.n, r.bytes, r.depth) for r in S.cell_balance(df, F.col("s")).collect()}
    assert got == {"_01": (2, 4, 2), "_2": (1, 1, 1)}


def test_objects(spark):
    df = spark.createDataFrame(
        [(7, 1, 5.0, -1.0), (7, 3, 2.0, 4.0), (None, 2, 9.0, 9.0)], "o long, s long, x double, y double"
    )
    records = S.object_records(df, "o", "s", "x", "y")
    assert records.first().asDict() == {
        "object_id": 7, "n": 1, "source_id": 1, "x_low": 5.0, "x_high": 5.0, "y_low": -1.0, "y_high": -1.0,
    }
    got = {r.object_id: tuple(r)[1:] for r in S.object_summary(records).collect()}
    assert got == {7: (2, 3, 2.0, 5.0, -1.0, 4.0), None: (1, 2, 9.0, 9.0, 9.0, 9.0)}


def test_first_rows(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "k int")
    assert [r.k for r in S.first_rows(df, 2, "k").collect()] == [1, 2]
