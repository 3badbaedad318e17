import random

import pytest
from models import box_of, leaf_counts
from pyspark.sql import functions as F

from starloom.operators import lookup
from starloom.operators.quadtree import build_quadtree

SCHEMA = "pos int, cell string, x0 double, x1 double, y0 double, y1 double"


def test_first_rectangle_of_a_list(spark):
    rng = random.Random(5)
    rects = []
    for k in range(60):
        xs, ys = sorted(rng.choices(range(-10, 11), k=2)), sorted(rng.choices(range(-10, 11), k=2))
        rects.append((rng.randint(0, 1000) * 100 + k, f"r{k}", *map(float, xs), *map(float, ys)))
    points = [(k, float(rng.randint(-12, 12)), rng.choice((0.5, 0.0)) + rng.randint(-12, 12)) for k in range(500)]
    points += [(900, None, 1.0), (901, float("nan"), 1.0), (902, 1e300, 1.0)]
    df = spark.createDataFrame(points, "id int, x double, y double")
    got = {r.id: r.cell for r in lookup.find_rectangle(df, spark.createDataFrame(rects, SCHEMA), "x", "y").collect()}
    for key, x, y in points:
        held = [r for r in sorted(rects) if x is not None and r[2] <= x <= r[3] and r[4] <= y <= r[5]]
        assert got[key] == (held[0][1] if held else "-1")


def test_no_rectangles_and_old_tags(spark):
    df = spark.createDataFrame([(1.0, 2.0, "old")], "x double, y double, cell string")
    assert lookup.find_rectangle(df, spark.createDataFrame([], SCHEMA), "x", "y").first().cell == "-1"
    one = spark.createDataFrame([(0, "p", 1.0, 1.0, 2.0, 2.0)], SCHEMA)
    assert lookup.find_rectangle(df, one, "x", "y").first().cell == "p"


def _first_of(rects, points):
    out = {}
    for key, x, y in points:
        out[key] = next((r[1] for r in sorted(rects) if r[2] <= x <= r[3] and r[4] <= y <= r[5]), "-1")
    return out


@pytest.mark.parametrize("grows", [True, False])
def test_nested_rectangles(spark, grows):
    """Each holds the one before it, or lies in it; lists stay linear in their number."""
    sizes = range(1, 1501) if grows else range(1500, 0, -1)
    rects = [(k, f"r{n}", -float(n), float(n), -n / 2, n / 2) for k, n in enumerate(sizes)]
    rng = random.Random(2)
    points = [(k, rng.uniform(-1600, 1600), rng.uniform(-800, 800)) for k in range(800)] + [(900, 1500.0, 750.0)]
    df, listed = spark.createDataFrame(points, "id int, x double, y double"), spark.createDataFrame(rects, SCHEMA)
    got = {r.id: r.cell for r in lookup.find_rectangle(df, listed, "x", "y").collect()}
    assert got == _first_of(rects, points)
    lists = lookup.rectangle_lists(listed, lookup.Box(-1500.0, 1500.0, -750.0, 750.0))
    assert lists.count() <= lookup.MOST_ENTRIES * len(rects)


def test_many_rectangles_over_the_whole_box(spark):
    n = 100_000
    whole = spark.range(n).selectExpr(
        "int(id) AS pos", "concat('w', id) AS cell", "0d AS x0", "1d AS x1", "0d AS y0", "1d AS y1"
    )
    assert lookup.rectangle_lists(whole, lookup.Box(0.0, 1.0, 0.0, 1.0)).count() == 1
    points = spark.range(2000).selectExpr("rand(1) * 1.1 AS x", "rand(2) AS y")
    found = {r.cell: r["count"] for r in lookup.find_rectangle(points, whole, "x", "y").groupBy("cell").count().collect()}
    assert set(found) == {"w0", "-1"} and sum(found.values()) == 2000


def test_many_large_rectangles(spark):
    rng = random.Random(9)
    rects = []
    for k in range(6400):
        xs, ys = sorted(rng.uniform(0, 100) for _ in range(2)), sorted(rng.uniform(0, 100) for _ in range(2))
        rects.append((k, f"r{k}", *xs, *ys))
    points = [(k, rng.uniform(-1, 101), rng.uniform(0, 100)) for k in range(500)]
    df = spark.createDataFrame(points, "id int, x double, y double")
    got = {r.id: r.cell for r in lookup.find_rectangle(df, spark.createDataFrame(rects, SCHEMA), "x", "y").collect()}
    assert got == _first_of(rects, points)


def test_edges_at_infinity(spark):
    inf = float("inf")
    rects = [(0, "left", -inf, 0.0, -1.0, 1.0), (1, "top", -5.0, 5.0, 1.0, inf), (2, "all", -inf, inf, -inf, inf)]
    points = [(0, -1e9, 0.0), (1, 0.0, 7e8), (2, 3.0, -2.0), (3, 4.0, 1.0)]
    df = spark.createDataFrame(points, "id int, x double, y double")
    got = {r.id: r.cell for r in lookup.find_rectangle(df, spark.createDataFrame(rects, SCHEMA), "x", "y").collect()}
    assert got == {0: "left", 1: "top", 2: "all", 3: "top"}


def test_a_stored_split_places_new_rows(spark, tmp_path):
    rng = random.Random(3)
    points = [(rng.random() ** 3, rng.random()) for _ in range(300)]
    df = spark.createDataFrame(points, "x double, y double")
    tree = build_quadtree(df, "x", "y", 20)
    lookup.store_tree(tree, str(tmp_path / "split"))
    again = lookup.load_tree(spark, str(tmp_path / "split"))
    assert (again.box, again.leaf_depths, again.threshold) == (box_of(points), tree.leaf_depths, 20)
    more = df.unionByName(spark.createDataFrame([(5.0, 0.5), (None, 0.1)], "x double, y double"))
    got = [r.cell for r in again.assign(more, "x", "y").collect()]
    assert sorted(got[:300]) == sorted(leaf_counts(points, 20, 30)) and got[300:] == [None, None]
    empty = build_quadtree(df.limit(0), "x", "y", 20)
    lookup.store_tree(empty, str(tmp_path / "none"))
    assert lookup.load_tree(spark, str(tmp_path / "none")).assign(df, "x", "y").filter("cell is null").count() == 300


@pytest.mark.parametrize("sent", [1, 3000, 1 << 26])
def test_rectangles_beyond_those_that_are_sent(spark, monkeypatch, sent):
    """The first ones go to the executors, the others to lists; names and places may be equal or missing."""
    monkeypatch.setattr(lookup, "SENT_BYTES", sent)
    rng = random.Random(sent)
    rects = []
    for k in range(300):
        xs, ys = sorted(rng.choices(range(30), k=2)), sorted(rng.choices(range(30), k=2))
        rects.append((k // 2, f"r{k}", *map(float, xs), *map(float, ys)))
    rects += [(900, "late", *r[2:]) for r in rects[:50]] + [(400, None, -5.0, -4.0, -5.0, 40.0), (0, "bad", 2.0, 1.0, 0.0, 9.0)]
    points = [(k, float(rng.randint(-1, 31)), rng.choice((0.5, 0.0)) + rng.randint(-1, 31)) for k in range(800)]
    points += [(900, None, 1.0), (901, 1.0, float("nan")), (902, float("inf"), 1.0), (903, -4.5, 3.0)]
    df = spark.createDataFrame(points, "id int, x double, y double").withColumn("cell", F.lit("old"))
    found = lookup.find_rectangle(df, spark.createDataFrame(rects, SCHEMA).repartition(3), "x", "y")
    got = {r.id: r.cell for r in found.collect()}
    known = [r for r in rects if r[1]]
    assert got == _first_of(known, [(k, -99.0 if x is None else x, y) for k, x, y in points])


def test_many_sent_rectangles_write_no_lists(spark, monkeypatch):
    """What is looked through at the executors needs no list, however many rectangles lie within each other."""
    monkeypatch.setattr(lookup, "rectangle_lists", None)
    rng = random.Random(4)
    rects = [(k, f"r{k}", -rng.uniform(1, 50), rng.uniform(1, 50), -rng.uniform(1, 50), rng.uniform(1, 50)) for k in range(5000)]
    points = [(k, rng.uniform(-55, 55), rng.uniform(-55, 55)) for k in range(3000)]
    df, listed = spark.createDataFrame(points, "id int, x double, y double"), spark.createDataFrame(rects, SCHEMA)
    got = {r.id: r.cell for r in lookup.find_rectangle(df, listed, "x", "y").collect()}
    want = {}
    for key, x, y in points:
        want[key] = next((r[1] for r in rects if r[2] <= x <= r[3] and r[4] <= y <= r[5]), "-1")
    assert got == want
