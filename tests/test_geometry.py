import math
import random

import numpy as np
import pytest
from models import box_of, descend
from pyspark.sql import functions as F

from starloom.functions import geometry as G
from starloom.functions.geometry import Box


def paths(spark, points, box, depth, force_halving=False):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, x double, y double")
    if force_halving:
        indexed = G._quad_index_by_halving(df, box, depth, "x", "y")
    else:
        indexed = G.with_quad_index(df, box, depth, "x", "y")
    named = indexed.withColumn(
        "cell", F.when(F.col("qx") >= 0, G.quad_path(F.lit(depth), F.col("qx"), F.col("qy")))
    )
    return [r.cell for r in named.orderBy("id").collect()]


def lattice(n):
    return [(float(i), float(j)) for i in range(n) for j in range(n)]


@pytest.mark.parametrize("halving", [False, True])
@pytest.mark.parametrize("depth", [0, 1, 3, 4, 7])
def test_every_tie_of_a_lattice(spark, depth, halving):
    points = lattice(17)
    box = box_of(points)
    assert paths(spark, points, box, depth, halving) == [descend(p, box, depth) for p in points]


@pytest.mark.parametrize("halving", [False, True])
def test_random_points_with_awkward_boxes(spark, halving):
    rng = random.Random(5)
    for low, high in ((0.0, 360.0), (-1e-3, 7e5), (901.82, 104997.88)):
        points = [(rng.uniform(low, high), rng.choice([1.0, 7.5, 13.25, 50.0])) for _ in range(500)]
        box = box_of(points)
        assert paths(spark, points, box, 10, halving) == [descend(p, box, 10) for p in points]


def test_points_on_real_edges(spark):
    box = Box(0.1, 0.7, -3.3, 9.9)
    xs, ys = G.axis_edges(box.x0, box.x1, 5), G.axis_edges(box.y0, box.y1, 5)
    points = [(float(x), float(y)) for x in xs for y in ys]
    near = [(math.nextafter(x, d), y) for x, y in points for d in (-9, 9)]
    points += [p for p in near if box.x0 <= p[0] <= box.x1]
    assert paths(spark, points, box, 7) == [descend(p, box, 7) for p in points]


def test_axis_without_extent_and_axis_of_neighbouring_numbers(spark):
    flat = [(2.0, float(j)) for j in range(9)]
    assert paths(spark, flat, box_of(flat), 4) == [descend(p, box_of(flat), 4) for p in flat]
    assert paths(spark, [(1.0, 1.0)], Box(1.0, 1.0, 1.0, 1.0), 4) == ["_0000"]
    a = 1.0
    tight = [(a, 0.0), (math.nextafter(a, 2), 1.0), (math.nextafter(math.nextafter(a, 2), 2), 2.0)]
    assert paths(spark, tight, box_of(tight), 6) == [descend(p, box_of(tight), 6) for p in tight]
    for cells in (8, 100, 5000):  # edges a few, and many, representable numbers apart
        xs = [1e6 + k * math.ulp(1e6) for k in range(cells)]
        points = [(v, float(k % 5)) for k, v in enumerate(xs)]
        assert paths(spark, points, box_of(points), 6) == [descend(p, box_of(points), 6) for p in points]


def test_deep_cells_leave_the_edge_table(spark):
    rng = random.Random(6)
    points = [(rng.random(), rng.random()) for _ in range(200)]
    box = box_of(points)
    assert paths(spark, points, box, 20) == [descend(p, box, 20) for p in points]


@pytest.mark.parametrize("halving", [False, True])
def test_points_without_a_cell(spark, halving):
    points = [(float("nan"), 0.5), (None, 0.5), (0.5, None), (-0.1, 0.5), (0.5, 1.1), (float("inf"), 0.0), (1.0, 1.0)]
    assert paths(spark, points, Box(0.0, 1.0, 0.0, 1.0), 2, halving) == [None] * 6 + ["_22"]


def test_ties_at_the_middle(spark):
    box = Box(0.0, 2.0, 0.0, 2.0)
    points = [(1.0, 1.0), (1.0, 0.5), (1.0, 1.5), (0.5, 1.0), (1.5, 1.0)]
    assert paths(spark, points, box, 1) == ["_0", "_0", "_2", "_0", "_1"]


def test_edges_are_repeated_middles():
    edges = G.axis_edges(0.1, 0.9, 3)
    assert edges[4] == (0.1 + 0.9) / 2
    assert edges[3] == (edges[2] + edges[4]) / 2
    assert (np.diff(edges) > 0).all()


def test_depth_is_checked(spark):
    with pytest.raises(ValueError):
        G.with_quad_index(spark.range(1), Box(0, 1, 0, 1), 31, "id", "id")


def test_plan_holds_no_python_and_no_shuffle(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("x"), F.col("id").cast("double").alias("y"))
    plan = G.with_quad_index(df, Box(0.0, 9.0, 0.0, 9.0), 10, "x", "y")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
