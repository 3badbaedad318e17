import random

import pytest
from pyspark.sql import functions as F
from sample import SAMPLE

from starloom.functions.geometry import Box
from starloom.operators.bbox import bounding_box, measure_box
from starloom.operators.summary import count_per_cell, rows_of_cell
from starloom.operators.uniform import (
    assign_quadrant,
    assign_uniform,
    quadrant_cells,
    rows_of_uniform_cell,
    uniform_cells,
)


def sky(spark):
    return spark.createDataFrame(SAMPLE, "ra double, decl double, object_id long")


def histogram(df):
    return {r.cell: r.n for r in count_per_cell(df).collect()}


def test_bounding_box_of_the_sample(spark):
    assert measure_box(sky(spark), "ra", "decl") == Box(
        4.480710594753096, 358.08941191498536, 2.5352212173711206, 3.2195922508790047
    )


def test_bounding_box_of_a_wide_random_table(spark):
    # Coordinates sit among a hundred columns, as in a full catalogue.
    df = spark.range(1000).select(*[F.rand(seed=k).alias(f"c{k}") for k in range(100)])
    assert [round(v) for v in measure_box(df, "c6", "c8")] == [0, 1, 0, 1]


def test_bounding_box_ignores_unusable_points(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0), (float("nan"), 9.0), (9.0, float("inf")), (None, 1.0), (0.0, 5.0)], "x double, y double"
    )
    assert measure_box(df, "x", "y") == Box(0.0, 1.0, 2.0, 5.0)
    assert measure_box(df.limit(0), "x", "y") is None
    assert bounding_box(df.limit(0), "x", "y").first().x0 is None


def test_sample_histograms(spark):
    df = sky(spark)
    box = measure_box(df, "ra", "decl")
    expected = {
        2: {"00": 10, "01": 10, "11": 10},
        4: {"00": 10, "03": 10, "32": 3, "33": 7},
        8: {"00": 9, "01": 1, "07": 10, "75": 3, "76": 5, "77": 2},
    }
    for n, cells in expected.items():
        assert histogram(assign_uniform(df, box, n, "ra", "decl")) == cells


def test_quadrants_of_the_sample_are_all_kept(spark):
    df = sky(spark)
    box = measure_box(df, "ra", "decl")
    assert histogram(assign_quadrant(df, box, "ra", "decl")) == {"1": 10, "3": 10, "4": 10}
    rects = {r.cell: (r.x0, r.x1, r.y0, r.y1) for r in quadrant_cells(spark, Box(0.0, 2.0, 0.0, 4.0)).collect()}
    assert rects == {
        "1": (0.0, 1.0, 0.0, 2.0),
        "2": (1.0, 2.0, 0.0, 2.0),
        "3": (1.0, 2.0, 2.0, 4.0),
        "4": (0.0, 1.0, 2.0, 4.0),
    }


def test_first_rectangle_in_scan_order_wins(spark):
    rng = random.Random(1)
    box, n = Box(0.1, 0.7, -2.0, 5.0), 7
    sx, sy = (box.x1 - box.x0) / n, (box.y1 - box.y0) / n
    xs = [box.x0 + k * sx for k in range(n)] + [box.x1] + [rng.uniform(0.1, 0.7) for _ in range(20)]
    ys = [box.y0 + k * sy for k in range(n)] + [box.y1] + [rng.uniform(-2, 5) for _ in range(20)]
    points = [(x, y) for x in xs for y in ys]

    def model(x, y):
        def slot(v, low, step):
            return next((k for k in range(n) if low + k * step <= v <= low + (k + 1) * step), n - 1)

        return f"{slot(x, box.x0, sx)}{slot(y, box.y0, sy)}"

    df = spark.createDataFrame(points, "x double, y double")
    got = {(r.x, r.y): r.cell for r in assign_uniform(df, box, n, "x", "y").collect()}
    assert got == {p: model(*p) for p in points}


def test_the_maximum_is_never_lost(spark):
    rng = random.Random(2)
    boxes = [tuple(sorted(rng.uniform(-1e3, 1e3) for _ in range(2))) for _ in range(40)]
    for low, high in boxes:
        df = spark.createDataFrame([(high, high)], "x double, y double")
        assert assign_uniform(df, Box(low, high, low, high), 9, "x", "y").first().cell == "88"


def test_names_and_rows_without_a_cell(spark):
    cells = [r.cell for r in uniform_cells(spark, Box(0.0, 1.0, 0.0, 1.0), 12).collect()]
    assert len(set(cells)) == 144 and "1_10" in cells and "11_0" in cells
    df = spark.createDataFrame([(2.0, 0.5), (None, 0.5), (float("nan"), 0.5), (0.5, 0.5)], "x double, y double")
    tagged = assign_uniform(df, Box(0.0, 1.0, 0.0, 1.0), 2, "x", "y")
    assert [r.cell for r in tagged.collect()] == ["-1", "-1", "-1", "00"]
    assert rows_of_cell(tagged, "00").count() == 1


def test_flat_axis(spark):
    df = spark.createDataFrame([(1.0, float(k)) for k in range(4)], "x double, y double")
    assert histogram(assign_uniform(df, Box(1.0, 1.0, 0.0, 3.0), 3, "x", "y")) == {"00": 2, "01": 1, "02": 1}


def test_rectangles(spark):
    rects = {r.cell: (r.x0, r.x1, r.y0, r.y1) for r in uniform_cells(spark, Box(0.0, 4.0, 0.0, 8.0), 4).collect()}
    assert len(rects) == 16 and rects["12"] == (1.0, 2.0, 4.0, 6.0)


def test_rows_of_a_cell_are_filtered_in_the_scan(spark, tmp_path):
    points = [(k * 0.1, m * 0.3) for k in range(31) for m in range(11)]
    spark.createDataFrame(points, "x double, y double").write.parquet(str(tmp_path / "points"))
    df = spark.read.parquet(str(tmp_path / "points"))
    box = measure_box(df, "x", "y")
    whole = assign_uniform(df, box, 4, "x", "y")
    for i, j in ((0, 0), (1, 2), (3, 3)):
        got = rows_of_uniform_cell(df, box, 4, i, j, "x", "y")
        assert sorted(got.collect()) == sorted(rows_of_cell(whole, f"{i}{j}").collect())
        assert "GreaterThanOrEqual(x," in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    ("low", "high", "n"),
    [(1e15, 1e15 + 4, 1000), (1e15, 1e15 + 4, 10_000), (-1e16, -1e16 + 64, 7), (0.1, 0.7, 10_000), (3.0, 3.0000000000000004, 9)],
)
def test_edges_that_fall_together(spark, low, high, n):
    rng = random.Random(3)
    step = (high - low) / n
    edges = [low + k * step for k in range(n + 1)]
    values = sorted({low, high, *(min(high, low + (high - low) * rng.random()) for _ in range(60)), *rng.sample(edges[:-1], min(n, 40))})

    def slot(v):
        return next((k for k in range(n) if edges[k] <= v <= edges[k + 1]), n - 1)

    df = spark.createDataFrame([(v, 0.5) for v in values], "x double, y double")
    got = {r.x: r.cell for r in assign_uniform(df, Box(low, high, 0.0, 1.0), n, "x", "y").collect()}
    assert {v: c.split("_")[0] if n > 10 else c[0] for v, c in got.items()} == {v: str(slot(v)) for v in values}


def test_tables_without_points(spark):
    df = spark.createDataFrame([], "x double, y double")
    assert assign_uniform(df, None, 4, "x", "y").columns == assign_quadrant(df, None, "x", "y").columns
    assert uniform_cells(spark, None, 4).count() == quadrant_cells(spark, None).count() == 0
