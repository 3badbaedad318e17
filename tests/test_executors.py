"""Executors have Spark, numpy and pandas, but not this package."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession, functions as F
from starloom import build_quadtree, merge_cells
from starloom.operators.cluster import fit_lloyd
from starloom.operators.merge import find_runs, group_runs

spark = (
    SparkSession.builder.master("local[2]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2")
    .getOrCreate()
)
df = spark.range(200).select(F.rand(1).alias("x"), F.rand(2).alias("y"))
tree = build_quadtree(df, "x", "y", 20, max_depth=14)
groups = merge_cells(tree.counts(), 30)
assert groups.agg(F.sum("n")).first()[0] == 200
found = find_runs(groups.select("cell"), group_runs(groups)).join(groups, ["cell", "part"]).count()
assert found == groups.count()
assert fit_lloyd(df, "x", "y", [[(0.0, 0.0), (1.0, 1.0)]]).rounds > 1
labels = groups.select("cell", "part")
print("all rows:", tree.assign(df, "x", "y", labels=labels).filter("part is not null").count())
"""


def test_python_tasks_need_no_package(tmp_path):
    repo = str(Path(__file__).resolve().parent.parent)
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=repo)], cwd=tmp_path, capture_output=True, text=True, timeout=300
    )
    assert "all rows: 200" in done.stdout, done.stderr[-2000:]


RECTANGLES = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession, functions as F
from starloom.operators.lookup import find_rectangle

spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
points = spark.range(200).select((F.col("id") / 200).alias("x"), F.lit(0.5).alias("y"))
listed = spark.sql("SELECT 1 AS pos, 'a' AS cell, 0d AS x0, 0.5d AS x1, 0d AS y0, 1d AS y1")
print("held rows:", find_rectangle(points, listed, "x", "y").filter("cell = 'a'").count())
"""


def test_rectangles_need_no_package(tmp_path):
    repo = str(Path(__file__).resolve().parent.parent)
    done = subprocess.run(
        [sys.executable, "-c", RECTANGLES.format(repo=repo)], cwd=tmp_path, capture_output=True, text=True, timeout=300
    )
    assert "held rows: 101" in done.stdout, done.stderr[-2000:]
