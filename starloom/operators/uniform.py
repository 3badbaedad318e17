"""Uniform n x n grid, and the one-level split into quadrants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.geometry import Box, inside, quadrant, quarters, uniform_index, uniform_name

NO_CELL = "-1"


def _no_cells(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "cell string, x0 double, x1 double, y0 double, y1 double")


def uniform_cells(spark: SparkSession, box: Box | None, n: int) -> DataFrame:
    """The n * n rectangles ``cell, x0, x1, y0, y1``, x index first in the name; none without a box."""
    if box is None:
        return _no_cells(spark)
    sx, sy = (box.x1 - box.x0) / n, (box.y1 - box.y0) / n
    at = spark.range(n * n).select(
        F.floor(F.col("id") / n).cast("int").alias("i"), (F.col("id") % n).cast("int").alias("j")
    )
    i, j = F.col("i"), F.col("j")
    return at.select(
        uniform_name(i, j, n).alias("cell"),
        (F.lit(box.x0) + i * F.lit(sx)).alias("x0"),
        (F.lit(box.x0) + (i + 1) * F.lit(sx)).alias("x1"),
        (F.lit(box.y0) + j * F.lit(sy)).alias("y0"),
        (F.lit(box.y0) + (j + 1) * F.lit(sy)).alias("y1"),
    )


def assign_uniform(df: DataFrame, box: Box | None, n: int, x: str, y: str, cell: str = "cell") -> DataFrame:
    """Tag each row with its grid cell; rows outside the box, or without one, get ``-1``.

    The index is arithmetic, so there is no grid to join with and nothing to shuffle.
    """
    if box is None:
        return df.withColumn(cell, F.lit(NO_CELL))
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    name = uniform_name(uniform_index(px, box.x0, box.x1, n), uniform_index(py, box.y0, box.y1, n), n)
    return df.withColumn(cell, F.when(inside(px, py, box), name).otherwise(F.lit(NO_CELL)))


def rows_of_uniform_cell(
    df: DataFrame, box: Box, n: int, i: int, j: int, x: str, y: str, cell: str = "cell"
) -> DataFrame:
    """Tagged rows of cell (i, j). Its closed rectangle is a filter that reaches the scan."""

    def slice_of(value: str, low: float, high: float, at: int) -> Column:
        step = (high - low) / n
        upper = high if at == n - 1 else low + (at + 1) * step
        return F.col(value).between(low + at * step, max(upper, low + (at + 1) * step))

    near = df.filter(slice_of(x, box.x0, box.x1, i) & slice_of(y, box.y0, box.y1, j))
    return assign_uniform(near, box, n, x, y, cell).filter(F.col(cell) == uniform_name(F.lit(i), F.lit(j), n))


def quadrant_cells(spark: SparkSession, box: Box | None) -> DataFrame:
    """The four quadrants of the box, named 1 to 4 counter-clockwise from the low corner; none without a box."""
    if box is None:
        return _no_cells(spark)
    parts = quarters(*[F.lit(float(v)) for v in box])
    return spark.range(1).select(F.posexplode(parts).alias("at", "rect")).select(
        (F.col("at") + 1).cast("string").alias("cell"), "rect.*"
    )


def assign_quadrant(df: DataFrame, box: Box | None, x: str, y: str, cell: str = "cell") -> DataFrame:
    """Tag each row with its quadrant, 1 to 4; rows outside the box, or without one, get ``-1``."""
    if box is None:
        return df.withColumn(cell, F.lit(NO_CELL))
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    at = quadrant(px, py, (box.x0 + box.x1) / 2, (box.y0 + box.y1) / 2) + 1
    return df.withColumn(cell, F.when(inside(px, py, box), at.cast("string")).otherwise(F.lit(NO_CELL)))
