"""Bounding box of the points of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.geometry import Box, usable


def bounding_box(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row ``x0, x1, y0, y1``; nulls when there is no usable point."""
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    return df.filter(usable(px, py)).agg(
        F.min(px).alias("x0"), F.max(px).alias("x1"), F.min(py).alias("y0"), F.max(py).alias("y1")
    )


def measure_box(df: DataFrame, x: str, y: str) -> Box | None:
    """The bounding box as four numbers, ``None`` for a table without usable points."""
    row = bounding_box(df, x, y).first()
    return None if row.x0 is None else Box(*row)
