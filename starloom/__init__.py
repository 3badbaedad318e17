"""Spatial partitioning of large point catalogues with Spark DataFrames."""

from starloom.functions.geometry import Box
from starloom.operators.bbox import bounding_box, measure_box
from starloom.operators.merge import merge_cells
from starloom.operators.quadtree import QuadTree, build_quadtree
from starloom.operators.uniform import assign_uniform, uniform_cells

__all__ = [
    "Box",
    "QuadTree",
    "assign_uniform",
    "bounding_box",
    "build_quadtree",
    "measure_box",
    "merge_cells",
    "uniform_cells",
]
