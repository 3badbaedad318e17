"""A split that takes in more rows: only leaves that have become too heavy are split again."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom import session
from starloom.functions.geometry import quad_path
from starloom.operators.quadtree import QuadTree, build_quadtree

PLACE = ["depth", "qx", "qy"]


def with_empty_leaves(tree: QuadTree) -> QuadTree:
    """The same split with the leaves that hold no rows, so that every point of the box has a leaf."""
    half = F.explode(F.array(F.lit(0), F.lit(1)))
    inner = tree.cells.filter((F.col("n") > tree.threshold) & (F.col("depth") < tree.stop)).select(*PLACE)
    children = inner.withColumn("_i", half).withColumn("_j", half).select(
        (F.col("depth") + 1).alias("depth"), (F.col("qx") * 2 + F.col("_i")).alias("qx"), (F.col("qy") * 2 + F.col("_j")).alias("qy")
    )
    empty = children.join(tree.cells.select(*PLACE), PLACE, "left_anti")
    empty = empty.select(*PLACE, quad_path(*map(F.col, PLACE)).alias("cell"), F.lit(0).cast("long").alias("n"))
    return _of_cells(tree, tree.cells.unionByName(empty))


def _of_cells(tree: QuadTree, cells: DataFrame) -> QuadTree:
    cells = session.cut_lineage(cells)
    leaf = (F.col("n") <= tree.threshold) | (F.col("depth") == tree.stop)
    depths = cells.filter(leaf).groupBy("depth").agg(F.count("*").alias("leaves")).collect()
    return replace(tree, cells=cells, leaf_depths={r["depth"]: r["leaves"] for r in depths})


def with_more_rows(tree: QuadTree, counts: DataFrame) -> tuple[QuadTree, DataFrame]:
    """Count more rows in, ``cell, n`` per leaf; the split before any further cut, and its leaves that need one.

    ``tree`` has all its leaves (:func:`with_empty_leaves`). The rows count in a leaf and in all cells above it.
    The second table is ``depth, qx, qy, cell``.
    """
    placed = counts.withColumnRenamed("n", "more").join(tree.cells.select("cell", *PLACE), "cell")
    above = placed.withColumn("top", F.explode(F.sequence(F.lit(0), F.col("depth"))))
    shifted = [F.expr(f"shiftright({c}, depth - top)").alias(c) for c in ("qx", "qy")]
    added = above.select(F.col("top").alias("depth"), *shifted, "more").groupBy(*PLACE).agg(F.sum("more").alias("more"))
    grown = tree.cells.join(added, PLACE, "left")
    grown = grown.select(*PLACE, "cell", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"), F.col("n").alias("_n"))
    grown = session.cut_lineage(grown)
    heavy = grown.filter(
        (F.col("_n") <= tree.threshold) & (F.col("n") > tree.threshold) & (F.col("depth") < tree.stop)
    ).select(*PLACE, "cell")
    return _of_cells(tree, grown.drop("_n")), session.cut_lineage(heavy)


def split_again(tree: QuadTree, rows: DataFrame, x: str, y: str) -> tuple[QuadTree, QuadTree]:
    """Cut the leaves that ``rows``, all rows of the leaves that are too heavy, lie in.

    The first result is the whole split, the second one that of the rows alone: every cell above one of those
    leaves has more rows than the leaf, so it is cut there too, and below them nothing else counts.
    """
    part = build_quadtree(rows, x, y, tree.threshold, tree.stop, box=tree.box)
    finer = part.cells.join(tree.cells.select(*PLACE), PLACE, "left_anti")
    return _of_cells(tree, tree.cells.unionByName(finer.select(*tree.cells.columns))), part
