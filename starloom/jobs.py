"""Whole jobs: from the files of a catalogue to one directory of lines per partition.

``definition`` is the path of the table definition, ``files`` a file, folder or glob, and
``x`` and ``y`` are column names from the definition. The text is cut twice, once for the
coordinates and once for the rows; other passes read the stored coordinates, which are
removed at the end. An empty catalogue gives an empty result.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import session
from starloom.functions.geometry import DEEPEST
from starloom.operators.bbox import measure_box
from starloom.operators.cluster import cluster_sizes, draw_starts, fit_lloyd, nearest_centre
from starloom.operators.grow import split_again, with_empty_leaves, with_more_rows
from starloom.operators.lookup import load_tree, store_tree
from starloom.operators.merge import merge_cells
from starloom.operators.quadtree import QuadTree, build_quadtree
from starloom.operators.summary import count_per_cell, rows_of_size
from starloom.operators.uniform import assign_quadrant, assign_uniform
from starloom.sinks.cells import read_lines, store_groups, write_text
from starloom.sources import catalogue, ddl

# Most rows of one output file, unless the caller says otherwise.
FILE_ROWS = 1_000_000


def _lines(spark: SparkSession, definition: str, files: str, x: str, y: str) -> DataFrame:
    positions = ddl.column_positions(ddl.read_ddl(spark, definition))
    return catalogue.read_lines(spark, files, positions, x, y)


def partition_uniform(
    spark: SparkSession, definition: str, files: str, out: str, x: str, y: str, n: int, file_rows: int = FILE_ROWS
) -> DataFrame:
    """Uniform n x n grid; the written ``data, cell``."""
    lines = _lines(spark, definition, files, x, y)
    tagged = assign_uniform(lines, measure_box(lines, "x", "y"), n, "x", "y")
    write_text(tagged, out, file_rows, F.col("data"))
    return read_lines(spark, out)


def partition_quadrants(
    spark: SparkSession, definition: str, files: str, out: str, x: str, y: str, file_rows: int = FILE_ROWS
) -> DataFrame:
    """One directory for each of the four quadrants of the box; the written ``data, cell``."""
    lines = _lines(spark, definition, files, x, y)
    tagged = assign_quadrant(lines, measure_box(lines, "x", "y"), "x", "y")
    write_text(tagged, out, file_rows, F.col("data"))
    return read_lines(spark, out)


def partition_quadtree(
    spark: SparkSession,
    definition: str,
    files: str,
    out: str,
    x: str,
    y: str,
    threshold: int,
    max_depth: int = DEEPEST,
    file_rows: int = FILE_ROWS,
) -> DataFrame:
    """One directory per quadtree leaf; the written ``data, cell``. The split is stored beside it."""
    lines = _lines(spark, definition, files, x, y)
    with session.released(spark):
        points = session.stored(lines.select("x", "y"), "points")
        tree = build_quadtree(points, "x", "y", threshold, max_depth)
        write_text(tree.assign(lines, "x", "y"), out, file_rows, F.col("data"))
        store_tree(tree, f"{out}/_split")
    return read_lines(spark, out)


def add_lines(
    spark: SparkSession, definition: str, files: str, out: str, x: str, y: str, file_rows: int = FILE_ROWS
) -> DataFrame:
    """Add a delivery to what :func:`partition_quadtree` wrote; the written ``data, cell``.

    The partitions are then those of a split of all rows together in the box of the first delivery. New lines are
    appended to their leaves; leaves that are now above the threshold are read again, cut, and replaced
    by directories of their own, and no other file is touched. Lines outside the box have no cell.
    The new files are complete before an old directory is removed and the split is stored last, so
    a job that fails can be told by a directory that is no leaf of the stored split.
    """
    positions = ddl.column_positions(ddl.read_ddl(spark, definition))
    with session.released(spark):
        tree = load_tree(spark, f"{out}/_split")
        lines = catalogue.read_lines(spark, files, positions, x, y)
        if tree.box is None:
            write_text(tree.assign(lines, "x", "y"), out, file_rows, F.col("data"), mode="append")
            return read_lines(spark, out)
        whole = with_empty_leaves(tree)
        tagged = session.stored(whole.assign(lines, "x", "y"), "tagged")
        grown, heavy = with_more_rows(whole, count_per_cell(tagged.filter("cell is not null")))
        names = heavy.select("cell")
        write_text(session.join_cell_table(tagged, names, "cell", "left_anti"), out, file_rows, F.col("data"), mode="append")
        if not names.isEmpty():
            # Only the directories of these leaves are listed and read; one that was empty has none.
            held = names.join(tree.cells.filter("n > 0").select("cell"), "cell", "left_semi")
            paths = [f"{out}/cell={row.cell}" for row in held.collect()]  # one per leaf that is cut
            old = read_lines(spark, out, paths=paths)
            old = catalogue.cut_again(old, positions, x, y).select("data", "x", "y")
            rows = old.unionByName(session.join_cell_table(tagged, names, "cell", "left_semi").select("data", "x", "y"))
            rows = session.stored(rows, "heavy")
            grown, part = split_again(grown, rows, "x", "y")
            write_text(part.assign(rows, "x", "y"), out, file_rows, F.col("data"), mode="append")
            session.remove(spark, *paths)
        held = replace(grown, cells=grown.cells.filter("n > 0"))
        held = replace(held, leaf_depths=_leaf_depths(held))
        store_tree(held, f"{out}/_split", mode="overwrite")
    return read_lines(spark, out)


def _leaf_depths(tree: QuadTree) -> dict[int, int]:
    counts = tree.leaves().groupBy("depth").agg(F.count("*").alias("leaves")).collect()
    return {r["depth"]: r["leaves"] for r in counts}


def partition_merged(
    spark: SparkSession,
    definition: str,
    files: str,
    out: str,
    x: str,
    y: str,
    minimum: int,
    threshold: int | None = None,
    max_depth: int = DEEPEST,
    max_heavy_cells: int | None = None,
    file_rows: int = FILE_ROWS,
) -> DataFrame:
    """One directory per group of merged leaves; the written ``data, part``.

    Without a threshold it is the number of rows that fill a block. ``max_heavy_cells``
    stops the splitting early and leaves cells above the threshold; there is no such stop
    unless it is asked for. A directory bears the name of the first leaf of its group,
    ``part``; which leaves belong to it is kept in a table beside the split, from which
    ``sinks.cells.read_groups`` makes the whole ids.
    """
    lines = _lines(spark, definition, files, x, y)
    with session.released(spark):
        points = session.stored(lines.select("x", "y", F.octet_length("data").alias("size")), "points")
        if threshold is None:
            threshold = rows_of_size(points, "size").first().rows_per_file or 1
        tree = build_quadtree(points, "x", "y", threshold, max_depth, max_heavy_cells)
        store_tree(tree, f"{out}/_split")
        groups = store_groups(merge_cells(tree.counts(), minimum), out)
        tagged = tree.assign(lines, "x", "y", labels=groups.select("cell", "part"))
        write_text(tagged, out, file_rows, F.col("data"), "part", mode="append")
    return read_lines(spark, out, "part")


def place_lines(spark: SparkSession, definition: str, files: str, out: str, x: str, y: str) -> DataFrame:
    """New lines ``data, x, y`` with the leaf of a split written earlier, and its group if it was merged."""
    tree = load_tree(spark, f"{out}/_split")
    return tree.assign(_lines(spark, definition, files, x, y), "x", "y")


def cluster_catalogue(
    spark: SparkSession, definition: str, files: str, x: str, y: str, k: int = 10, seed: int = 0, starts: int = 1
) -> DataFrame:
    """Sizes of the k-means clusters of a catalogue, smallest first, of the best of several random starts."""
    with session.released(spark):
        points = session.stored(_lines(spark, definition, files, x, y).select("x", "y"), "points")
        if measure_box(points, "x", "y") is None:
            return spark.createDataFrame([], "cluster int, n long")
        best = fit_lloyd(points, "x", "y", draw_starts(points, "x", "y", k, starts, seed=seed))
        sizes = cluster_sizes(nearest_centre(points, best.centres, "x", "y"))
        rows = [(row["cluster"], row["n"]) for row in sizes.collect()]  # one per cluster
    return spark.createDataFrame(rows, "cluster int, n long").orderBy("n", "cluster")
