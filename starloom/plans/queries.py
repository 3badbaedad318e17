"""Queries over the given tables.

``lineitem`` serves as the catalogue: price and quantity are the coordinates, the part is
the object and the order the source. ``embeddings`` gives continuous coordinates, and
``events`` dense regions (small values) next to sparse ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import jobs, session
from starloom.functions.geometry import Box, path_box, quad_path, squared_distance, with_quad_index
from starloom.functions.text import csv_line
from starloom.operators import cluster, lookup, summary, uniform
from starloom.operators.bbox import bounding_box, measure_box
from starloom.operators.lookup import find_rectangle
from starloom.operators.merge import find_runs, group_runs, id_pages, merge_cells, retag, whole_ids
from starloom.operators.quadtree import QuadTree, build_quadtree, cell_pyramid, count_cells, heavy_rows, split_step
from starloom.operators.ranges import decode_ranges, partition_report, report_lines
from starloom.plans import settings as S
from starloom.sinks import cells as sinks
from starloom.sources import catalogue, ddl

X, Y = "l_extendedprice", "l_quantity"
KEYS = ("l_orderkey", "l_linenumber", "l_partkey")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "lineitem")


def _points(spark: SparkSession, folder: str) -> DataFrame:
    return catalogue.points(_lineitem(spark, folder), X, Y, *KEYS)


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return catalogue.points(
        vectors.select("vec_id", F.get("embedding", F.lit(0)).alias("u"), F.get("embedding", F.lit(1)).alias("v")),
        "u",
        "v",
        "vec_id",
    )


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return catalogue.points(_table(spark, folder, "events"), "value", "user_id", "event_id")


def _event_tree(points: DataFrame) -> QuadTree:
    return build_quadtree(points, "x", "y", S.EVENT_THRESHOLD, S.EVENT_DEPTH)


def _tree(points: DataFrame) -> QuadTree:
    return build_quadtree(points, "x", "y", S.THRESHOLD)


# Bounding box and uniform grid


def bbox(spark: SparkSession, folder: str) -> DataFrame:
    return bounding_box(_lineitem(spark, folder), X, Y)


def uniform_cells(spark: SparkSession, folder: str) -> DataFrame:
    return uniform.uniform_cells(spark, measure_box(_lineitem(spark, folder), X, Y), S.GRID)


def _uniform(spark: SparkSession, folder: str, n: int = S.GRID) -> DataFrame:
    points = _points(spark, folder)
    return uniform.assign_uniform(points, measure_box(points, "x", "y"), n, "x", "y")


def uniform_assign(spark: SparkSession, folder: str) -> DataFrame:
    return _uniform(spark, folder)


def uniform_hist(spark: SparkSession, folder: str) -> DataFrame:
    return summary.count_per_cell(_uniform(spark, folder))


def uniform_hist_wide(spark: SparkSession, folder: str) -> DataFrame:
    return summary.count_per_cell(_uniform(spark, folder, S.WIDE_GRID))


def cell_rows(spark: SparkSession, folder: str) -> DataFrame:
    points = _points(spark, folder)
    box = measure_box(points, "x", "y")
    return uniform.rows_of_uniform_cell(points, box, S.GRID, 3, 7, "x", "y")


# Quadrants and quadtree


def quadrant_cells(spark: SparkSession, folder: str) -> DataFrame:
    return uniform.quadrant_cells(spark, measure_box(_lineitem(spark, folder), X, Y))


def quadrants(spark: SparkSession, folder: str) -> DataFrame:
    points = _points(spark, folder)
    return uniform.assign_quadrant(points, measure_box(points, "x", "y"), "x", "y")


def quad_paths(spark: SparkSession, folder: str) -> DataFrame:
    points = _points(spark, folder)
    indexed = with_quad_index(points, measure_box(points, "x", "y"), S.PATH_DEPTH, "x", "y")
    return indexed.select(
        *points.columns, quad_path(F.lit(S.PATH_DEPTH), F.col("qx"), F.col("qy")).alias("cell")
    )


def grid_step(spark: SparkSession, folder: str) -> DataFrame:
    points = _points(spark, folder)
    box = measure_box(points, "x", "y")
    counts = count_cells(points, box, S.STEP_GRID_DEPTH, "x", "y")
    named = counts.select(
        quad_path(F.lit(S.STEP_GRID_DEPTH), F.col("qx"), F.col("qy")).alias("cell"), "n"
    )
    cells = named.withColumn("rect", path_box(F.substring("cell", 2, 64), box)).select("cell", "n", "rect.*")
    return split_step(cells, S.STEP_THRESHOLD)


def level_counts(spark: SparkSession, folder: str) -> DataFrame:
    points = _points(spark, folder)
    counts = count_cells(points, measure_box(points, "x", "y"), S.PATH_DEPTH, "x", "y")
    levels = cell_pyramid(counts, 0, S.PATH_DEPTH)
    return levels.select(quad_path(F.col("depth"), F.col("qx"), F.col("qy")).alias("cell"), "depth", "n")


def quadtree_leaves(spark: SparkSession, folder: str) -> DataFrame:
    return _tree(_points(spark, folder)).leaves()


def quadtree_capped(spark: SparkSession, folder: str) -> DataFrame:
    return build_quadtree(
        _points(spark, folder), "x", "y", S.CAPPED_THRESHOLD, S.MAX_DEPTH, S.MAX_HEAVY_CELLS
    ).leaves()


def quadtree_assign(spark: SparkSession, folder: str) -> DataFrame:
    points = _points(spark, folder)
    return _tree(points).assign(points, "x", "y")


def quadtree_vectors(spark: SparkSession, folder: str) -> DataFrame:
    points = _vectors(spark, folder)
    return build_quadtree(points, "x", "y", S.VECTOR_THRESHOLD).assign(points, "x", "y")


def quadtree_events(spark: SparkSession, folder: str) -> DataFrame:
    points = _events(spark, folder)
    return _event_tree(points).assign(points, "x", "y")


def event_leaves(spark: SparkSession, folder: str) -> DataFrame:
    return _event_tree(_events(spark, folder)).leaves()


def unfinished_rows(spark: SparkSession, folder: str) -> DataFrame:
    points = _events(spark, folder)
    return heavy_rows(points, _event_tree(points), S.HEAVY_DEPTH, "x", "y")


# Merging and ranges


def _merged(tree: QuadTree, minimum: int = S.MINIMUM) -> DataFrame:
    return session.cut_lineage(merge_cells(tree.counts(), minimum))


def _with_ids(rows: DataFrame, merged: DataFrame) -> DataFrame:
    """Rows with the whole id of their group instead of its short name."""
    return session.join_cell_table(rows, session.cut_lineage(whole_ids(merged)), "part", "left").drop("part")


def _named(merged: DataFrame) -> DataFrame:
    """Every cell with the whole id and the size of its group."""
    runs = group_runs(merged).select("part", "group_n")
    return _with_ids(merged.join(runs, "part"), merged).select("id_part", "cell", "n", "group_n")


def merged_cells(spark: SparkSession, folder: str) -> DataFrame:
    return _named(_merged(_tree(_points(spark, folder))))


def merged_vectors(spark: SparkSession, folder: str) -> DataFrame:
    tree = build_quadtree(_vectors(spark, folder), "x", "y", S.VECTOR_THRESHOLD)
    return _named(_merged(tree, S.VECTOR_MINIMUM))


def merged_events(spark: SparkSession, folder: str) -> DataFrame:
    return _named(_merged(_event_tree(_events(spark, folder)), S.EVENT_MINIMUM))


def merged_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Groups above the split threshold by far, as runs of leaves: no two neighbours are full."""
    return group_runs(_merged(_tree(_points(spark, folder)), S.LARGE_MINIMUM)).drop("start")


def merged_id_pages(spark: SparkSession, folder: str) -> DataFrame:
    return id_pages(_merged(_event_tree(_events(spark, folder)), S.EVENT_MINIMUM), S.PAGE_MEMBERS)


def merged_assign(spark: SparkSession, folder: str) -> DataFrame:
    points = _points(spark, folder)
    tree = _tree(points)
    merged = _merged(tree)
    tagged = tree.assign(points, "x", "y", labels=merged.select("cell", "part"))
    return _with_ids(tagged.drop("cell"), merged)


def merged_retag(spark: SparkSession, folder: str) -> DataFrame:
    points = _points(spark, folder)
    tree = _tree(points)
    merged = _merged(tree)
    return _with_ids(retag(tree.assign(points, "x", "y"), merged), merged)


def found_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Cells of the finest counted level, most of them no leaves, with the run of leaves they lie in."""
    points = _points(spark, folder)
    tree = _tree(points)
    counts = count_cells(points, tree.box, S.PATH_DEPTH, "x", "y")
    cells = counts.select(quad_path(F.lit(S.PATH_DEPTH), F.col("qx"), F.col("qy")).alias("cell"))
    return find_runs(cells, group_runs(_merged(tree)))


def merged_ranges(spark: SparkSession, folder: str) -> DataFrame:
    tree = _tree(_points(spark, folder))
    return decode_ranges(whole_ids(_merged(tree)).select("id_part"), tree.box)


def merged_report(spark: SparkSession, folder: str) -> DataFrame:
    tree = _tree(_points(spark, folder))
    return partition_report(whole_ids(_merged(tree)).select("id_part"), tree.box, "x", "y")


def merged_report_lines(spark: SparkSession, folder: str) -> DataFrame:
    tree = _tree(_points(spark, folder))
    return report_lines(_merged(tree), tree.box, "x", "y")


def block_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """The whole job: threshold from the block size, split, merge, rows per partition."""
    rows = _lineitem(spark, folder)
    threshold = summary.rows_per_file(rows, csv_line(rows.columns), S.SMALL_BLOCK_BYTES).first().rows_per_file
    tree = build_quadtree(rows, X, Y, threshold)
    merged = _merged(tree, S.BLOCK_MINIMUM)
    tagged = tree.assign(rows, X, Y, labels=merged.select("cell", "part"))
    return _with_ids(summary.count_per_cell(tagged, "part"), merged)


# Listings and summaries


def cell_balance(spark: SparkSession, folder: str) -> DataFrame:
    rows = _lineitem(spark, folder)
    tree = build_quadtree(rows, X, Y, S.THRESHOLD)
    return summary.cell_balance(tree.assign(rows, X, Y), csv_line(rows.columns))


def csv_lines(spark: SparkSession, folder: str) -> DataFrame:
    rows = _lineitem(spark, folder)
    return rows.select(csv_line(rows.columns).alias("line"))


def cell_text(spark: SparkSession, folder: str) -> DataFrame:
    tagged = _uniform(spark, folder)
    return summary.text_per_cell(tagged, [*KEYS, "x", "y"], S.PAGE_ROWS)


def cell_collect(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of every page."""
    rows = summary.paged_lines(_uniform(spark, folder), [*KEYS, "x", "y"], S.PAGE_ROWS)
    return rows.select("cell", "page", "piece", F.explode("lines").alias("line"))


def rows_per_file(spark: SparkSession, folder: str) -> DataFrame:
    rows = _lineitem(spark, folder)
    return summary.rows_per_file(rows, csv_line(rows.columns))


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return summary.object_records(_lineitem(spark, folder), "l_partkey", "l_orderkey", X, Y)


def object_records(spark: SparkSession, folder: str) -> DataFrame:
    return _records(spark, folder)


def object_summary(spark: SparkSession, folder: str) -> DataFrame:
    return summary.object_summary(_records(spark, folder))


def cell_index(spark: SparkSession, folder: str) -> DataFrame:
    return summary.index_cells(_tree(_points(spark, folder)).counts())


def distinct_cells(spark: SparkSession, folder: str) -> DataFrame:
    points = _points(spark, folder)
    return summary.distinct_cells(_tree(points).assign(points, "x", "y"))


def sorted_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _tree(_points(spark, folder)).counts().orderBy("cell")


def unwritten_rows(spark: SparkSession, folder: str) -> DataFrame:
    points = _points(spark, folder)
    tree = _tree(points)
    written = tree.counts().filter(F.col("n") >= S.WRITTEN_ROWS)
    return summary.unwritten_rows(tree.assign(points, "x", "y"), written)


def first_rows(spark: SparkSession, folder: str) -> DataFrame:
    return summary.first_rows(_points(spark, folder), S.FIRST_ROWS, *KEYS, "x", "y")


# Clusters


def _centres(points: DataFrame) -> list[tuple[float, float]]:
    """The coordinates of the first few rows."""
    rows = summary.first_rows(points, S.CLUSTERS, *KEYS, "x", "y").select("x", "y").collect()
    return [(r.x, r.y) for r in rows]


def cluster_assign(spark: SparkSession, folder: str) -> DataFrame:
    points = _points(spark, folder)
    return cluster.nearest_centre(points, _centres(points), "x", "y")


def cluster_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return cluster.cluster_sizes(cluster_assign(spark, folder))


def cluster_fit(spark: SparkSession, folder: str) -> DataFrame:
    points = _points(spark, folder)
    model = cluster.fit_clusters(points, "x", "y", S.CLUSTERS, seed=1)
    return cluster.cluster_sizes(cluster.predict_clusters(points, model, "x", "y"))


def cluster_check(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold for any fitted model: every row counted once, at the nearest returned centre."""
    points = _points(spark, folder)
    model = cluster.fit_clusters(points, "x", "y", S.CLUSTERS, seed=1)
    centres = [tuple(map(float, c)) for c in model.clusterCenters()]
    found = cluster.predict_clusters(points, model, "x", "y")
    far = [squared_distance(F.col("x"), F.col("y"), cx, cy) for cx, cy in centres]
    own = F.coalesce(*[F.when(F.col("cluster") == k, d) for k, d in enumerate(far)])
    return found.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("cluster").isNull()).alias("unplaced"),
        F.count_if(own > F.least(*far)).alias("misplaced"),
        F.lit(len(set(centres))).cast("long").alias("centres"),
        (F.max("cluster") < S.CLUSTERS).alias("numbered"),
    )


def cluster_starts(spark: SparkSession, folder: str) -> DataFrame:
    """The best of several starts after all rounds: its centres and their sizes."""
    points = _points(spark, folder)
    starts = cluster.draw_starts(points, "x", "y", S.CLUSTERS, S.STARTS, *KEYS)
    best = cluster.fit_lloyd(points, "x", "y", starts, S.ROUNDS, S.SUM_SCALE)
    centres = [(best.start, k, *centre) for k, centre in enumerate(best.centres)]
    table = spark.createDataFrame(centres, "start int, cluster int, cx double, cy double")
    sizes = cluster.cluster_sizes(cluster.nearest_centre(points, best.centres, "x", "y"))
    return table.join(sizes, "cluster", "left").select("start", "cluster", "cx", "cy", F.coalesce("n", F.lit(0)).alias("n"))


# Lookup in partitions that are there


def _rectangles(spark: SparkSession, folder: str) -> DataFrame:
    """A list in which later rectangles overlap earlier ones: the quadrants after four cells of a grid."""
    box = measure_box(_lineitem(spark, folder), X, Y)
    inner = uniform.uniform_cells(spark, box, 4).filter(F.col("cell").isin("11", "12", "21", "22"))
    whole = uniform.quadrant_cells(spark, box).filter("cell <> '4'")
    listed = inner.withColumn("cell", F.concat(F.lit("g"), "cell")).unionByName(
        whole.withColumn("cell", F.concat(F.lit("q"), "cell"))
    )
    return listed.select(F.col("cell").alias("pos"), "cell", "x0", "x1", "y0", "y1")


def given_rectangles(spark: SparkSession, folder: str) -> DataFrame:
    """Rows tagged by a given list of rectangles; some rows lie in none."""
    return find_rectangle(_points(spark, folder), _rectangles(spark, folder), "x", "y")


def nested_rectangles(spark: SparkSession, folder: str) -> DataFrame:
    """Rows tagged by the extents of the parts and suppliers, most of them large and within each other."""
    rows = _lineitem(spark, folder)
    edges = [F.min(X).alias("x0"), F.max(X).alias("x1"), F.min(Y).alias("y0"), F.max(Y).alias("y1")]
    extents = [
        rows.groupBy(F.concat(F.lit(kind), F.col(key).cast("string")).alias("cell")).agg(*edges)
        for kind, key in (("p", "l_partkey"), ("s", "l_suppkey"))
    ]
    # The smallest one that holds a row comes first.
    area = F.round((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")) * 100).cast("long")
    listed = extents[0].unionByName(extents[1]).withColumn("pos", F.struct(area.alias("area"), "cell"))
    return find_rectangle(_points(spark, folder), listed, "x", "y")


def placed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """All rows placed into a split that was built on some of them and stored."""
    points = _points(spark, folder)
    path = session.fresh_path(spark, "split")
    lookup.store_tree(build_quadtree(points.filter("l_linenumber > 1"), "x", "y", S.THRESHOLD), path)
    return lookup.load_tree(spark, path).assign(points, "x", "y")


# Files


def _catalogue_rows(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem with text dates, and a column in which some values are missing."""
    rows = _lineitem(spark, folder).withColumn("l_shipdate", F.col("l_shipdate").cast("string"))
    return rows.withColumn("taxed", F.when(F.col("l_tax") > 0, F.col("l_tax")))


# Definition types that hold the values of each Spark type.
DDL_TYPES = {"bigint": "NUMBER(19, 0)", "int": "NUMBER(10, 0)", "double": "FLOAT (24)", "string": "char(19)"}


def _store_files(spark: SparkSession, rows: DataFrame, columns: list[str]) -> tuple[str, str]:
    """Write rows as headless files, blank and broken lines among them, and a definition; the two paths."""
    text = "CREATE TABLE lineitem (\n" + ",\n".join(columns) + "\n);"
    definition, files = (session.fresh_path(spark, name) for name in ("definition", "catalogue"))
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(definition)
    rows.select(csv_line(rows.columns).alias("value")).write.text(files)
    broken = [("",), ("7",), ("7,8",), ("",)]
    spark.createDataFrame(broken, "value string").coalesce(1).write.mode("append").text(files)
    return definition, files


def _store_catalogue(spark: SparkSession, folder: str) -> tuple[str, str]:
    rows = _catalogue_rows(spark, folder)
    columns = [
        f"  {name} {DDL_TYPES[kind]} {'DEFAULT NULL' if name == 'taxed' else 'NOT NULL'}"
        for name, kind in rows.dtypes
    ]
    return _store_files(spark, rows, columns)


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    definition, files = _store_catalogue(spark, folder)
    schema = ddl.ddl_schema(ddl.read_ddl(spark, definition))
    return catalogue.read_catalogue(spark, f"{files}/part-*", schema)


def _store_odd(spark: SparkSession, folder: str) -> tuple[str, str]:
    """A definition that names a column twice and has types of other systems."""
    rows = _lineitem(spark, folder).select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_suppkey").alias("again"),
        F.concat(F.substring(F.col("l_shipdate").cast("string"), 1, 10), F.lit(" 12:30:00")).alias("shipped"),
        F.col(X),
        F.col(Y),
    )
    kinds = {"l_orderkey": "BIGINT", "l_linenumber": "INT", "shipped": "TIMESTAMP", X: "DOUBLE PRECISION", Y: "REAL"}
    columns = [f"  {'l_orderkey' if c == 'again' else c} {kinds.get(c, 'BIGINT')}" for c in rows.columns]
    return _store_files(spark, rows, columns)


def odd_definition(spark: SparkSession, folder: str) -> DataFrame:
    definition, files = _store_odd(spark, folder)
    rows = catalogue.read_catalogue(spark, files, ddl.ddl_schema(ddl.read_ddl(spark, definition)))
    return rows.withColumn("shipped", F.date_format("shipped", "yyyy-MM-dd HH:mm:ss"))


def odd_definition_lines(spark: SparkSession, folder: str) -> DataFrame:
    definition, files = _store_odd(spark, folder)
    return catalogue.read_lines(spark, files, ddl.column_positions(ddl.read_ddl(spark, definition)), X, Y)


def field_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every field of every line, blank and broken lines left out."""
    definition, files = _store_catalogue(spark, folder)
    rows = catalogue.drop_short_rows(catalogue.read_fields(spark, files))
    positions = ddl.column_positions(ddl.read_ddl(spark, definition))
    fields = [F.get("fields", F.lit(at)).alias(name) for name, at in positions.items()]
    return rows.select(F.size("fields").alias("n_fields"), *fields)


def ddl_columns(spark: SparkSession, folder: str) -> DataFrame:
    """The columns of the definition, with the nulls that the files hold in each."""
    definition, files = _store_catalogue(spark, folder)
    columns = ddl.read_ddl(spark, definition)
    rows = catalogue.read_catalogue(spark, files, ddl.ddl_schema(columns))
    nulls = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in rows.columns])
    per_column = nulls.unpivot([], nulls.columns, "name", "nulls")
    return columns.join(per_column, "name")


def _file_tree(points: DataFrame) -> QuadTree:
    return build_quadtree(points, "x", "y", S.FILE_THRESHOLD)


def partitioned_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    points = _points(spark, folder)
    path = session.fresh_path(spark, "cells")
    sinks.write_cells(_file_tree(points).assign(points, "x", "y"), path, S.ROWS_PER_FILE)
    return sinks.read_cells(spark, path, points.schema)


def text_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    rows = _lineitem(spark, folder)
    tree = build_quadtree(rows, X, Y, S.THRESHOLD)
    path = session.fresh_path(spark, "groups")
    groups = sinks.store_groups(merge_cells(tree.counts(), S.MINIMUM), path)
    tagged = tree.assign(rows, X, Y, labels=groups.select("cell", "part"))
    sinks.write_text(tagged, path, S.ROWS_PER_FILE, csv_line(rows.columns), "part", mode="append")
    return sinks.read_groups(spark, path)


def one_file_per_cell(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per cell, and whether a cell that is to have one file has it, read back."""
    points = _points(spark, folder)
    tree = _file_tree(points)
    path = session.fresh_path(spark, "files")
    sinks.write_file_per_cell(tree.assign(points, "x", "y"), path, tree.counts(), S.LARGE_CELL)
    back = sinks.read_cells(spark, path, points.schema).withColumn("file", F.input_file_name())
    per_file = back.groupBy("cell", "file").agg(F.count("*").alias("n"))
    per_cell = per_file.groupBy("cell").agg(F.count("*").alias("files"), F.sum("n").alias("n"))
    return per_cell.select("cell", "n", ((F.col("n") > S.LARGE_CELL) | (F.col("files") == 1)).alias("one_file"))


def dealt_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Leaves dealt to writing tasks by their sizes."""
    return sinks.deal_cells(_tree(_points(spark, folder)).counts(), S.TASKS, S.DEALT_ROWS)


def written_balance(spark: SparkSession, folder: str) -> DataFrame:
    """The files really written per leaf: their bytes as listed, beside the lines in them."""
    definition, files = _store_catalogue(spark, folder)
    out = session.fresh_path(spark, "balance")
    jobs.partition_quadtree(spark, definition, files, out, X, Y, S.FILE_THRESHOLD, file_rows=S.ROWS_PER_FILE)
    held = sinks.written_balance(spark, out)
    least = F.ceil(F.col("n") / S.ROWS_PER_FILE)
    return held.select("cell", "n", "bytes", (F.col("files") >= least).alias("enough_files"))


def line_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with the file they came from, where each flag has files of its own."""
    rows = _lineitem(spark, folder).withColumn("l_shipdate", F.col("l_shipdate").cast("string"))
    path = session.fresh_path(spark, "flags")
    rows.select("l_returnflag", csv_line(rows.columns).alias("value")).write.partitionBy("l_returnflag").text(path)
    at = {name: k for k, name in enumerate(rows.columns)}
    lines = catalogue.read_lines(spark, f"{path}/*/part-*", at, X, Y, sources=True)
    flag = F.regexp_extract("file", "l_returnflag=([^/]*)/", 1)
    return lines.select("data", flag.alias("flag"), (F.col("block") >= 0).alias("placed"))


def rejected_lines(spark: SparkSession, folder: str) -> DataFrame:
    """What was counted while the good lines were written: no second scan."""
    definition, files = _store_catalogue(spark, folder)
    odd = [("1,2,3,4,fifty,6,7,8,9,10,11,12",), ("1,2,3,4,5,,7,8,9,10,11,12",), ("1,2,3,4,5,NaN,7,8,9,10,11,12",)]
    spark.createDataFrame(odd, "value string").coalesce(1).write.mode("append").text(files)
    positions = ddl.column_positions(ddl.read_ddl(spark, definition))
    lines, seen = catalogue.counted_lines(catalogue.judged_lines(spark, files, positions, X, Y))
    good = session.stored(lines.filter("reason is null").drop("reason"), "good")
    counted = [F.lit(seen.get[name]).cast("long").alias(name) for name in ("lines", "short", "bad_x", "bad_y")]
    kept = good.agg(F.count("*").alias("kept"), F.sum(F.octet_length("data")).alias("bytes"))
    return kept.select(*counted, "kept", "bytes")


def region_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of a region from partitions that were written: only directories it touches are read."""
    points = _points(spark, folder)
    tree, path = _tree(points), session.fresh_path(spark, "region")
    sinks.write_cells(tree.assign(points, "x", "y"), path, S.ROWS_PER_FILE)
    return sinks.read_region(sinks.read_cells(spark, path, points.schema), Box(*S.REGION), tree.box, "x", "y")


def grown_split(spark: SparkSession, folder: str) -> DataFrame:
    """A split built on one delivery, and another one added: what the partitions hold."""
    rows = _catalogue_rows(spark, folder)
    kinds = [f"  {name} {DDL_TYPES[kind]}" for name, kind in rows.dtypes]
    first, then = F.col("l_linenumber") > 2, F.col("l_linenumber") <= 2
    definition, files = _store_files(spark, rows.filter(first), kinds)
    _, more = _store_files(spark, rows.filter(then), kinds)
    out = session.fresh_path(spark, "grown")
    jobs.partition_quadtree(spark, definition, files, out, X, Y, S.THRESHOLD, file_rows=S.ROWS_PER_FILE)
    return _held(jobs.add_lines(spark, definition, more, out, X, Y, S.ROWS_PER_FILE), "cell")


def written_cell(spark: SparkSession, folder: str) -> DataFrame:
    """One cell of a written dataset: only its directory is read."""
    return summary.rows_of_cell(partitioned_roundtrip(spark, folder), S.WRITTEN_CELL)


def _held(written: DataFrame, cell: str) -> DataFrame:
    return summary.cell_balance(written, F.col("data"), cell).drop("depth")


def uniform_job(spark: SparkSession, folder: str) -> DataFrame:
    """From headless files to one directory of lines per grid cell, and what it holds."""
    definition, files = _store_catalogue(spark, folder)
    out = session.fresh_path(spark, "uniform")
    return _held(jobs.partition_uniform(spark, definition, files, out, X, Y, S.GRID), "cell")


def quadrant_job(spark: SparkSession, folder: str) -> DataFrame:
    definition, files = _store_catalogue(spark, folder)
    out = session.fresh_path(spark, "quadrants")
    return _held(jobs.partition_quadrants(spark, definition, files, out, X, Y), "cell")


def quadtree_job(spark: SparkSession, folder: str) -> DataFrame:
    definition, files = _store_catalogue(spark, folder)
    out = session.fresh_path(spark, "quadtree")
    written = jobs.partition_quadtree(
        spark, definition, files, out, X, Y, S.FILE_THRESHOLD, file_rows=S.ROWS_PER_FILE
    )
    return _held(written, "cell")


def merged_job(spark: SparkSession, folder: str) -> DataFrame:
    definition, files = _store_catalogue(spark, folder)
    out = session.fresh_path(spark, "merged")
    written = jobs.partition_merged(
        spark, definition, files, out, X, Y, S.MINIMUM, S.THRESHOLD, file_rows=S.ROWS_PER_FILE
    )
    return _with_ids(_held(written, "part"), sinks.stored_groups(spark, out))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        bbox,
        uniform_cells,
        uniform_assign,
        uniform_hist,
        uniform_hist_wide,
        cell_rows,
        quadrant_cells,
        quadrants,
        quad_paths,
        grid_step,
        level_counts,
        quadtree_leaves,
        quadtree_capped,
        quadtree_assign,
        quadtree_vectors,
        quadtree_events,
        event_leaves,
        unfinished_rows,
        merged_cells,
        merged_vectors,
        merged_events,
        merged_runs,
        merged_id_pages,
        merged_assign,
        merged_retag,
        found_runs,
        merged_ranges,
        merged_report,
        merged_report_lines,
        block_partitions,
        cell_balance,
        csv_lines,
        cell_text,
        cell_collect,
        rows_per_file,
        object_records,
        object_summary,
        cell_index,
        distinct_cells,
        sorted_counts,
        unwritten_rows,
        first_rows,
        cluster_assign,
        cluster_sizes,
        cluster_fit,
        cluster_check,
        cluster_starts,
        given_rectangles,
        nested_rectangles,
        placed_rows,
        csv_roundtrip,
        odd_definition,
        odd_definition_lines,
        field_rows,
        ddl_columns,
        partitioned_roundtrip,
        text_roundtrip,
        one_file_per_cell,
        dealt_cells,
        written_balance,
        line_sources,
        rejected_lines,
        region_rows,
        grown_split,
        written_cell,
        uniform_job,
        quadrant_job,
        quadtree_job,
        merged_job,
    )
}
