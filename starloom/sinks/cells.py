"""Writing rows so that each cell has its own directory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import session
from starloom.functions.geometry import DEEPEST, Box, inside
from starloom.operators.merge import whole_ids
from starloom.operators.ranks import with_rows_before

# Cells that a region is covered by, at most about so many.
REGION_CELLS = 64


def write_cells(
    df: DataFrame,
    path: str,
    rows_per_file: int,
    cell: str = "cell",
    file_format: str = "parquet",
    mode: str = "error",
) -> None:
    """One directory per cell, in one job; the cell id moves from the rows to the path.

    Rows of a cell are brought together so that small cells get one file. Rebalancing lets
    adaptive execution split a hot cell over several tasks by blocks of shuffled data,
    whatever its rows look like, and ``rows_per_file`` bounds each file.
    """
    (
        df.hint("rebalance", F.col(cell))
        .write.partitionBy(cell)
        .option("maxRecordsPerFile", rows_per_file)
        .mode(mode)
        .format(file_format)
        .save(path)
    )


def write_text(
    df: DataFrame, path: str, rows_per_file: int, line: Column, cell: str = "cell", mode: str = "error"
) -> None:
    """One directory per cell with one line of text per row."""
    write_cells(df.select(cell, line.alias("data")), path, rows_per_file, cell, "text", mode)


def deal_cells(counts: DataFrame, tasks: int, most: int, cell: str = "cell") -> DataFrame:
    """Deal the cells of up to ``most`` rows to tasks by their sizes: ``cell, n, task``.

    Cells in id order are cut where another equal share of the rows is full. There are at most ``tasks`` shares, and
    none is below ``most`` rows unless all are in one, so no task has more than twice a share.
    """
    small = counts.filter(F.col(cell).isNotNull() & (F.col("n") <= most)).select(cell, "n")
    total = small.agg(F.sum("n")).first()[0] or 0
    shares = max(1, min(tasks, total // max(most, 1)))
    task = F.floor(F.col("before") * shares / F.lit(max(total, 1))).cast("int")
    return with_rows_before(small, "n", cell).select(cell, "n", task.alias("task"))


def write_file_per_cell(
    df: DataFrame, path: str, counts: DataFrame, rows_per_file: int, cell: str = "cell"
) -> None:
    """Exactly one file for each cell of up to ``rows_per_file`` rows.

    Such cells are dealt to tasks by their sizes, and a task writes its cells one after the other. Larger
    cells (``counts``: ``cell, n``) would make one task as long as the cell, so they are written in several
    files; rows without a cell go with them. The rows are stored once and read for both.
    """
    rows = session.cut_lineage(df)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = session.cut_lineage(deal_cells(counts, tasks, rows_per_file, cell)).withColumnRenamed("task", "_task")
    placed = session.join_cell_table(rows, dealt.select(cell, "_task"), cell, "inner")
    placed = placed.repartitionById(tasks, F.col("_task")).sortWithinPartitions(cell)
    placed.select(*df.columns).write.partitionBy(cell).parquet(path)
    rest = session.join_cell_table(rows, dealt.select(cell), cell, "left_anti")
    write_cells(rest, path, rows_per_file, cell, mode="append")


def written_files(spark: SparkSession, path: str, cell: str = "cell") -> DataFrame:
    """The files of a dataset written per cell, ``cell, file, bytes``: listed, not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.regexp_extract("path", f"/{cell}=([^/]*)/[^/]*$", 1)
    return listed.select(name.alias(cell), F.col("path").alias("file"), F.col("length").alias("bytes"))


def written_balance(spark: SparkSession, path: str, cell: str = "cell") -> DataFrame:
    """Files and bytes per cell as they were written, and the rows in them: ``cell, files, bytes, n, text_bytes``.

    The first two come from the listing of the files alone; ``text_bytes`` are those of the lines
    themselves, of which each takes one more in a file without compression.
    """
    sizes = written_files(spark, path, cell).groupBy(cell).agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
    lines = read_lines(spark, path, cell)
    held = lines.groupBy(cell).agg(F.count("*").alias("n"), F.sum(F.octet_length("data")).alias("text_bytes"))
    return sizes.join(held, cell, "left").fillna(0, ["n", "text_bytes"])


def region_cells(region: Box, box: Box, most: int = REGION_CELLS) -> list[str]:
    """Ids of cells that cover a region of the box, at most about ``most``, from coarse to fine.

    Cells on the border of the region are quartered while there is room; those within it, and those outside, are not.
    """
    done, border = [], [("_", tuple(box))]
    meets = lambda r: r[0] <= region.x1 and r[1] >= region.x0 and r[2] <= region.y1 and r[3] >= region.y0
    within = lambda r: region.x0 <= r[0] and r[1] <= region.x1 and region.y0 <= r[2] and r[3] <= region.y1
    border = [cell for cell in border if meets(cell[1])]
    while border and len(done) + 4 * len(border) <= most and len(border[0][0]) <= DEEPEST:
        finer = []
        for name, (x0, x1, y0, y1) in border:
            if within((x0, x1, y0, y1)):
                done.append(name)
                continue
            mx, my = (x0 + x1) / 2, (y0 + y1) / 2
            quarters = [(x0, mx, y0, my), (mx, x1, y0, my), (mx, x1, my, y1), (x0, mx, my, y1)]
            finer += [(f"{name}{k}", r) for k, r in enumerate(quarters) if meets(r)]
        border = finer
    return done + [name for name, _ in border]


def read_region(rows: DataFrame, region: Box, box: Box | None, x: str, y: str, cell: str = "cell") -> DataFrame:
    """Rows of a closed region from a dataset written per quadtree cell over ``box``.

    Cells that the region touches are told by the beginning of their ids, a condition on the partition
    column, so only their directories are listed and read. Rows without a cell lie in no region.
    """
    if box is None:
        return rows.limit(0)
    near = F.lit(False)
    for name in region_cells(region, box):
        near = near | F.col(cell).startswith(name) | F.lit(name).startswith(F.col(cell))
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    return rows.filter(F.col(cell).isNotNull() & near).filter(inside(px, py, region))


def read_cells(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    cell: str = "cell",
    file_format: str = "parquet",
    paths: list[str] | None = None,
) -> DataFrame:
    """Read a dataset written per cell, or only some of its directories; ``00`` stays text and does not become a number."""
    stored = [field for field in schema.fields if field.name != cell]
    named = T.StructType([*stored, T.StructField(cell, T.StringType())])
    if paths is not None and not paths:
        return spark.createDataFrame([], named)
    read = spark.read.schema(named).format(file_format)
    with session.listing_in_few_tasks(spark):
        return read.load(path) if paths is None else read.option("basePath", path).load(paths)


def read_lines(spark: SparkSession, path: str, cell: str = "cell", paths: list[str] | None = None) -> DataFrame:
    """Read lines written per cell, or those of some directories: ``data`` and the cell id."""
    return read_cells(spark, path, T.StructType([T.StructField("data", T.StringType())]), cell, "text", paths)


def store_groups(merged: DataFrame, path: str) -> DataFrame:
    """Keep ``part, cell, n, idx`` of merged cells beside the partitions; ``part`` names the directory of a group."""
    merged.select("part", "cell", "n", "idx").write.parquet(f"{path}/_groups")
    return stored_groups(merged.sparkSession, path)


def stored_groups(spark: SparkSession, path: str) -> DataFrame:
    """The merged cells kept by :func:`store_groups`."""
    return spark.read.parquet(f"{path}/_groups")


def read_groups(spark: SparkSession, path: str) -> DataFrame:
    """Read lines written per merged group: ``data`` and the whole id of the group, ``id_part``.

    The whole id is as long as all members of the group together; :func:`read_lines` with ``part``
    gives the lines with the group's short name.
    """
    names = session.cut_lineage(whole_ids(stored_groups(spark, path)))
    rows = read_lines(spark, path, "part")
    return session.join_cell_table(rows, names, "part", "left").select("data", "id_part")
