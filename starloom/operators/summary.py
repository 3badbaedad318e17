"""Counts, listings and summaries per cell and per object."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom import session
from starloom.functions.text import BLOCK_BYTES, csv_line
from starloom.operators.ranks import with_rank


def count_per_cell(df: DataFrame, cell: str = "cell") -> DataFrame:
    return df.groupBy(cell).agg(F.count("*").alias("n"))


def rows_of_cell(df: DataFrame, name: str, cell: str = "cell") -> DataFrame:
    """Rows of one cell; on a dataset written per cell this reads only its directory."""
    return df.filter(F.col(cell) == name)


def distinct_cells(df: DataFrame, cell: str = "cell") -> DataFrame:
    return df.select(cell).distinct()


def cell_balance(df: DataFrame, line: Column, cell: str = "cell") -> DataFrame:
    """Rows and text bytes per cell, and the depth at which the cell was cut."""
    return df.groupBy(cell).agg(
        F.count("*").alias("n"),
        F.sum(F.octet_length(line)).alias("bytes"),
        F.max(F.length(cell) - 1).alias("depth"),
    )


def index_cells(cells: DataFrame, cell: str = "cell") -> DataFrame:
    """Number distinct cell ids from 0 in id order: ``cell, idx``; null ids have no number and are left out."""
    return with_rank(distinct_cells(cells, cell).filter(F.col(cell).isNotNull()), cell)


def unwritten_rows(df: DataFrame, written: DataFrame, cell: str = "cell") -> DataFrame:
    """Rows whose cell is not among the written ones."""
    known = session.cut_lineage(distinct_cells(written, cell))
    return session.join_cell_table(df, known, cell, "left_anti")


def rows_per_file(df: DataFrame, line: Column, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """How many rows fill a file: the mean of block size over line size, rounded down."""
    return rows_of_size(df.select(F.octet_length(line).alias("size")), "size", block_bytes)


def rows_of_size(df: DataFrame, size: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The same from the sizes of the lines; a null without rows.

    Lines of equal length are counted first, which leaves few distinct terms to add.
    """
    sizes = df.select(F.col(size).alias("size")).groupBy("size").agg(F.count("*").alias("n"))
    total = F.sum(F.col("n") * (F.lit(float(block_bytes)) / F.col("size")))
    return sizes.agg(F.floor(total / F.sum("n")).alias("rows_per_file"))


def object_records(df: DataFrame, object_id: str, source_id: str, x: str, y: str) -> DataFrame:
    """One record per row, shaped to be folded per object."""
    return df.select(
        F.col(object_id).alias("object_id"),
        F.lit(1).alias("n"),
        F.col(source_id).cast("long").alias("source_id"),
        F.col(x).alias("x_low"),
        F.col(x).alias("x_high"),
        F.col(y).alias("y_low"),
        F.col(y).alias("y_high"),
    )


def object_summary(records: DataFrame) -> DataFrame:
    """Rows, latest source and coordinate ranges per object."""
    return records.groupBy("object_id").agg(
        F.sum("n").alias("n"),
        F.max("source_id").alias("source_id"),
        F.min("x_low").alias("x_low"),
        F.max("x_high").alias("x_high"),
        F.min("y_low").alias("y_low"),
        F.max("y_high").alias("y_high"),
    )


def paged_lines(
    df: DataFrame, columns: Sequence[str], page_rows: int, cell: str = "cell", counts: DataFrame | None = None
) -> DataFrame:
    """The lines of each cell in pages: ``cell, page, piece, n, lines`` (sorted array).

    One value per cell would put a whole hot cell into one task and one string. A cell
    with n rows gets ceil(n / page_rows) pages and each line picks its page by hash.
    Equal lines are counted before the shuffle and only repeated inside a page, at
    most ``page_rows`` times per piece, so a mass of copies is spread over pieces. Every row
    is in exactly one page. Known ``counts`` (``cell, n``) save the pass that takes them.
    """
    copies = (
        df.select(cell, csv_line(columns).alias("line"))
        .groupBy(cell, "line")
        .agg(F.count("*").alias("copies"))
    )
    if counts is None:
        counts = session.cut_lineage(count_per_cell(df, cell))
    pages = counts.select(cell, F.ceil(F.col("n") / page_rows).alias("pages"))
    hashed = F.conv(F.substring(F.md5("line"), 1, 8), 16, 10).cast("long")
    placed = (
        session.join_cell_table(copies, pages, cell, "inner")
        .withColumn("page", hashed % F.col("pages"))
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / page_rows))))
        .withColumn("copies", F.least(F.lit(page_rows), F.col("copies") - F.col("piece") * page_rows).cast("int"))
    )
    held = F.sort_array(F.collect_list(F.struct("line", "copies")))
    return placed.groupBy(cell, "page", "piece").agg(
        F.sum("copies").alias("n"),
        F.flatten(F.transform(held, lambda s: F.array_repeat(s["line"], s["copies"]))).alias("lines"),
    )


def text_per_cell(df: DataFrame, columns: Sequence[str], page_rows: int, cell: str = "cell") -> DataFrame:
    """The rows of each cell as newline-joined text, page by page."""
    return paged_lines(df, columns, page_rows, cell).select(
        cell, "page", "piece", "n", F.array_join("lines", "\n").alias("text")
    )


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)
