"""Reading catalogue files: headless, comma-separated, never quoted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.text import NULL_TOKEN, fields
from starloom.sources.ddl import SKIPPED

# Lines with fewer fields are blank or broken.
LEAST_FIELDS = 3
OPTIONS = {"quote": "", "nullValue": NULL_TOKEN, "mode": "PERMISSIVE"}


def _has_fields(least: int) -> Column:
    """Whether a line has so many fields, found without cutting it."""
    return F.substring_index("value", ",", least - 1) != F.col("value") if least > 1 else F.lit(True)


def _definition(schema: T.StructType) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)


def read_catalogue(
    spark: SparkSession, path: str | list[str], schema: T.StructType, least: int = LEAST_FIELDS
) -> DataFrame:
    """Typed rows of one file, a folder or a glob of files.

    Lines with fewer than ``least`` fields are left out, and so are fields that the
    schema marks as skipped.
    """
    lines = spark.read.text(path).filter(_has_fields(least))
    kept = [f"_row.`{name}`" for name in schema.names if not name.startswith(SKIPPED)]
    return lines.select(F.from_csv("value", _definition(schema), OPTIONS).alias("_row")).select(*kept)


def read_fields(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows as arrays of text, split exactly at the commas: ``fields``."""
    return spark.read.text(path).select(fields(F.col("value")).alias("fields"))


def drop_short_rows(rows: DataFrame, least: int = LEAST_FIELDS) -> DataFrame:
    """Leave out blank and broken lines: those with fewer than ``least`` fields."""
    return rows.filter(F.size("fields") >= least)


# Why a line is not taken as a point, in the order in which it is looked at.
SHORT, BAD_X, BAD_Y = "short", "x", "y"


def judged_lines(
    spark: SparkSession, path: str | list[str], positions: dict[str, int], x: str, y: str, sources: bool = False
) -> DataFrame:
    """All lines with their coordinates and what is wrong with them: ``data, x, y, reason``.

    ``positions`` says where in a line each column stands. ``reason`` is null for a good line, ``short`` for
    a blank or broken one, and ``x`` or ``y`` where that field is no finite number. With ``sources`` each
    line also says where it came from: ``file`` and ``block``, the first byte of the stretch of
    the file that it was read with.

    For jobs that hand the text on: it is cut only as far as the later coordinate, and
    numbers keep the spelling they came with. A field that is no number gives a null.
    """
    lines = _cut_lines(spark, path, positions, x, y, sources)
    finite = lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False))
    reason = F.when(~F.col("_long"), SHORT).when(~finite(F.col("x")), BAD_X).when(~finite(F.col("y")), BAD_Y)
    return lines.withColumn("reason", reason).drop("_long")


def _cut_lines(
    spark: SparkSession, path: str | list[str], positions: dict[str, int], x: str, y: str, sources: bool
) -> DataFrame:
    at_x, at_y = positions[x], positions[y]
    start = F.split("value", ",", max(at_x, at_y, LEAST_FIELDS - 1) + 2)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    return spark.read.text(path).select(
        F.col("value").alias("data"),
        F.get(start, F.lit(at_x)).try_cast("double").alias("x"),
        F.get(start, F.lit(at_y)).try_cast("double").alias("y"),
        _has_fields(LEAST_FIELDS).alias("_long"),
        *(place if sources else []),
    )


def cut_again(lines: DataFrame, positions: dict[str, int], x: str, y: str) -> DataFrame:
    """Add ``x`` and ``y`` to lines ``data`` that were written before."""
    start = F.split("data", ",", max(positions[x], positions[y], LEAST_FIELDS - 1) + 2)
    return lines.withColumns(
        {name: F.get(start, F.lit(positions[c])).try_cast("double") for name, c in (("x", x), ("y", y))}
    )


def counted_lines(lines: DataFrame) -> tuple[DataFrame, Observation]:
    """Judged lines, and what is counted while they are read for something else.

    After the first job over them the observation has ``lines``, ``short``, ``bad_x`` and ``bad_y``.
    """
    seen = Observation()
    count = lambda name: F.count_if(F.col("reason") == name)
    observed = lines.observe(
        seen,
        F.count("*").alias("lines"),
        count(SHORT).alias("short"),
        count(BAD_X).alias("bad_x"),
        count(BAD_Y).alias("bad_y"),
    )
    return observed, seen


def read_lines(
    spark: SparkSession, path: str | list[str], positions: dict[str, int], x: str, y: str, sources: bool = False
) -> DataFrame:
    """Unchanged lines with their coordinates: ``data, x, y``. Short lines are left out.

    The lines of :func:`judged_lines` without the short ones; a field that is no number gives a null.
    """
    return _cut_lines(spark, path, positions, x, y, sources).filter("_long").drop("_long")


def points(df: DataFrame, x: str, y: str, *keep: str) -> DataFrame:
    """The two coordinates as doubles, with any columns to keep."""
    return df.select(*keep, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
