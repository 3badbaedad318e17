"""From cell ids back to coordinate ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom import session
from starloom.functions.geometry import Box, path_box

# The wording of the report.
HEADLINE = "La partition %scorespond a"
RANGES = "%s dans [%s, %s] et %s dans [%s, %s]"


def decode_ranges(ids: DataFrame, box: Box | None, id_column: str = "id_part") -> DataFrame:
    """Rectangles of cell or group ids: one row ``id, pos, x0, x1, y0, y1`` per member.

    Without a box, that of a table without points, there are none.

    Each ``_`` starts again from the root box; each digit narrows to a quarter.
    """
    if box is None:
        ids, box = ids.limit(0), Box(0.0, 0.0, 0.0, 0.0)
    paths = F.split(F.expr(f"substring(`{id_column}`, instr(`{id_column}`, '_') + 1)"), "_")
    members = ids.select(id_column, F.posexplode(paths).alias("pos", "path"))
    return members.withColumn("rect", path_box(F.col("path"), box)).select(
        id_column, "pos", F.concat(F.lit("_"), "path").alias("member"), "rect.*"
    )


def member_ranges(merged: DataFrame, box: Box | None) -> DataFrame:
    """Rectangles of the members of merged groups, ``part, pos, member, x0, x1, y0, y1``, from their own ids."""
    starts = session.cut_lineage(merged.groupBy("part").agg(F.min("idx").alias("start")))
    placed = session.join_cell_table(merged, starts, "part", "inner")
    members = placed.select("part", (F.col("idx") - F.col("start")).alias("pos"), F.col("cell").alias("member"))
    if box is None:
        members, box = members.limit(0), Box(0.0, 0.0, 0.0, 0.0)
    return members.withColumn("rect", path_box(F.substring("member", 2, 64), box)).select(*members.columns, "rect.*")


def _range_line(x: str, y: str) -> Column:
    x0, x1, y0, y1 = (F.col(edge).cast("string") for edge in Box._fields)
    return F.format_string(RANGES, F.lit(x), x0, x1, F.lit(y), y0, y1)


def report_lines(merged: DataFrame, box: Box | None, x: str, y: str) -> DataFrame:
    """The report of merged groups, a row per line: ``part, pos, line``. The headline has ``pos`` -1.

    Its headline names a group by its first leaf, so no line grows with the group.
    """
    heads = merged.select("part").distinct().select("part", F.lit(-1).cast("long").alias("pos"))
    lines = member_ranges(merged, box).select("part", "pos", _range_line(x, y).alias("line"))
    return heads.withColumn("line", F.format_string(HEADLINE, "part")).unionByName(lines)


def partition_report(ids: DataFrame, box: Box | None, x: str, y: str, id_column: str = "id_part") -> DataFrame:
    """Per id, a headline and one line per member rectangle in one text: ``id, report``."""
    line = _range_line(x, y)
    lines = F.transform(F.sort_array(F.collect_list(F.struct("pos", line.alias("line")))), lambda s: s["line"])
    return (
        decode_ranges(ids, box, id_column)
        .groupBy(id_column)
        .agg(F.array_join(lines, "\n").alias("lines"))
        .select(id_column, F.concat_ws("\n", F.format_string(HEADLINE, id_column), "lines").alias("report"))
    )
