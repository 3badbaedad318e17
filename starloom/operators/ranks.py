"""Ids numbered in their order, by ranges: no task sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom import session

# monotonically_increasing_id() keeps the place of a row within its partition in so many low bits.
PLACE_BITS = 33


def with_rows_before(ids: DataFrame, n: str, cell: str = "cell", name: str = "before") -> DataFrame:
    """Add the sum of the column ``n`` over all rows that come before in the order of ``cell``, range by range."""
    tasks = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = ids.repartitionByRange(tasks, cell).sortWithinPartitions(cell)
    placed = session.cut_lineage(ordered.withColumn("_range", F.spark_partition_id()))
    sums = {r["_range"]: r["n"] for r in placed.groupBy("_range").agg(F.sum(n).alias("n")).collect()}
    along = Window.partitionBy("_range").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(n).over(along), F.lit(0))
    return placed.withColumn(name, F.get(_starts(sums), F.col("_range")) + inside).drop("_range")


def _starts(sums: dict[int, int]) -> Column:
    """What the ranges before each range add up to, as an array."""
    starts, before = [], 0
    for k in range(max(sums, default=-1) + 1):
        starts.append(str(before))
        before += sums.get(k, 0)
    return F.split(F.lit(",".join(starts) or "0"), ",").cast("array<bigint>")


def with_rank(ids: DataFrame, cell: str = "cell", name: str = "idx") -> DataFrame:
    """Add the place of each row in the order of a column without repeats, from 0.

    Rows are dealt to ranges and sorted within them. A row's place is its place in the
    range plus the rows of the ranges before, of which the driver knows one number each.
    """
    n = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = ids.repartitionByRange(n, cell).sortWithinPartitions(cell)
    placed = session.cut_lineage(ordered.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", PLACE_BITS)
    sizes = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    place = F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return placed.withColumn(name, F.get(_starts(sizes), part.cast("int")) + place).drop("_place")
