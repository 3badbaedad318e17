"""Every row with the text of its neighbour in the order of a key, in one shuffle of the texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Ranges of the key for every shuffle partition, so that their sizes even out.
RANGES_PER_TASK = 4
# Ranges are found by two short steps instead of one long one above so many.
STEP = 64


def _count_below(bounds: list[int], key: Column, same: bool) -> Column:
    """How many of the sorted bounds are below the key, or below or equal."""
    listed = lambda values: F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")
    below = lambda found: F.size(F.filter(found, lambda b: (b <= key) if same else (b < key)))
    if not bounds:
        return F.lit(0)
    at = below(listed(bounds[STEP - 1 :: STEP])) * STEP if len(bounds) >= STEP else F.lit(0)
    return at + below(F.slice(listed(bounds), at + 1, STEP))


def with_next_text(df: DataFrame, key: str = "doc_id", text: str = "text", name: str = "next_text") -> DataFrame:
    """Add the text of the next row in descending order of an integer key; the last row gets the first one's.

    Null keys come last. Rows with one key follow each other by a hash of their content, by
    which a key with many rows is also split. A single row is its own neighbour; an empty
    table stays empty. A column of the name of the new one is replaced.

    The key's quantiles cut the rows into ranges of similar size, a range is one group of a
    window, and each range gets a copy of the first row of the next one.
    """
    spark, columns = df.sparkSession, [c for c in df.columns if c != name]
    least = -(1 << 63)
    id_, turn, part, copy = "_next_key", "_next_turn", "_next_part", "_next_copy"
    rows = df.select(*[F.col(f"`{c}`") for c in columns])
    rows = rows.withColumns(
        {
            id_: F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(least)),
            turn: F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(1 << 30)),
        }
    )
    n = RANGES_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / n for i in range(1, n)]
    bounds = rows.agg(F.percentile_approx(id_, cuts, 100 * n).alias("at")).first().at or []
    below, most = _count_below(bounds, F.col(id_), False), _count_below(bounds, F.col(id_), True)
    rows = rows.withColumn(part, below)
    if len(set(bounds)) < len(bounds):  # a key with many rows
        rows = rows.withColumn(part, F.col(part) + F.floor((most - below) * F.col(turn) / F.lit(1 << 30)).cast("int"))

    # One row for each range: its first row, and which range comes before it.
    heads = rows.groupBy(part).agg(F.max(F.struct(id_, turn)).alias("head"))
    order, whole = Window.orderBy(F.col(part).desc()), Window.partitionBy()
    heads = heads.select(
        F.coalesce(F.lag(part).over(order), F.min(part).over(whole)).alias("_next_to"),
        F.col(f"head.{id_}").alias("_next_head_key"),
        F.col(f"head.{turn}").alias("_next_head_turn"),
    )
    own = (F.col(id_) == F.col("_next_head_key")) & (F.col(turn) == F.col("_next_head_turn"))
    firsts = rows.join(F.broadcast(heads), own).drop(part, "_next_head_key", "_next_head_turn")
    firsts = firsts.withColumnRenamed("_next_to", part).dropDuplicates([part])
    both = rows.withColumn(copy, F.lit(0)).unionByName(firsts.withColumn(copy, F.lit(1)))
    along = Window.partitionBy(part).orderBy(copy, F.col(id_).desc(), F.col(turn).desc())
    followed = both.withColumn(name, F.lead(f"`{text}`").over(along))
    return followed.filter(F.col(copy) == 0).select(*[F.col(f"`{c}`") for c in columns], name)
