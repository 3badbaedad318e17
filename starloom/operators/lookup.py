"""Rows placed into partitions that are already there."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import session
from starloom.functions.geometry import Box, inside, usable
from starloom.operators.bbox import measure_box
from starloom.operators.quadtree import QuadTree
from starloom.operators.ranks import PLACE_BITS
from starloom.operators.uniform import NO_CELL

# The finest grid has 2 ** this tiles per axis.
FINEST = 16
# A list of more rectangles is handed down to finer tiles while all lists together stay below
# this many entries per rectangle.
LONG_LIST, MOST_ENTRIES = 64, 32
# Bytes of rectangles that are sent to every executor, and what one takes there beyond its name.
SENT_BYTES, SENT_RECTANGLE = 64 << 20, 40
RECTANGLE = ("pos", "cell", "x0", "x1", "y0", "y1")


def _tile(value: Column, low: float, high: float) -> Column:
    """Index on the finest grid. Rounding is monotone, so a point in a rectangle lies between its corners."""
    if high == low:
        return F.lit(0)
    at = F.floor((value - low) * (2.0**FINEST / (high - low)))
    return F.greatest(F.lit(0), F.least(F.lit((1 << FINEST) - 1), at)).cast("int")


def _listed(rectangles: DataFrame, box: Box) -> DataFrame:
    """Rectangles by tiles, ``level, tx, ty`` beside their own columns and corners on the finest grid.

    Level 0 is one tile for the whole box. A rectangle is listed at the finest level on which it
    touches at most two tiles per axis.
    """
    corners = {
        "i0": _tile(F.col("x0"), box.x0, box.x1), "i1": _tile(F.col("x1"), box.x0, box.x1),
        "j0": _tile(F.col("y0"), box.y0, box.y1), "j1": _tile(F.col("y1"), box.y0, box.y1),
    }
    known = rectangles.withColumns(corners)
    reach = F.greatest(F.col("i1") - F.col("i0"), F.col("j1") - F.col("j0"))
    known = known.withColumn("up", F.when(reach <= 1, 0).otherwise(F.length(F.bin(reach - 1))).cast("int"))
    known = known.withColumn("level", F.lit(FINEST) - F.col("up"))
    spread = lambda low, high: F.explode(F.sequence(F.expr(f"shiftright({low}, up)"), F.expr(f"shiftright({high}, up)")))
    return known.withColumn("tx", spread("i0", "i1")).withColumn("ty", spread("j0", "j1")).drop("up")


def _reachable(listed: DataFrame, box: Box) -> DataFrame:
    """Leave out what no point of the tile can get: rectangles after one that covers the whole tile."""
    first, last = f"shiftleft({{0}}, {FINEST} - level)", f"shiftleft({{0}} + 1, {FINEST} - level) - 1"
    covers = (
        ((F.expr(f"i0 < {first.format('tx')}")) | (F.col("x0") <= box.x0))
        & ((F.expr(f"i1 > {last.format('tx')}")) | (F.col("x1") >= box.x1))
        & ((F.expr(f"j0 < {first.format('ty')}")) | (F.col("y0") <= box.y0))
        & ((F.expr(f"j1 > {last.format('ty')}")) | (F.col("y1") >= box.y1))
    )
    entry = F.struct("pos", "cell")
    tops = listed.filter(covers).groupBy("level", "tx", "ty").agg(F.min(entry).alias("top"))
    joined = listed.join(tops, ["level", "tx", "ty"], "left")
    return joined.filter(F.col("top").isNull() | (entry <= F.col("top"))).drop("top")


def _handed_down(listed: DataFrame, long: DataFrame) -> DataFrame:
    """The lists of some tiles, each rectangle in those of the four smaller tiles that it touches."""
    half = F.explode(F.array(F.lit(0), F.lit(1)))
    finer = listed.join(long, ["level", "tx", "ty"], "left_semi").withColumn("dx", half).withColumn("dy", half)
    finer = finer.withColumns(
        {"level": F.col("level") + 1, "tx": F.col("tx") * 2 + F.col("dx"), "ty": F.col("ty") * 2 + F.col("dy")}
    ).drop("dx", "dy")
    at = lambda corner: F.expr(f"shiftright({corner}, {FINEST} - level)")
    return finer.filter(F.col("tx").between(at("i0"), at("i1")) & F.col("ty").between(at("j0"), at("j1")))


def rectangle_lists(rectangles: DataFrame, box: Box) -> DataFrame:
    """All lists, ``level, tx, ty`` and a rectangle in each row, their number linear in that of the rectangles.

    A rectangle has four entries at most, and none where an earlier one covers the tile. Lists that are long
    all the same are handed down level by level, which splits them and lets covering ones end them.
    """
    listed = session.cut_lineage(_reachable(_listed(rectangles, box), box))
    about = listed.agg(F.count("*").alias("entries"), F.countDistinct("pos", "cell").alias("known")).first()
    most, entries = MOST_ENTRIES * max(about.known, 1), about.entries
    while entries < most:
        sizes = listed.groupBy("level", "tx", "ty").agg(F.count("*").alias("n"))
        long = session.cut_lineage(
            sizes.filter((F.col("n") > LONG_LIST) & (F.col("level") < FINEST)).select("level", "tx", "ty")
        )
        if long.isEmpty():
            break
        rest = listed.join(long, ["level", "tx", "ty"], "left_anti")
        # Lists that meet on a tile become one.
        finer = session.cut_lineage(_reachable(rest.unionByName(_handed_down(listed, long)), box))
        entries = finer.count()
        if entries <= most:
            listed = finer
    return listed.select("level", "tx", "ty", *RECTANGLE)


def _clipped(rectangles: DataFrame, box: Box | None) -> DataFrame:
    """Rectangles with an edge at infinity, or all of them, cut at the box of the points."""
    if box is None:
        return rectangles.limit(0)
    edges = {
        "x0": F.greatest("x0", F.lit(box.x0)), "x1": F.least("x1", F.lit(box.x1)),
        "y0": F.greatest("y0", F.lit(box.y0)), "y1": F.least("y1", F.lit(box.y1)),
    }
    return rectangles.withColumns(edges).filter("x0 <= x1 and y0 <= y1 and not isnan(x0) and not isnan(y0)")


def find_rectangle(df: DataFrame, rectangles: DataFrame, x: str, y: str, cell: str = "cell") -> DataFrame:
    """Tag each row with the first closed rectangle that holds its point; ``-1`` if none does.

    ``rectangles``: ``pos, cell, x0, x1, y0, y1``, any rectangles, the one with the lowest
    ``pos`` first; of equal ones only the first counts. As many as may be sent to every executor, in the order
    of ``pos``, are looked through there, and what they hold is done: no later one comes before them. If there are
    more, the rows left over look through lists of the others by the tiles of grids from coarse to fine, each at the
    level of its size. No pair of row and rectangle is ever written out.
    """
    known = rectangles.select(*RECTANGLE).filter((F.col("x0") <= F.col("x1")) & (F.col("y0") <= F.col("y1")))
    known = session.cut_lineage(known)
    open_ended = known.filter(~(usable(F.col("x0"), F.col("y0")) & usable(F.col("x1"), F.col("y1"))))
    if not open_ended.isEmpty():
        known = _clipped(known, measure_box(df, x, y))
    first = F.min(F.struct("pos", F.coalesce(F.col("cell").cast("string"), F.lit(NO_CELL)).alias("cell")))
    known = known.groupBy("x0", "x1", "y0", "y1").agg(first.alias("_first")).select("_first.*", "x0", "x1", "y0", "y1")
    known = session.cut_lineage(known.orderBy("pos", "cell").withColumn("_turn", F.monotonically_increasing_id()))
    last = _last_sent(known)
    payload = [F.col(f"`{c}`") for c in df.columns if c != cell]
    if last is None:
        return df.select(*payload, F.lit(NO_CELL).alias(cell))
    sent, others = known.filter(F.col("_turn") <= last), known.filter(F.col("_turn") > last).drop("_turn")
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    rows = df.withColumn("_first", _first_of(sent)(px, py))
    if others.isEmpty():
        return rows.select(*payload, F.coalesce("_first", F.lit(NO_CELL)).alias(cell))
    rows = session.stored(rows, "placed")
    done = rows.filter("_first is not null").select(*payload, F.col("_first").alias(cell))
    return done.unionByName(_by_lists(rows.filter("_first is null").drop("_first"), others, x, y, cell))


def _last_sent(ordered: DataFrame) -> int | None:
    """The ``_turn`` of the last rectangle that is sent, None if there is none at all."""
    part, size = F.shiftright("_turn", PLACE_BITS), F.octet_length("cell") + SENT_RECTANGLE
    sizes = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.sum(size).alias("size"))
    last, room = None, SENT_BYTES
    for row in sorted(sizes.collect()):
        fit = row.n if row.size <= room else max(room * row.n // row.size, 1 if last is None else 0)
        if fit:
            last = (row.part << PLACE_BITS) + fit - 1
        room -= row.size
        if fit < row.n:
            break
    return last


def _first_of(ordered: DataFrame):
    """A function of both coordinates: the name of the first rectangle that holds the point, null if none does.

    Points are halved until one rectangle holds all of a part, or the part and the rectangles that come before that
    one are few. The first rectangles hold most points, so the others are looked at for the points left over. The
    function refers to nothing in this package.
    """
    table = ordered.select("_turn", "x0", "x1", "y0", "y1", "cell").toArrow().sort_by("_turn")
    edges = [table.column(name).to_numpy() for name in ("x0", "x1", "y0", "y1")]
    sent = ordered.sparkSession.sparkContext.broadcast((edges, table.column("cell").combine_chunks()))
    few, first_look = 1 << 17, 1 << 12
    wide, high = (max(float(edges[k + 1].max()) - float(edges[k].min()), 5e-324) for k in (0, 2))

    def place(px: np.ndarray, py: np.ndarray, x0, x1, y0, y1) -> np.ndarray:
        out = np.full(len(px), -1)
        todo = [(np.arange(len(px)), np.arange(len(x0)))]
        while todo:
            points, rects = todo.pop()
            if not len(points):
                continue
            xs, ys = px[points], py[points]
            left, right, below, above = xs.min(), xs.max(), ys.min(), ys.max()
            a, b, c, d = x0[rects], x1[rects], y0[rects], y1[rects]
            near = (a <= right) & (b >= left) & (c <= above) & (d >= below)
            whole = np.flatnonzero(near & (a <= left) & (b >= right) & (c <= below) & (d >= above))
            if len(whole):
                near[whole[0] + 1 :] = False
            rects = rects[near]
            if not len(rects):
                continue
            if len(rects) == 1 and len(whole):
                out[points] = rects[0]
            elif len(points) * len(rects) <= few:
                holds = (x0[rects] <= xs[:, None]) & (xs[:, None] <= x1[rects])
                holds &= (y0[rects] <= ys[:, None]) & (ys[:, None] <= y1[rects])
                found = holds.any(axis=1)
                out[points[found]] = rects[holds.argmax(axis=1)[found]]
            else:
                values = xs if (right - left) / wide >= (above - below) / high else ys
                halves = np.argpartition(values, len(points) // 2)
                todo += [(points[halves[: len(points) // 2]], rects), (points[halves[len(points) // 2 :]], rects)]
        return out

    @F.pandas_udf("string")
    def first(xs: pd.Series, ys: pd.Series) -> pd.Series:
        (x0, x1, y0, y1), names = sent.value
        px, py = (values.to_numpy(dtype="float64", na_value=np.nan) for values in (xs, ys))
        turn, open_ = np.full(len(px), -1), np.flatnonzero(np.isfinite(px) & np.isfinite(py))
        at, look = 0, first_look
        while len(open_) and at < len(x0):
            now = slice(at, at + look)
            found = place(px[open_], py[open_], x0[now], x1[now], y0[now], y1[now])
            turn[open_] = np.where(found >= 0, found + at, -1)
            open_ = open_[found < 0]
            at, look = at + look, look * 8
        return names.take(pa.array(turn, mask=turn < 0)).to_pandas()

    return first


def _by_lists(df: DataFrame, known: DataFrame, x: str, y: str, cell: str) -> DataFrame:
    """Tag each row by the lists of rectangles; by a broadcast join where the lists of a level are small."""
    payload = [F.col(f"`{c}`") for c in df.columns if c != cell]
    box = Box(*known.agg(F.min("x0"), F.max("x1"), F.min("y0"), F.max("y1")).first())
    listed = rectangle_lists(known, box)
    entry = F.struct(*RECTANGLE)
    lists = session.cut_lineage(
        listed.withColumn("size", session.row_bytes(known))
        .groupBy("level", "tx", "ty")
        .agg(F.sort_array(F.collect_list(entry)).alias("list"), F.sum("size").alias("size"))
    )
    sizes = {r["level"]: r["size"] for r in lists.groupBy("level").agg(F.sum("size").alias("size")).collect()}

    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    rows = df.withColumns({"_px": px, "_py": py})
    kept = inside(F.col("_px"), F.col("_py"), box)
    tiles = {"_i": _tile(F.col("_px"), box.x0, box.x1), "_j": _tile(F.col("_py"), box.y0, box.y1)}
    rows = rows.withColumns({name: F.when(kept, at) for name, at in tiles.items()})
    holds = lambda r: F.col("_px").between(r["x0"], r["x1"]) & F.col("_py").between(r["y0"], r["y1"])
    for number, (level, size) in enumerate(sorted(sizes.items())):
        here = lists.filter(F.col("level") == level).select(
            F.col("tx").alias("_tx"), F.col("ty").alias("_ty"), F.col("list").alias("_list")
        )
        on = (F.shiftright("_i", FINEST - level) == here["_tx"]) & (F.shiftright("_j", FINEST - level) == here["_ty"])
        rows = session.join_cell_table(rows, here, on, "left", size)
        found = F.get(F.filter("_list", holds), F.lit(0))
        found = F.when(found.isNotNull(), F.struct(found["pos"].alias("pos"), found["cell"].alias("cell")))
        # A row carries the first one so far, not one for every level.
        rows = rows.withColumn("_at", F.least("_at", found) if number else found).drop("_tx", "_ty", "_list")
    return rows.select(*payload, F.coalesce(F.col("_at")["cell"], F.lit(NO_CELL)).alias(cell))


def store_tree(tree: QuadTree, path: str, mode: str = "error") -> None:
    """Keep a finished split beside the partitions written by it."""
    spark = tree.cells.sparkSession
    tree.cells.write.mode(mode).parquet(f"{path}/cells")
    sizes = ",".join(f"{depth}:{n}" for depth, n in sorted(tree.leaf_depths.items()))
    box = tuple(tree.box) if tree.box else (None,) * 4
    about = spark.createDataFrame(
        [(*box, tree.threshold, tree.stop, sizes)],
        "x0 double, x1 double, y0 double, y1 double, threshold long, stop int, sizes string",
    )
    about.coalesce(1).write.mode(mode).parquet(f"{path}/about")


def load_tree(spark: SparkSession, path: str) -> QuadTree:
    """A split that was stored; its :meth:`QuadTree.assign` places new rows."""
    about = spark.read.parquet(f"{path}/about").first()
    box = None if about.x0 is None else Box(about.x0, about.x1, about.y0, about.y1)
    sizes = dict(tuple(map(int, part.split(":"))) for part in about.sizes.split(",") if part)
    return QuadTree(box, about.threshold, about.stop, spark.read.parquet(f"{path}/cells"), sizes)
