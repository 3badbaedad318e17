"""Adaptive quadtree: split every cell that holds more than a threshold of rows.

Which leaf a row ends in depends only on its path and on the number of rows in every
prefix of that path. So the rows are counted once, at a deep level; the counts of all
shallower cells are sums of those, and the splitting is decided on the table of cells.
Two scans of two columns replace one pass over the rows per round; only rows of cells
still too heavy at that level are counted again further down.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom import session
from starloom.functions.geometry import (
    DEEPEST,
    Box,
    inside,
    path_box,
    quad_index,
    quad_path,
    quarters,
    with_quad_index,
)
from starloom.operators.bbox import measure_box

# Depth at which all rows are counted.
FIRST_COUNT = 10
# Leaves that are listed together where the table of leaves is too large for a broadcast.
BUNDLE_LEAVES = 64
# From about this many columns on, copying a row costs more than computing its cell twice.
WIDE_ROW = 30
CELL_COLUMNS = "depth int, qx int, qy int, cell string, n bigint"


@dataclass(frozen=True)
class QuadTree:
    """A finished split.

    ``cells`` holds every cell with rows that the rounds looked at (``depth, qx, qy, cell,
    n``); ``leaf_depths`` says how many of them are leaves, per depth.
    """

    box: Box | None
    threshold: int
    stop: int
    cells: DataFrame
    leaf_depths: dict[int, int]

    @property
    def depth(self) -> int:
        return max(self.leaf_depths, default=0)

    @property
    def leaf_count(self) -> int:
        return sum(self.leaf_depths.values())

    def _is_leaf(self) -> Column:
        return (F.col("n") <= self.threshold) | (F.col("depth") == self.stop)

    def leaves(self) -> DataFrame:
        """The final cells that hold rows, with their counts and rectangles."""
        found = self.cells.filter(self._is_leaf()).select("cell", "depth", "n")
        if self.box is None:
            return found.select("*", *[F.lit(None).cast("double").alias(c) for c in Box._fields])
        return found.withColumn("rect", path_box(F.substring("cell", 2, 64), self.box)).select(
            "cell", "depth", "n", "rect.*"
        )

    def counts(self) -> DataFrame:
        """Rows per leaf: ``cell, n``."""
        return self.cells.filter(self._is_leaf()).select("cell", "n")

    def heavy(self, depth: int) -> DataFrame:
        """Cells of one depth above the threshold: the ones the next round would split."""
        return self.cells.filter((F.col("depth") == depth) & (F.col("n") > self.threshold))

    def assign(
        self, df: DataFrame, x: str, y: str, labels: DataFrame | None = None, cell: str = "cell"
    ) -> DataFrame:
        """Tag each row with its leaf, replacing an earlier tag. Rows outside the box get a null.

        ``labels`` (``cell`` plus any columns, one row per leaf) adds those columns to the
        rows in the same join, such as the merged group of the leaf.
        """
        leaves = self.cells.filter(self._is_leaf()).select("depth", "qx", "qy", F.col("cell").alias(cell))
        if labels is not None:
            leaves = session.cut_lineage(leaves.join(labels.withColumnRenamed("cell", cell), cell, "left"))
        extra = [c for c in leaves.columns if c not in ("depth", "qx", "qy")]
        if self.box is None:
            kinds = dict(leaves.dtypes)
            return df.withColumns({c: F.lit(None).cast(kinds[c]) for c in extra})

        payload = [c for c in df.columns if c not in extra]
        tiers = join_depths(_sizes(leaves))
        if sum(size for _, _, size in tiers) > session.BROADCAST_BYTES:
            found = _tag_by_bundles(df, leaves, self.box, self.depth, x, y)
            return found.select(*payload, *[F.col(f"_leaf.{c}").alias(c) for c in extra])
        tagged, keys = _keyed(df, self.box, self.depth, x, y)
        tagged = _tag_by_tiers(tagged, leaves, tiers, keys, self.depth, extra)
        return tagged.select(*payload, *[F.col(f"_at_{c}").alias(c) for c in extra])


def _sizes(leaves: DataFrame) -> dict[int, int]:
    """Bytes of the leaves in a broadcast table, per depth."""
    sizes = leaves.groupBy("depth").agg(F.sum(session.row_bytes(leaves)).alias("size")).collect()
    return {row["depth"]: row["size"] for row in sizes}


def _tag_by_tiers(
    rows: DataFrame,
    leaves: DataFrame,
    tiers: list[tuple[int, list[int], int]],
    keys: tuple[Column, Column],
    depth: int,
    extra: list[str],
) -> DataFrame:
    """Add ``_at_<column>`` of the leaf of each row, by one broadcast join per tier."""
    for number, (top, depths, size) in enumerate(tiers):
        table = _spread(leaves.filter(F.col("depth").isin(depths)), top).select(
            F.col("qx").alias("_kx"), F.col("qy").alias("_ky"), *[F.col(c).alias(f"_{number}_{c}") for c in extra]
        )
        kx, ky = (F.shiftright(key, depth - top) for key in keys)
        on = (kx == table["_kx"]) & (ky == table["_ky"])
        rows = session.join_cell_table(rows, table, on, "left", size).drop("_kx", "_ky")
    found = {f"_at_{c}": F.coalesce(*[F.col(f"_{k}_{c}") for k in range(len(tiers))]) for c in extra}
    return rows.withColumns(found).drop(*[f"_{k}_{c}" for k in range(len(tiers)) for c in extra])


def _tag_by_bundles(df: DataFrame, leaves: DataFrame, box: Box, depth: int, x: str, y: str) -> DataFrame:
    """Add ``_leaf``, a structure of the leaf's columns, where the leaves are too many to broadcast.

    Leaves that lie together are bundled under the highest cell with few enough of them.
    A row finds its bundle by broadcast, then the rows are shuffled once, to the list of
    leaves of their bundle, and look through it.
    """
    bundles, size = None, BUNDLE_LEAVES
    while bundles is None:
        found = session.cut_lineage(_bundled(leaves, size))
        places = found.select(F.col("_bd").alias("depth"), F.col("_bx").alias("qx"), F.col("_by").alias("qy"))
        places = places.withColumn("bundle", F.col("depth"))
        tiers = join_depths(_sizes(places))
        if tiers[0][0] == 0 and len(tiers) == 1 or sum(t[2] for t in tiers) <= session.BROADCAST_BYTES:
            bundles = found
        size *= 4
    rows = with_quad_index(df, box, depth, x, y)
    if tiers[0][0] == 0:  # one bundle
        rows = rows.withColumn("_at_bundle", F.lit(0))
    else:
        rows = _tag_by_tiers(rows, places, tiers, (F.col("qx"), F.col("qy")), depth, ["bundle"])
    on = (
        (F.col("_at_bundle") == bundles["_bd"])
        & (F.expr(f"shiftright(qx, {depth} - _at_bundle)") == bundles["_bx"])
        & (F.expr(f"shiftright(qy, {depth} - _at_bundle)") == bundles["_by"])
    )
    joined = rows.join(bundles, on, "left")
    own = F.expr(
        f"get(filter(_leaves, leaf -> shiftright(qx, {depth} - leaf.depth) = leaf.qx"
        f" and shiftright(qy, {depth} - leaf.depth) = leaf.qy), 0)"
    )
    return joined.withColumn("_leaf", own)


def _bundled(leaves: DataFrame, most: int) -> DataFrame:
    """``_bd, _bx, _by, _leaves``: the highest cells with at most ``most`` leaves, and those."""
    above = leaves.select("depth", "qx", "qy", F.explode(F.sequence(F.lit(0), F.col("depth"))).alias("_bd"))
    above = above.withColumns(
        {"_bx": F.expr("shiftright(qx, depth - _bd)"), "_by": F.expr("shiftright(qy, depth - _bd)")}
    )
    small = above.groupBy("_bd", "_bx", "_by").agg(F.count("*").alias("_n")).filter(F.col("_n") <= most)
    place = F.min(F.struct("_bd", "_bx", "_by")).alias("_place")
    places = above.join(small, ["_bd", "_bx", "_by"]).groupBy("depth", "qx", "qy").agg(place)
    listed = leaves.join(places, ["depth", "qx", "qy"])
    return listed.groupBy("_place").agg(F.collect_list(F.struct(*leaves.columns)).alias("_leaves")).select(
        "_place.*", "_leaves"
    )


def _keyed(df: DataFrame, box: Box, depth: int, x: str, y: str) -> tuple[DataFrame, tuple[Column, Column]]:
    """Rows and their cell indexes: as new columns, or as expressions where rows are wide."""
    keys = quad_index(box, depth, x, y) if len(df.columns) > WIDE_ROW else None
    if keys is None:
        df, keys = with_quad_index(df, box, depth, x, y), (F.col("qx"), F.col("qy"))
    return df, keys


def join_depths(sizes: dict[int, int], limit: int | None = None) -> list[tuple[int, list[int], int]]:
    """Group leaf depths so that each group needs one join: ``(depth of the key, depths, bytes)``.

    A leaf at depth d equals 4 ** (t - d) cells at a deeper level t, so shallow leaves can
    join on the key of deeper ones. A group grows while the cells it lists stay within
    the limit for a broadcast. ``sizes`` has the exact bytes of the leaves per depth.
    """
    limit = session.BROADCAST_BYTES if limit is None else limit
    groups: list[tuple[int, list[int], int]] = []
    for depth, size in sorted(sizes.items()):
        if groups:
            top, depths, listed = groups[-1]
            together = listed * 4 ** (depth - top) + size
            if together <= limit:
                groups[-1] = (depth, [*depths, depth], together)
                continue
        groups.append((depth, [depth], size))
    return groups


def _spread(leaves: DataFrame, depth: int) -> DataFrame:
    """List each leaf once per depth-``depth`` cell it covers."""
    side = F.sequence(F.lit(0), F.expr(f"shiftleft(1, {depth} - depth) - 1"))
    wide = leaves.withColumn("_i", F.explode(side)).withColumn("_j", F.explode(side))
    return wide.withColumns(
        {
            "qx": F.expr(f"shiftleft(qx, {depth} - depth) + _i"),
            "qy": F.expr(f"shiftleft(qy, {depth} - depth) + _j"),
        }
    ).drop("_i", "_j")


def count_cells(df: DataFrame, box: Box, depth: int, x: str, y: str) -> DataFrame:
    """Rows per depth-``depth`` cell, ``qx, qy, n``: the only aggregation over the rows."""
    points = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    held = points.filter(inside(F.col("x"), F.col("y"), box))
    return with_quad_index(held, box, depth, "x", "y").groupBy("qx", "qy").agg(F.count("*").alias("n"))


def cell_pyramid(counts: DataFrame, top: int, depth: int) -> DataFrame:
    """Rows per cell at every level from ``top`` down to ``depth``, the level of ``counts``."""
    levels = counts.withColumn("depth", F.explode(F.sequence(F.lit(top), F.lit(depth))))
    return levels.groupBy(
        "depth",
        F.expr(f"shiftright(qx, {depth} - depth)").alias("qx"),
        F.expr(f"shiftright(qy, {depth} - depth)").alias("qy"),
    ).agg(F.sum("n").alias("n"))


def _children_of_heavy(pyramid: DataFrame, threshold: int) -> DataFrame:
    """The cells that the rounds create: those whose parent is above the threshold."""
    siblings = Window.partitionBy("depth", F.shiftright("qx", 1), F.shiftright("qy", 1))
    path = quad_path(F.col("depth"), F.col("qx"), F.col("qy"))
    return (
        pyramid.withColumn("_parent", F.sum("n").over(siblings))
        .filter((F.col("depth") == 0) | (F.col("_parent") > threshold))
        .select("depth", "qx", "qy", path.alias("cell"), "n")
    )


def build_quadtree(
    df: DataFrame,
    x: str,
    y: str,
    threshold: int,
    max_depth: int = DEEPEST,
    max_heavy_cells: int | None = None,
    box: Box | None = None,
) -> QuadTree:
    """Split cells with more than ``threshold`` rows, at most ``max_depth`` times.

    With the default depth a cell stays above the threshold only if its points coincide,
    or nearly so.

    ``max_heavy_cells`` also stops the splitting at the first level with more heavy cells
    than that. A known ``box`` saves the pass that measures it.

    The first count goes down to depth 10 at most. Only if cells of that level are still
    heavy are their rows, and no others, counted again at a deeper level.
    """
    box = box or measure_box(df, x, y)
    if box is None:
        empty = df.sparkSession.createDataFrame([], CELL_COLUMNS)
        return QuadTree(None, threshold, 0, empty, {})

    rows = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    reached, levels, top, stop = None, {}, 0, max_depth
    depth, jump, held, fewer = min(FIRST_COUNT, max_depth), 1, None, None
    while True:
        pyramid = cell_pyramid(count_cells(rows, box, depth, "x", "y"), top, depth)
        found = session.cut_lineage(_children_of_heavy(pyramid, threshold))
        reached = found if reached is None else reached.unionByName(found)
        heavy = F.col("n") > threshold
        # One row per level.
        levels |= {
            r.depth: r
            for r in found.groupBy("depth")
            .agg(
                F.count("*").alias("cells"),
                F.count_if(heavy).alias("heavy"),
                F.max("n").alias("most"),
                F.sum(F.when(heavy, F.col("n"))).alias("rows"),
            )
            .collect()
        }
        crowded = [] if max_heavy_cells is None else [d for d, r in levels.items() if r.heavy > max_heavy_cells]
        stop = min(crowded, default=max_depth)
        if depth >= stop or depth not in levels or not levels[depth].heavy:
            break
        # Rows that are still to be split are stored once they are half as many as before;
        # others on top of them change no cell that is looked at.
        last = levels[depth]
        if held is None or last.rows * 2 <= held:
            rows = session.cut_lineage(_rows_of_cells(rows, found.filter(heavy), box, depth, "x", "y"))
            held = last.rows
        # As many levels as the heaviest cell needs if its rows lie evenly, and one more; twice
        # as many as before where that was not enough.
        needed = math.ceil(math.log(last.most / max(threshold, 1), 4)) + 1
        jump = max(needed, 2 * jump) if fewer is not None and last.most * 2 > fewer else needed
        fewer = last.most
        top, depth = depth + 1, min(depth + max(1, jump), max_depth)
    kept = {d: r.cells - (r.heavy if d < stop else 0) for d, r in levels.items() if d <= stop}
    return QuadTree(
        box, threshold, stop, reached.filter(F.col("depth") <= stop), {d: n for d, n in kept.items() if n}
    )


def split_step(cells: DataFrame, threshold: int) -> DataFrame:
    """One round on a grid ``cell, x0, x1, y0, y1, n``: four children for each heavy cell.

    The result is the new grid, empty children included, without counts.
    """
    whole = F.array(F.struct("cell", "x0", "x1", "y0", "y1"))
    parts = quarters(F.col("x0"), F.col("x1"), F.col("y0"), F.col("y1"))
    children = F.transform(
        parts,
        lambda r, i: F.struct(
            F.concat(F.col("cell"), i.cast("string")).alias("cell"),
            r["x0"].alias("x0"),
            r["x1"].alias("x1"),
            r["y0"].alias("y0"),
            r["y1"].alias("y1"),
        ),
    )
    return cells.select(F.inline(F.when(F.col("n") > threshold, children).otherwise(whole)))


def _rows_of_cells(df: DataFrame, cells: DataFrame, box: Box, depth: int, x: str, y: str) -> DataFrame:
    """Rows lying in the given cells of one depth."""
    wanted = cells.filter(F.col("depth") == depth).select(F.col("qx").alias("_kx"), F.col("qy").alias("_ky"))
    rows, (kx, ky) = _keyed(df, box, depth, x, y)
    on = (kx == wanted["_kx"]) & (ky == wanted["_ky"])
    return session.join_cell_table(rows, wanted, on, "left_semi").select(*df.columns)


def heavy_rows(df: DataFrame, tree: QuadTree, depth: int, x: str, y: str) -> DataFrame:
    """Rows whose cell is still above the threshold at round ``depth``."""
    if tree.box is None:
        return df.filter(F.lit(False))
    return _rows_of_cells(df, tree.heavy(depth), tree.box, depth, x, y)
