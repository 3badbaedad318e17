"""Column expressions over points and rectangles."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Up to this depth the edges of the cells (2**depth + 1 per axis) travel in the plan
# as one array literal per axis.
EDGE_TABLE_DEPTH = 12
# Index of points that lie in no cell.
OUTSIDE = -1
# Deepest cells whose two indexes still fit an int column each.
DEEPEST = 30


class Box(NamedTuple):
    """Closed rectangle."""

    x0: float
    x1: float
    y0: float
    y1: float


def usable(x: Column, y: Column) -> Column:
    """True for two finite coordinates (Spark orders NaN above infinity)."""
    return (F.abs(x) < float("inf")) & (F.abs(y) < float("inf"))


def inside(x: Column, y: Column, box: Box) -> Column:
    return x.between(box.x0, box.x1) & y.between(box.y0, box.y1)


def squared_distance(x: Column, y: Column, cx, cy) -> Column:
    dx, dy = x - cx, y - cy
    return dx * dx + dy * dy


def _clamped(guess: Column, n: int) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(n - 1), guess)).cast("int")


def _corrected(guess: Column, value: Column, edge, n: int) -> Column:
    """Move a guessed index by at most one so that edge(i) < value <= edge(i + 1)."""
    return (
        F.when((guess > 0) & (value <= edge(guess)), guess - 1)
        .when((guess < n - 1) & (value > edge(guess + 1)), guess + 1)
        .otherwise(guess)
    )


def uniform_index(value: Column, low: float, high: float, n: int) -> Column:
    """Index of the first of ``n`` equal closed slices holding ``value``.

    A value on an inner edge belongs to the lower slice. The last slice takes what
    rounding leaves above its upper edge. Where rounding moves edges by more than a small
    part of a slice, or lets several fall together, the sorted edges are searched.
    """
    step = (high - low) / n
    if step == 0:
        return F.lit(0)
    uppers = low + np.arange(1, n + 1) * step
    if not _well_apart(np.concatenate([[low], uppers])):
        return _searched(uppers, n)(value)
    guess = _clamped(F.ceil((value - low) / step) - 1, n)
    return _corrected(guess, value, lambda i: F.lit(low) + i * F.lit(step), n)


def _searched(uppers: np.ndarray, n: int):
    """Number of upper edges below a value; the function holds plain numbers only."""

    @F.pandas_udf("int")
    def search(values: pd.Series) -> pd.Series:
        found = np.searchsorted(uppers, values.to_numpy(dtype="float64", na_value=np.nan), "left")
        return pd.Series(np.minimum(found, n - 1).astype("int32"))

    return search


def uniform_name(i: Column, j: Column, n: int) -> Column:
    """Cell name: both indexes in a row, separated once a pair could be read two ways."""
    return F.concat_ws("" if n <= 10 else "_", i.cast("string"), j.cast("string"))


def axis_edges(low: float, high: float, depth: int) -> np.ndarray:
    """Edges of one axis after ``depth`` halvings, each middle being (a + b) / 2."""
    edges = np.array([low, high])
    for _ in range(depth):
        halved = np.empty(2 * len(edges) - 1)
        halved[0::2] = edges
        halved[1::2] = (edges[:-1] + edges[1:]) / 2
        edges = halved
    return edges


def with_quad_index(df: DataFrame, box: Box, depth: int, x: str, y: str) -> DataFrame:
    """Add ``qx`` and ``qy``, the column and row of the depth-``depth`` cell of each point.

    Bit ``k`` from the top tells which half was taken at split ``k``. A point exactly on
    a vertical middle goes to the low side in the lower half of its cell and to the high
    side in the upper half; one on a horizontal middle goes to the lower half. Points
    outside the box get -1.
    """
    edges = _edge_tables(box, depth)
    if edges is None:
        return _quad_index_by_halving(df, box, depth, x, y)
    # One column per step, so that each is computed once.
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    kept, (columns, rows) = inside(px, py, box), edges
    step = df.withColumns({"qx": _guessed_slot(px, columns), "qy": _guessed_slot(py, rows)})
    step = step.withColumns(
        {"qx": _true_slot(F.col("qx"), px, columns), "qy": _true_slot(F.col("qy"), py, rows)}
    )
    return step.withColumns(
        {
            "qx": _or_outside(F.when(kept, _settle_tie(F.col("qx"), F.col("qy"), px, columns))),
            "qy": _or_outside(F.when(kept, F.col("qy"))),
        }
    )


def quad_index(box: Box, depth: int, x: str, y: str) -> tuple[Column, Column] | None:
    """The two indexes of :func:`with_quad_index` as single expressions.

    They repeat work, but as join keys they spare wide rows the copies that new columns
    cost. ``None`` if the depth or the axes do not allow it.
    """
    edges = _edge_tables(box, depth)
    if edges is None:
        return None
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    kept, (columns, rows) = inside(px, py, box), edges
    qx, qy = _true_slot(_guessed_slot(px, columns), px, columns), _true_slot(_guessed_slot(py, rows), py, rows)
    return _or_outside(F.when(kept, _settle_tie(qx, qy, px, columns))), _or_outside(F.when(kept, qy))


def _or_outside(index: Column) -> Column:
    """Never null, so that no join adds a null test that would repeat the expression."""
    return F.coalesce(index, F.lit(OUTSIDE))


def _edge_tables(box: Box, depth: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Edges of both axes, if they are few and lie far enough apart to be found by arithmetic."""
    if not 0 <= depth <= DEEPEST:
        raise ValueError(f"depth must be between 0 and {DEEPEST}")
    if depth > EDGE_TABLE_DEPTH:
        return None
    columns, rows = axis_edges(box.x0, box.x1, depth), axis_edges(box.y0, box.y1, depth)
    return (columns, rows) if _well_apart(columns) and _well_apart(rows) else None


def _well_apart(edges: np.ndarray) -> bool:
    """Whether rounding can shift an edge by no more than a small part of a cell."""
    return bool(np.diff(edges).min() > 16 * np.spacing(np.abs(edges).max()))


def _inner_edges(edges: np.ndarray) -> Column:
    """The edges as an array, with nothing beyond the outer ones."""
    texts = [repr(edge) for edge in edges.tolist()]
    texts[0], texts[-1] = "-Infinity", "Infinity"
    return F.split(F.lit(",".join(texts)), ",").cast("array<double>")


def _guessed_slot(value: Column, edges: np.ndarray) -> Column:
    n = len(edges) - 1
    return _clamped(F.ceil((value - float(edges[0])) * (n / float(edges[-1] - edges[0]))) - 1, n)


def _true_slot(guess: Column, value: Column, edges: np.ndarray) -> Column:
    """Index i with edges[i] < value <= edges[i + 1], at most one off the guess.

    The first slot takes the lowest edge.
    """
    edge = _inner_edges(edges)
    too_low, too_high = value > F.get(edge, guess + 1), value <= F.get(edge, guess)
    return guess + too_low.cast("int") - too_high.cast("int")


def _settle_tie(qx: Column, qy: Column, px: Column, columns: np.ndarray) -> Column:
    """Move a point on the edge between two columns to the higher one if its row says so.

    The lowest set bit of the edge number is the split that drew the edge, and the same
    bit of qy is the half taken there.
    """
    edge = qx + 1
    moves = (px == F.get(_inner_edges(columns), edge)) & (qy.bitwiseAND(edge).bitwiseAND(-edge) != 0)
    return qx + moves.cast("int")


def _quad_index_by_halving(df: DataFrame, box: Box, depth: int, x: str, y: str) -> DataFrame:
    """One vectorised pass per split, for deep cells and axes too short to divide.

    The function sent to the executors holds plain numbers and nothing of this package.
    """
    x0, x1, y0, y1 = map(float, box)

    @F.pandas_udf("struct<qx: int, qy: int>")
    def halve(xs: pd.Series, ys: pd.Series) -> pd.DataFrame:
        px, py = xs.to_numpy(), ys.to_numpy()
        left, right = np.full(len(px), x0), np.full(len(px), x1)
        below, above = np.full(len(py), y0), np.full(len(py), y1)
        qx, qy = np.zeros(len(px), "int32"), np.zeros(len(py), "int32")
        for _ in range(depth):
            mx, my = (left + right) / 2, (below + above) / 2
            up = py > my
            east = np.where(up, px >= mx, px > mx)
            left, right = np.where(east, mx, left), np.where(east, right, mx)
            below, above = np.where(up, my, below), np.where(up, above, my)
            qx, qy = 2 * qx + east, 2 * qy + up
        return pd.DataFrame({"qx": qx, "qy": qy})

    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    # Python gets every row of a batch, so points without a cell go in as a corner of the box.
    kept = F.coalesce(inside(px, py, box), F.lit(False))
    quad = halve(F.when(kept, px).otherwise(F.lit(x0)), F.when(kept, py).otherwise(F.lit(y0)))
    return (
        df.withColumn("_quad", quad)
        .withColumns({axis: _or_outside(F.when(kept, F.col(f"_quad.{axis}"))) for axis in ("qx", "qy")})
        .drop("_quad")
    )


def quad_path(depth: Column, qx: Column, qy: Column) -> Column:
    """Cell id: ``_`` and one digit per split, counter-clockwise from the low corner.

    The digit is 2 * (upper half) + (halves differ), so reading the binary numbers qy and
    qx XOR qy in base 4 and adding them gives all digits at once.
    """

    def base4(value: Column) -> Column:
        return F.conv(F.bin(value), 4, 10).cast("long")

    digits = F.conv((base4(qy) * 2 + base4(qx.bitwiseXOR(qy))).cast("string"), 10, 4)
    return F.concat(F.lit("_"), F.lpad(digits, depth, "0"))


def quadrant(x: Column, y: Column, mx, my) -> Column:
    """Quadrant 0-3 of a point around a middle; the first closed quadrant wins."""
    return (
        F.when((x <= mx) & (y <= my), 0)
        .when((x >= mx) & (y <= my), 1)
        .when((x >= mx) & (y >= my), 2)
        .when((x <= mx) & (y >= my), 3)
    )


def quarters(x0: Column, x1: Column, y0: Column, y1: Column) -> Column:
    """The four sub-rectangles of a rectangle, as an array in digit order."""
    mx, my = (x0 + x1) / 2, (y0 + y1) / 2

    def rect(a: Column, b: Column, c: Column, d: Column) -> Column:
        return F.struct(a.alias("x0"), b.alias("x1"), c.alias("y0"), d.alias("y1"))

    return F.array(rect(x0, mx, y0, my), rect(mx, x1, y0, my), rect(mx, x1, my, y1), rect(x0, mx, my, y1))


def path_box(path: Column, box: Box) -> Column:
    """Rectangle of a digit string, by narrowing the root box once per digit.

    For tables of cells only: a fold runs outside generated code.
    """
    root = F.struct(*[F.lit(float(v)).alias(name) for name, v in box._asdict().items()])

    def narrow(at: Column, digit: Column) -> Column:
        part = F.get(quarters(at["x0"], at["x1"], at["y0"], at["y1"]), digit.cast("int"))
        return F.when(digit.rlike("^[0-3]$"), part).otherwise(
            F.raise_error(F.concat(F.lit("not a cell digit: "), digit))
        )

    return F.aggregate(F.filter(F.split(path, ""), lambda c: c != ""), root, narrow)
