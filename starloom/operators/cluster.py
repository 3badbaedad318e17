"""K-means on the two coordinates."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom import session
from starloom.functions.geometry import squared_distance, usable
from starloom.operators.bbox import measure_box

Centres = Sequence[tuple[float, float]]
# Bits that the largest coordinate takes as a whole number in the sums, and where those are cut in two.
SUM_BITS, HALF = 46, 1 << 26


def fit_clusters(df: DataFrame, x: str, y: str, k: int = 10, seed: int | None = None) -> KMeansModel:
    """Ten rounds from a random start, on the rows with finite coordinates."""
    kmeans = KMeans(k=k, maxIter=10, initMode="random")
    if seed is not None:
        kmeans.setSeed(seed)
    points = df.select(x, y).filter(usable(F.col(x).cast("double"), F.col(y).cast("double")))
    return kmeans.fit(VectorAssembler(inputCols=[x, y], outputCol="features").transform(points))


def predict_clusters(df: DataFrame, model: KMeansModel, x: str, y: str, cluster: str = "cluster") -> DataFrame:
    """Every row with the cluster of its point."""
    return nearest_centre(df, [tuple(map(float, c)) for c in model.clusterCenters()], x, y, cluster)


class Fit(NamedTuple):
    """The best of several starts: its number, its final centres and the sum of squared distances to them."""

    start: int
    centres: list[tuple[float, float]]
    cost: int
    rounds: int


def draw_starts(df: DataFrame, x: str, y: str, k: int, starts: int, *keys: str, seed: int = 0) -> list[list[tuple]]:
    """For each start the points of ``k`` rows, drawn by the hash of the start's number and the row's keys.

    A task keeps the rows with the least hashes as it reads, ``k`` per start, and sorts or stores no others.
    """
    points = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), *[F.col(c) for c in keys])
    points = points.filter(usable(F.col("x"), F.col("y")))
    hashed = lambda start: F.md5(
        F.concat_ws(":", F.lit(seed), F.lit(start), *[F.col(c).cast("string") for c in keys or ("x", "y")])
    )
    each = [
        points.select(F.lit(start).alias("start"), hashed(start).alias("turn"), "x", "y").orderBy("turn", "x", "y").limit(k)
        for start in range(starts)
    ]
    drawn: list[list[tuple]] = [[] for _ in range(starts)]
    for row in sorted(reduce(DataFrame.unionByName, each).collect(), key=lambda r: (r.start, r.turn, r.x, r.y)):
        drawn[row.start].append((row.x, row.y))
    return drawn


def fit_lloyd(
    df: DataFrame, x: str, y: str, starts: Sequence[Centres], rounds: int = 10, scale: float | None = None
) -> Fit:
    """Move the centres of all starts to the means of their points, at most ``rounds`` times; keep the best.

    A round is one aggregation for all starts together, combined in each task to a row per start and
    centre. Coordinates are added up as whole multiples of ``1 / scale``, a power of two chosen by the box
    unless it is given, so the sums, and with them the centres, do not depend on the order of the rows or on how
    they are partitioned. A centre without points stays where it is; the least sum of squared
    distances wins, the first start on a tie. Rows without finite coordinates take no part.
    """
    points = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    with session.scratch(df.sparkSession) as store:
        # As Parquet the two columns take a fraction of what rows of a checkpoint take.
        held = store(points.filter(usable(F.col("x"), F.col("y"))), "points")
        return _best_fit(held, starts, rounds, scale)


def _best_fit(held: DataFrame, starts: Sequence[Centres], rounds: int, scale: float | None) -> Fit:
    far_scale = scale
    if scale is None:
        box = measure_box(held, "x", "y")
        size = math.ceil(math.log2(max(map(abs, box), default=1.0) or 1.0)) if box else 0
        scale, far_scale = 2.0 ** (SUM_BITS - size), 2.0 ** (SUM_BITS - 2 * size - 3)
    centres, done = [[tuple(map(float, c)) for c in start] for start in starts], 0
    while done < rounds:
        moved = [list(start) for start in centres]
        for row in _sums(held, centres, scale, far_scale):
            moved[row.start][row.cluster] = (float(row.sx) / row.n / scale, float(row.sy) / row.n / scale)
        done += 1
        if moved == centres:
            break
        centres = moved
    costs = [0] * len(centres)
    for row in _sums(held, centres, scale, far_scale):
        costs[row.start] += int(row.far)
    best = min(range(len(centres)), key=lambda k: (costs[k], k))
    return Fit(best, centres[best], costs[best], done)


def _sums(points: DataFrame, centres: Sequence[Centres], scale: float, far_scale: float) -> list:
    """Per start and centre the points nearest to it: how many, and the whole-number sums of what they measure."""
    found = points.mapInArrow(_measured(centres, scale, far_scale), "start int, cluster int, n long, high array<long>, low array<long>")
    both = lambda k: F.sum(F.col("high")[k].cast("decimal(38,0)") * HALF + F.col("low")[k])
    sums = [both(k).alias(name) for k, name in enumerate(("sx", "sy", "far"))]
    return found.groupBy("start", "cluster").agg(F.sum("n").alias("n"), *sums).collect()


def _measured(centres: Sequence[Centres], scale: float, far_scale: float):
    """Sums of each batch, in two halves that fit 64 bits; the function refers to nothing in this package."""
    starts, half = [np.array(start) for start in centres], float(HALF)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.asarray(column) for column in batch.columns)
            rows = []
            for number, start in enumerate(starts):
                far = (x[:, None] - start[:, 0]) ** 2 + (y[:, None] - start[:, 1]) ** 2
                nearest = far.argmin(axis=1)
                counts = np.bincount(nearest, minlength=len(start))
                values = (x * scale, y * scale, far[np.arange(len(x)), nearest] * far_scale)
                whole = [np.copysign(np.floor(np.abs(v) + 0.5), v) for v in values]
                sums = np.zeros((2, len(start), 3), np.int64)
                for k, value in enumerate(whole):
                    high = np.floor(value / half)
                    np.add.at(sums[0, :, k], nearest, high.astype(np.int64))
                    np.add.at(sums[1, :, k], nearest, (value - high * half).astype(np.int64))
                rows += [(number, k, int(counts[k]), *sums[:, k].tolist()) for k in np.flatnonzero(counts)]
            names = ["start", "cluster", "n", "high", "low"]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return measure


def nearest_centre(df: DataFrame, centres: Centres, x: str, y: str, cluster: str = "cluster") -> DataFrame:
    """Tag each row with the number of its nearest centre, the lowest number on a tie.

    Rows without finite coordinates keep a null.
    The centres are a handful of numbers, so they go into the expression: no join.
    """
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    names = [f"_d{i}" for i in range(len(centres))]
    measured = df.withColumns(
        {name: squared_distance(px, py, cx, cy) for name, (cx, cy) in zip(names, centres, strict=True)}
    )
    closest = F.least(*names) if len(names) > 1 else F.col(names[0])
    measured = measured.withColumn("_closest", closest)
    number = F.coalesce(
        *[F.when(F.col(name) == F.col("_closest"), F.lit(i)) for i, name in enumerate(names)]
    )
    return measured.withColumn(cluster, F.when(usable(px, py), number)).drop("_closest", *names)


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Rows per cluster, smallest first."""
    return df.groupBy(cluster).agg(F.count("*").alias("n")).orderBy("n", cluster)
