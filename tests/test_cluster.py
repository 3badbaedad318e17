import hashlib
import random
from pathlib import Path

import numpy as np

from starloom import session
from starloom.operators import cluster as C


def blobs(seed, centres, size):
    rng = random.Random(seed)
    return [(rng.gauss(cx, 0.3), rng.gauss(cy, 0.3)) for cx, cy in centres for _ in range(size)]


def test_nearest_centre_and_sizes(spark):
    rng = np.random.default_rng(3)
    points, centres = rng.uniform(0, 10, (400, 2)), rng.uniform(0, 10, (7, 2))
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "id int, x double, y double")
    got = C.nearest_centre(df, [tuple(map(float, c)) for c in centres], "x", "y")
    expected = ((points[:, None] - centres[None]) ** 2).sum(2).argmin(1).tolist()
    assert [r.cluster for r in got.orderBy("id").collect()] == expected
    sizes = [r.n for r in C.cluster_sizes(got).collect()]
    assert sizes == sorted(sizes) and sum(sizes) == 400


def test_lowest_centre_wins_a_tie(spark):
    df = spark.createDataFrame([(1.0, 0.0)], "x double, y double")
    assert C.nearest_centre(df, [(2.0, 0.0), (0.0, 0.0)], "x", "y").first().cluster == 0
    assert C.nearest_centre(df, [(0.0, 0.0)], "x", "y").first().cluster == 0


def test_fit_is_a_fixed_point_of_the_means(spark):
    points = blobs(4, [(0, 0), (10, 0), (0, 10)], 60)
    rows = [(i, *p) for i, p in enumerate(points)] + [(999, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "id int, x double, y double")
    model = C.fit_clusters(df, "x", "y", 3, seed=5)
    found = C.predict_clusters(df, model, "x", "y").orderBy("id").collect()
    assert len(found) == len(rows) and found.pop().cluster is None
    labels = np.array([r.cluster for r in found])
    centres = np.array(model.clusterCenters())
    xy = np.array(points)
    assert (((xy[:, None] - centres[None]) ** 2).sum(2).argmin(1) == labels).all()
    for k in range(3):
        assert np.allclose(xy[labels == k].mean(0), centres[k], atol=1e-6)
    sizes = {r.cluster: r.n for r in C.cluster_sizes(C.predict_clusters(df, model, "x", "y")).collect()}
    assert sizes == {None: 1, **dict(enumerate(np.bincount(labels).tolist()))}
    assert sorted(model.summary.clusterSizes) == sorted(np.bincount(labels).tolist())


def lloyd(points, centres, rounds):
    """The rounds with plain sums."""
    xy, at = np.array(points), np.array(centres, float)
    for _ in range(rounds):
        near = ((xy[:, None] - at[None]) ** 2).sum(2).argmin(1)
        at = np.array([xy[near == k].mean(0) if (near == k).any() else at[k] for k in range(len(at))])
    return at, ((xy[:, None] - at[None]) ** 2).sum(2).min(1).sum()


def test_all_rounds_of_several_starts(spark):
    rng = random.Random(12)
    points = [(rng.uniform(0, 1000), rng.uniform(-5, 5)) for _ in range(700)]
    df = spark.createDataFrame([*points, (float("inf"), 0.0), (None, 1.0)], "x double, y double").repartition(5)
    starts = C.draw_starts(df, "x", "y", 6, 4, seed=3)
    assert len({tuple(s) for s in starts}) == 4 and all(p in points for s in starts for p in s)
    fits = [lloyd(points, s, 10) for s in starts]
    best = C.fit_lloyd(df, "x", "y", starts)
    want = min(range(4), key=lambda k: fits[k][1])
    assert best.start == want and np.allclose(best.centres, fits[want][0], atol=1e-6)
    short = C.fit_lloyd(df, "x", "y", starts[:1], rounds=3)
    assert np.allclose(short.centres, lloyd(points, starts[0], 3)[0], atol=1e-6) and short.rounds == 3
    assert not np.allclose(short.centres, lloyd(points, starts[0], 2)[0], atol=1e-6)
    # Whatever order and partitioning the rows have, the centres are the same to the last bit.
    for parts in (1, 3, 8):
        assert C.fit_lloyd(df.orderBy("y").repartition(parts), "x", "y", starts) == best


def test_centres_without_points_stay(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0)], "x double, y double")
    fit = C.fit_lloyd(df, "x", "y", [[(0.0, 0.0), (0.0, 0.0), (50.0, 50.0)]])
    assert fit.centres == [(0.5, 0.0), (0.0, 0.0), (50.0, 50.0)] or fit.centres[1:] == [(0.0, 0.0), (50.0, 50.0)]
    assert C.fit_lloyd(df.limit(0), "x", "y", [[(1.0, 2.0)]]).centres == [(1.0, 2.0)]


def test_starts_have_the_least_hashes(spark):
    rng = random.Random(8)
    points = [(k, rng.uniform(0, 9), float(rng.randint(0, 3))) for k in range(300)] + [(300, None, 1.0), (301, float("nan"), 1.0)]
    df = spark.createDataFrame(points, "id int, x double, y double").repartition(7)
    turn = lambda start, key: hashlib.md5(f"5:{start}:{key}".encode()).hexdigest()
    want = [[p[1:] for p in sorted(points[:300], key=lambda p: turn(start, p[0]))[:4]] for start in range(3)]
    assert C.draw_starts(df, "x", "y", 4, 3, "id", seed=5) == want
    assert C.draw_starts(df.limit(0), "x", "y", 4, 3, "id") == [[], [], []]


def test_a_fit_leaves_no_copy_of_its_points(spark):
    folder = Path(session.shared_folder(spark))
    held = lambda: sum(f.stat().st_size for f in folder.rglob("*") if f.is_file())
    df = spark.range(20_000).selectExpr("rand(1) AS x", "rand(2) AS y")
    before = held()
    assert C.fit_lloyd(df, "x", "y", C.draw_starts(df, "x", "y", 3, 2)).rounds > 1
    assert held() - before < 1000
