import random
from collections import Counter

import pytest
from models import box_of, children, holds, leaf_counts
from pyspark.sql import functions as F
from sample import SAMPLE

from starloom import session
from starloom.operators import quadtree as Q
from starloom.operators.ranges import decode_ranges

LIMIT = session.BROADCAST_BYTES
THRESHOLD_7 = {
    "_0000": 5, "_0003": 4, "_003": 1, "_21": 3, "_22": 7, "_33333330": 4, "_33333333": 6,
}
THRESHOLD_3 = {
    "_000000": 2, "_000003": 2, "_00003": 1, "_000330": 2, "_000333": 2, "_003": 1, "_21": 3, "_22111": 3,
    "_22112": 1, "_2212": 1, "_222": 2, "_333333300": 1, "_333333303": 3, "_333333330": 3, "_333333333": 3,
}


def table(spark, points):
    return spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id long, x double, y double")


def counts(tree):
    return {r.cell: r.n for r in tree.counts().collect()}


def assigned(tree, df):
    return [r.cell for r in tree.assign(df, "x", "y").orderBy("id").collect()]


def clumped(seed, size):
    """Dense clumps on a sparse background; a third of the points coincide."""
    rng = random.Random(seed)
    centres = [(rng.random(), rng.random()) for _ in range(3)]
    points = [(0.123, 0.456)] * (size // 3)
    while len(points) < size:
        cx, cy = rng.choice(centres)
        points.append((rng.gauss(cx, 0.01), rng.gauss(cy, 0.02)) if rng.random() < 0.7 else (rng.random(), rng.random()))
    return points


@pytest.mark.parametrize(("threshold", "expected"), [(7, THRESHOLD_7), (3, THRESHOLD_3)])
def test_sample(spark, threshold, expected):
    df = table(spark, [s[:2] for s in SAMPLE])
    tree = Q.build_quadtree(df, "x", "y", threshold)
    assert counts(tree) == expected
    assert Counter(assigned(tree, df)) == expected
    assert tree.leaf_count == len(expected) and tree.depth == max(map(len, expected)) - 1


@pytest.mark.parametrize(
    ("seed", "threshold", "max_depth", "max_heavy"),
    [(1, 20, 10, None), (2, 60, 4, None), (3, 15, 10, 3), (4, 15, 10, 0), (5, 5, 14, None)],
)
def test_equals_the_rounds(spark, seed, threshold, max_depth, max_heavy):
    points = clumped(seed, 600)
    df = table(spark, points)
    tree = Q.build_quadtree(df, "x", "y", threshold, max_depth, max_heavy)
    expected = leaf_counts(points, threshold, max_depth, max_heavy)
    assert assigned(tree, df) == expected
    assert counts(tree) == Counter(expected)


@pytest.mark.parametrize(("max_depth", "max_heavy"), [(7, None), (9, 4), (9, 40), (30, None)])
def test_counting_in_stages_equals_the_rounds(spark, monkeypatch, max_depth, max_heavy):
    monkeypatch.setattr(Q, "FIRST_COUNT", 3)
    points = [p for p in clumped(19, 500) if max_depth < 30 or p != (0.123, 0.456)]
    df = table(spark, points)
    tree = Q.build_quadtree(df, "x", "y", 12, max_depth, max_heavy)
    expected = leaf_counts(points, 12, max_depth, max_heavy)
    assert assigned(tree, df) == expected
    assert counts(tree) == Counter(expected)


@pytest.mark.parametrize("wide", [30, 0])
def test_lattice_equals_the_rounds(spark, monkeypatch, wide):
    monkeypatch.setattr(Q, "WIDE_ROW", wide)
    points = [(i, j) for i in range(17) for j in range(17)]
    df = table(spark, points)
    assert assigned(Q.build_quadtree(df, "x", "y", 3, 8), df) == leaf_counts(points, 3, 8)


def test_tiers_and_shuffled_joins_give_the_same_cells(spark, monkeypatch):
    points = clumped(7, 600)
    df = table(spark, points)
    tree = Q.build_quadtree(df, "x", "y", 10, 10)
    expected = leaf_counts(points, 10, 10)
    labels = tree.counts().select("cell", (F.col("n") + 1).alias("more"))
    for limit in (LIMIT, 20_000, 4000, 1):
        monkeypatch.setattr(session, "BROADCAST_BYTES", limit)
        monkeypatch.setattr(Q, "BUNDLE_LEAVES", 8)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        try:
            tagged = tree.assign(df, "x", "y", labels=labels)
            plan = tagged._jdf.queryExecution().executedPlan().toString()
            # Above the limit the rows are shuffled once, to the lists of leaves.
            joins = plan.count("SortMergeJoin")
            assert joins == 0 if limit == LIMIT else joins <= 1 if limit == 20_000 else joins == 1
            assert plan.count("Exchange hash") <= 2
            rows = tagged.orderBy("id").collect()
            assert [r.cell for r in rows] == expected
            assert [r.more for r in rows] == [Counter(expected)[c] + 1 for c in expected]
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("size", [300, 3000])
def test_no_leaf_is_above_the_threshold_unless_points_coincide(spark, size):
    points = clumped(29, size)
    rows = Q.build_quadtree(table(spark, points), "x", "y", 25).leaves().collect()
    assert sum(r.n for r in rows) == size
    heavy = [r for r in rows if r.n > 25]
    assert [r.n for r in heavy] == [size // 3] and heavy[0].depth == 30


def test_join_depths():
    assert Q.join_depths({}) == []
    assert Q.join_depths({2: 3, 4: 5}, 1000) == [(4, [2, 4], 3 * 16 + 5)]
    assert Q.join_depths({2: 3, 4: 5, 9: 2}, 100) == [(4, [2, 4], 53), (9, [9], 2)]
    assert Q.join_depths({1: 4, 2: 9}, 1) == [(1, [1], 4), (2, [2], 9)]


def test_properties(spark):
    points = clumped(9, 900)
    df = table(spark, points)
    tree = Q.build_quadtree(df, "x", "y", 40, 6)
    leaves = tree.leaves().collect()
    assert sum(leaf.n for leaf in leaves) == 900
    assert all(leaf.n <= 40 or leaf.depth == 6 for leaf in leaves)
    ids = sorted(leaf.cell for leaf in leaves)
    assert not any(b.startswith(a) for a, b in zip(ids, ids[1:]))
    rects = {leaf.cell: (leaf.x0, leaf.x1, leaf.y0, leaf.y1) for leaf in leaves}
    assert all(holds(rects[cell], p) for cell, p in zip(assigned(tree, df), points))
    decoded = decode_ranges(tree.counts().withColumnRenamed("cell", "id_part"), tree.box).collect()
    assert {r.id_part: (r.x0, r.x1, r.y0, r.y1) for r in decoded} == rects


def test_rows_outside_and_empty_tables(spark):
    df = table(spark, [(0, 0), (1, 1), (2, 2)])
    tree = Q.build_quadtree(df, "x", "y", 1)
    more = spark.createDataFrame([(0, 3.0, 0.0), (1, None, 0.0), (2, 2.0, 2.0)], "id long, x double, y double")
    assert assigned(tree, more) == [None, None, "_2"]
    empty = df.limit(0)
    nothing = Q.build_quadtree(empty, "x", "y", 1)
    assert nothing.leaf_count == 0 and nothing.leaves().count() == 0
    assert nothing.assign(empty, "x", "y").columns == ["id", "x", "y", "cell"]
    assert Q.heavy_rows(empty, nothing, 0, "x", "y").count() == 0


def test_one_cell_when_all_rows_fit(spark):
    df = table(spark, [(0, 0), (1, 1)])
    tree = Q.build_quadtree(df, "x", "y", 2)
    assert counts(tree) == {"_": 2} and assigned(tree, df) == ["_", "_"]


def test_heavy_rows_are_those_the_next_round_splits(spark):
    points = clumped(11, 500)
    df = table(spark, points)
    tree = Q.build_quadtree(df, "x", "y", 30, 6)
    for depth in (0, 2, 4):
        cells = leaf_counts(points, 30, depth)
        heavy = {c for c, n in Counter(cells).items() if n > 30}
        got = {r.id for r in Q.heavy_rows(df, tree, depth, "x", "y").collect()}
        assert got == {i for i, c in enumerate(cells) if c in heavy}


def test_split_step(spark):
    grid = [("_0", 0.0, 4.0, 0.0, 2.0, 8), ("_1", 4.0, 8.0, 0.0, 2.0, 7)]
    df = spark.createDataFrame(grid, "cell string, x0 double, x1 double, y0 double, y1 double, n long")
    got = {r.cell: (r.x0, r.x1, r.y0, r.y1) for r in Q.split_step(df, 7).collect()}
    expected = {f"_0{i}": kid for i, kid in enumerate(children((0.0, 4.0, 0.0, 2.0)))}
    assert got == expected | {"_1": (4.0, 8.0, 0.0, 2.0)}


def test_labels_travel_in_the_same_join(spark):
    points = clumped(13, 300)
    df = table(spark, points)
    tree = Q.build_quadtree(df, "x", "y", 50, 5)
    labels = tree.counts().select("cell", (F.col("n") * 2).alias("twice"))
    rows = tree.assign(df, "x", "y", labels=labels).collect()
    sizes = Counter(r.cell for r in rows)
    assert all(r.twice == 2 * sizes[r.cell] for r in rows)
    few = tree.assign(df, "x", "y", labels=labels.filter("twice > 60")).collect()
    assert Counter(r.cell for r in few) == sizes
    assert all(r.twice == (2 * sizes[r.cell] if sizes[r.cell] > 30 else None) for r in few)


def test_a_new_tag_replaces_the_old_one(spark):
    points = clumped(23, 200)
    df = table(spark, points)
    coarse = Q.build_quadtree(df, "x", "y", 100, 3).assign(df, "x", "y")
    fine = Q.build_quadtree(df, "x", "y", 20, 6).assign(coarse, "x", "y")
    assert fine.columns == ["id", "x", "y", "cell"]
    assert [r.cell for r in fine.orderBy("id").collect()] == leaf_counts(points, 20, 6)


def test_box_of_a_survey_saves_a_pass(spark):
    points = clumped(17, 300)
    df = table(spark, points)
    assert counts(Q.build_quadtree(df, "x", "y", 50, 5, box=box_of(points))) == Counter(leaf_counts(points, 50, 5))
