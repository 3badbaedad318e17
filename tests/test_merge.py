import random

import pandas as pd
import pytest
from pyspark.sql import functions as F
from models import merge_rule
from test_quadtree import THRESHOLD_3, THRESHOLD_7

from starloom.functions.geometry import Box
from starloom.operators import merge as M
from starloom.operators import ranks
from starloom.operators.ranges import decode_ranges, member_ranges, partition_report, report_lines


def merged(spark, cells, minimum):
    df = spark.createDataFrame(list(cells), "cell string, n long")
    return M.merge_cells(df, minimum).collect()


def group_sizes(rows):
    groups = {}
    for r in sorted(rows, key=lambda r: r.cell):
        name, n = groups.get(r.part, ("", 0))
        groups[r.part] = (name + r.cell, n + r.n)
    assert all(name.startswith(part) for part, (name, _) in groups.items())
    return dict(groups.values())


@pytest.mark.parametrize(
    ("cells", "minimum", "expected"),
    [
        (THRESHOLD_7, 5, {"_0000": 5, "_0003_003_21": 8, "_22": 7, "_33333330_33333333": 10}),
        (THRESHOLD_7, 10, {"_0000_0003_003": 10, "_21_22": 10, "_33333330_33333333": 10}),
        (
            THRESHOLD_3,
            5,
            {
                "_000000_000003_00003": 5,
                "_000330_000333_003": 5,
                "_21_22111": 6,
                "_22112_2212_222_333333300": 5,
                "_333333303_333333330_333333333": 9,
            },
        ),
        (
            THRESHOLD_3,
            10,
            {
                "_000000_000003_00003_000330_000333_003": 10,
                "_21_22111_22112_2212_222": 10,
                "_333333300_333333303_333333330_333333333": 10,
            },
        ),
        ({}, 5, {}),
        ({"_": 3}, 5, {"_": 3}),
    ],
)
def test_sample_groups(spark, cells, minimum, expected):
    assert group_sizes(merged(spark, cells.items(), minimum)) == expected


def ids(size):
    """Prefix-free ids in order, like the leaves of a deep tree."""
    digits = [""] * size
    for k in range(size):
        value = k
        for _ in range(6):
            digits[k] = str(value % 4) + digits[k]
            value //= 4
    return ["_" + d + "0" * (k % 3) for k, d in enumerate(digits)]


@pytest.mark.parametrize(("seed", "top", "minimum"), [(1, 30, 10), (2, 30, 25), (3, 12, 40), (4, 100, 2), (5, 3, 900), (6, 5, 10**6)])
def test_long_lists_equal_the_rule(spark, seed, top, minimum, monkeypatch):
    """Also with a minimum far above every cell, where no two neighbours are full."""
    rng = random.Random(seed)
    cells = [(c, rng.randint(1, top)) for c in ids(1500)]
    expected = {"".join(g): n for g, n in merge_rule(cells, minimum)}
    for chunk in (16_384, 60):
        monkeypatch.setattr(M, "CHUNK_CELLS", chunk)
        rows = merged(spark, cells, minimum)
        assert group_sizes(rows) == expected
        assert [(r.cell, r.n) for r in sorted(rows, key=lambda r: r.idx)] == sorted(cells)
    assert len(expected) == 1 or all(n >= minimum for n in expected.values())


def test_walks_in_chunks_equal_the_rule_on_many_lists():
    """Chunks of any size, each walked from the sizes at its beginning alone."""
    rng = random.Random(8)
    for _ in range(3000):
        minimum, top = rng.randint(1, 40), rng.choice([4, 12, 30])
        sizes = [rng.randint(1, top) for _ in range(rng.randint(1, 25))]
        cells = [f"_{k:02}" for k in range(len(sizes))]
        cut = sorted({0, len(sizes), *rng.sample(range(len(sizes) + 1), min(3, len(sizes)))})
        frame = pd.DataFrame({"cell": cells, "n": sizes, "idx": range(len(sizes))})
        frame["chunk"] = [sum(k >= c for c in cut) - 1 for k in range(len(sizes))]
        starts, state = [], M.Walk()
        for chunk in range(len(cut) - 1):
            starts.append(state)
            part = frame[frame.chunk == chunk]
            (end,) = pd.concat(M._finish(minimum, {chunk: state.sizes})(iter([part]))).itertuples(index=False)
            closed = None if pd.isna(end.closed) else int(end.closed)
            state = M._renamed(M.Walk(closed, end.closed_head, end.open, end.open_head), state)
        told = pd.concat(M._tell(minimum, starts, len(starts) - 1)(iter([frame])))
        heirs = {r.run: r.heir for r in told.itertuples() if r.cell is None}
        found = {}
        for r in told.itertuples():
            if r.cell is not None:
                found.setdefault(heirs.get(r.run, r.run), []).append(r.cell)
        assert sorted(map(tuple, found.values())) == [g for g, _ in merge_rule(list(zip(cells, sizes)), minimum)]


def test_seams_fit_after_few_rounds(spark, monkeypatch):
    """A list without two full neighbours in 50 chunks: the rounds do not grow with the chunks."""
    rng = random.Random(4)
    cells = [(c, rng.randint(1, 9)) for c in ids(3200)]
    monkeypatch.setattr(M, "CHUNK_CELLS", 64)
    rounds, finish = [], M._finish
    monkeypatch.setattr(M, "_finish", lambda minimum, wanted: rounds.append(len(wanted)) or finish(minimum, wanted))
    assert group_sizes(merged(spark, cells, 15)) == {"".join(g): n for g, n in merge_rule(cells, 15)}
    assert len(rounds) <= 5 and rounds[0] == 50


def test_one_large_group_writes_little(spark, tmp_path):
    """16,000 cells in one group: no id with all of them, except where it is asked for."""
    from starloom.sinks import cells as sinks

    df = spark.createDataFrame([(c, 1) for c in ids(4000)], "cell string, n long")
    kept = sinks.store_groups(M.merge_cells(df, 10**9), str(tmp_path / "out"))
    size = sum(f.stat().st_size for f in (tmp_path / "out").rglob("*.parquet"))
    assert size < 400_000 and kept.select("part").distinct().count() == 1
    (run,) = M.group_runs(kept).collect()
    assert (run.members, run.group_n, run.start) == (4000, 4000, 0)
    pages = M.id_pages(kept, 64).collect()
    assert sorted(p.page for p in pages) == list(range(63)) and max(len(p.ids) for p in pages) < 64 * 12
    whole = M.whole_ids(kept).first().id_part
    assert whole == "".join(sorted(ids(4000)))


def test_runs_hold_cells_that_came_later(spark):
    runs = M.group_runs(M.merge_cells(spark.createDataFrame([("_01", 4), ("_03", 4), ("_12", 4), ("_3", 9)], "cell string, n long"), 8))
    asked = ["_00", "_01", "_010", "_02", "_1", "_12", "_13", "_22", "_3", "_33", None]
    rows = M.find_runs(spark.createDataFrame([(a, k) for k, a in enumerate(asked)], "cell string, k int"), runs).collect()
    heads = sorted(r.part for r in runs.collect())
    want = {a: max([h for h in heads if h <= a], default=heads[0]) if a else None for a in asked}
    assert {r.cell: r.part for r in rows} == want and len(heads) > 1


def test_retag(spark):
    groups = spark.createDataFrame([("_0", "_0"), ("_1", "_0"), ("_2", "_2")], "cell string, part string")
    rows = spark.createDataFrame([(1, "_1"), (2, "_2"), (3, "_0")], "id int, cell string")
    got = {r.id: r.part for r in M.retag(rows, groups).collect()}
    assert got == {1: "_0", 2: "_2", 3: "_0"}


def test_ranges_restart_from_the_root(spark):
    box = Box(0.0, 8.0, 0.0, 4.0)
    df = spark.createDataFrame([("_02_1",), ("_",), ("_3",)], "id_part string")
    rows = {(r.id_part, r.pos): (r.member, r.x0, r.x1, r.y0, r.y1) for r in decode_ranges(df, box).collect()}
    assert rows == {
        ("_02_1", 0): ("_02", 2.0, 4.0, 1.0, 2.0),
        ("_02_1", 1): ("_1", 4.0, 8.0, 0.0, 2.0),
        ("_", 0): ("_", 0.0, 8.0, 0.0, 4.0),
        ("_3", 0): ("_3", 0.0, 4.0, 2.0, 4.0),
    }


def test_bad_digits_are_refused(spark):
    df = spark.createDataFrame([("_04",)], "id_part string")
    with pytest.raises(Exception, match="not a cell digit"):
        decode_ranges(df, Box(0.0, 1.0, 0.0, 1.0)).collect()


def test_report(spark):
    df = spark.createDataFrame([("_0_2",)], "id_part string")
    report = partition_report(df, Box(0.0, 2.0, 0.0, 2.0), "ra", "decl").first().report
    assert report.split("\n") == [
        "La partition _0_2corespond a",
        "ra dans [0.0, 1.0] et decl dans [0.0, 1.0]",
        "ra dans [1.0, 2.0] et decl dans [1.0, 2.0]",
    ]


def test_report_lines(spark):
    cells = spark.createDataFrame([("_0", 1), ("_2", 1), ("_3", 9)], "cell string, n long")
    kept, box = M.merge_cells(cells, 2), Box(0.0, 2.0, 0.0, 2.0)
    lines = {(r.part, r.pos): r.line for r in report_lines(kept, box, "ra", "decl").collect()}
    assert lines == {
        ("_0", -1): "La partition _0corespond a",
        ("_0", 0): "ra dans [0.0, 1.0] et decl dans [0.0, 1.0]",
        ("_0", 1): "ra dans [1.0, 2.0] et decl dans [1.0, 2.0]",
        ("_3", -1): "La partition _3corespond a",
        ("_3", 0): "ra dans [0.0, 1.0] et decl dans [1.0, 2.0]",
    }
    assert report_lines(kept.limit(0), None, "ra", "decl").collect() == []
    assert member_ranges(kept, None).collect() == []


def test_ranks_by_ranges(spark):
    """A million ids, most with a beginning of their own; every range is one task's."""
    n = 1_000_000
    df = spark.range(n).selectExpr("concat('_', conv(cast(id * 2654435761 % 4294967291 as string), 10, 36)) AS cell")
    ranked = ranks.with_rank(df)
    checked = ranked.selectExpr("count(*) n", "min(idx) lo", "max(idx) hi", "count(distinct idx) k").first()
    assert tuple(checked) == (n, 0, n - 1, n)
    assert "Window" not in ranked._jdf.queryExecution().toString()
    some = ranked.filter("idx % 1000 = 0").sort("idx").collect()
    assert [r.cell for r in some] == sorted(r.cell for r in some)
    few = ranks.with_rank(spark.createDataFrame([("b",), ("a",), ("é",)], "cell string")).collect()
    assert {r.cell: r.idx for r in few} == {"a": 0, "b": 1, "é": 2}
    assert ranks.with_rank(df.limit(0)).collect() == []


def test_long_group_names_are_kept_apart_from_directories(spark, tmp_path):
    from starloom.sinks import cells as sinks

    cells = [("_" + "0123"[k % 4] * (k // 4 + 1), k % 3 + 1) for k in range(160)]
    groups = M.merge_cells(spark.createDataFrame(cells, "cell string, n long"), 150)
    path = str(tmp_path / "out")
    stored = sinks.store_groups(groups, path)
    names = {r.part: r.id_part for r in M.whole_ids(stored).collect()}
    assert max(map(len, names.values())) > 600
    sinks.write_text(stored.select("cell", "part"), path, 100, F.col("cell"), "part", mode="append")
    back = {r.data: r.id_part for r in sinks.read_groups(spark, path).collect()}
    assert back == {r.cell: names[r.part] for r in groups.collect()}
