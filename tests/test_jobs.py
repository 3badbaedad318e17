import random
from collections import Counter
from pathlib import Path

import pytest
from sample import SAMPLE

from starloom import jobs, session
from starloom.functions.geometry import Box
from starloom.operators.lookup import load_tree
from starloom.operators.quadtree import build_quadtree
from starloom.sinks.cells import read_groups

DEFINITION = "CREATE TABLE t (\n  id NUMBER(19, 0),\n  ra FLOAT (24),\n  decl FLOAT (24),\n  objectId NUMBER(19, 0)\n);\n"
LINES = [f"{k},{x},{y},{'NULL' if o is None else o}" for k, (x, y, o) in enumerate(SAMPLE)]


@pytest.fixture
def source(tmp_path):
    (tmp_path / "schema").write_text(DEFINITION)
    for k in range(3):
        (tmp_path / f"part-{k}.csv").write_text("\n".join(LINES[k::3]) + "\n\n")
    return str(tmp_path / "schema"), str(tmp_path / "part-*.csv"), str(tmp_path / "out"), "ra", "decl"


def held(written):
    rows = written.collect()
    assert sorted(r.data for r in rows) == sorted(LINES)
    return Counter(r[1] for r in rows)


def test_uniform(spark, source):
    assert held(jobs.partition_uniform(spark, *source, 4)) == {"00": 10, "03": 10, "32": 3, "33": 7}
    assert {p.name for p in Path(source[2]).glob("cell=*")} == {"cell=00", "cell=03", "cell=32", "cell=33"}


def test_quadtree(spark, source):
    assert held(jobs.partition_quadtree(spark, *source, 7)) == {
        "_0000": 5, "_0003": 4, "_003": 1, "_21": 3, "_22": 7, "_33333330": 4, "_33333333": 6,
    }


def test_merged(spark, source):
    assert held(jobs.partition_merged(spark, *source, minimum=5, threshold=7)) == {
        "_0000": 5, "_0003": 8, "_22": 7, "_33333330": 10,
    }
    assert held(read_groups(spark, source[2])) == {
        "_0000": 5, "_0003_003_21": 8, "_22": 7, "_33333330_33333333": 10,
    }


def test_threshold_from_the_block_size_keeps_a_small_catalogue_whole(spark, source):
    assert held(jobs.partition_merged(spark, *source, minimum=5)) == {"_": 30}


def test_clusters(spark, source):
    definition, files, _, x, y = source
    sizes = [r.n for r in jobs.cluster_catalogue(spark, definition, files, x, y, k=3, seed=2).collect()]
    assert sum(sizes) == 30 and sizes == sorted(sizes)


def test_quadrants(spark, source):
    assert held(jobs.partition_quadrants(spark, *source)) == {"1": 10, "3": 10, "4": 10}
    assert {p.name for p in Path(source[2]).glob("cell=*")} == {"cell=1", "cell=3", "cell=4"}


def test_new_lines_are_placed_into_written_partitions(spark, source):
    definition, files, out, x, y = source
    written = {r.data: r.part for r in jobs.partition_merged(spark, *source, minimum=5, threshold=7).collect()}
    placed = jobs.place_lines(spark, definition, files, out, x, y)
    groups = {r.cell: r.part for r in spark.read.parquet(f"{out}/_groups").collect()}
    assert {r.data: groups[r.cell] for r in placed.collect()} == written


def test_many_members(spark, tmp_path):
    rng = random.Random(1)
    lines = [f"{k},{rng.random() ** 6},{rng.random() ** 6},NULL" for k in range(4000)]
    (tmp_path / "schema").write_text(DEFINITION)
    (tmp_path / "rows.csv").write_text("\n".join(lines))
    paths = [str(tmp_path / name) for name in ("schema", "rows.csv", "out")]
    assert jobs.partition_merged(spark, *paths, "ra", "decl", minimum=1000, threshold=40).count() == len(lines)
    rows = read_groups(spark, paths[2]).collect()
    assert sorted(r.data for r in rows) == sorted(lines)
    assert max(len(r.id_part) for r in rows) > 255


def test_an_empty_catalogue(spark, tmp_path):
    (tmp_path / "schema").write_text(DEFINITION)
    (tmp_path / "rows.csv").write_text("\n\n")
    definition, files = str(tmp_path / "schema"), str(tmp_path / "rows.csv")
    for k, job in enumerate((
        lambda *a: jobs.partition_uniform(*a, 4), jobs.partition_quadrants,
        lambda *a: jobs.partition_quadtree(*a, 5), lambda *a: jobs.partition_merged(*a, 5), 
    )):
        assert job(spark, definition, files, str(tmp_path / f"out{k}"), "ra", "decl").count() == 0
    assert jobs.cluster_catalogue(spark, definition, files, "ra", "decl").count() == 0


def tree_of(written):
    return Counter(r.cell for r in written.collect())


@pytest.mark.parametrize(("seed", "threshold"), [(1, 40), (2, 7), (3, 2000)])
def test_deliveries_give_the_split_of_all_rows(spark, tmp_path, seed, threshold):
    """Three deliveries, the later ones also into empty leaves and outside the box."""
    rng = random.Random(seed)
    definition = str(tmp_path / "schema")
    (tmp_path / "schema").write_text(DEFINITION)
    box = [(0.0, 0.0), (1.0, 1.0)]
    first = box + [(rng.random() ** 3, rng.random()) for _ in range(300)]
    second = [(rng.random(), rng.random() ** 5) for _ in range(400)] + [(1.5, 0.5), (0.999, 0.001)]
    third = [(0.25, 0.75)] * 30 + [(rng.random(), rng.random()) for _ in range(50)]
    lines, points, n = [], [], 0
    for k, rows in enumerate((first, second, third)):
        text = [f"{n + i},{x!r},{y!r},NULL" for i, (x, y) in enumerate(rows)]
        n += len(rows)
        lines += text
        points += rows
        (tmp_path / f"d{k}.csv").write_text("\n".join(text) + "\n")
    out = str(tmp_path / "out")
    jobs.partition_quadtree(spark, definition, str(tmp_path / "d0.csv"), out, "ra", "decl", threshold, max_depth=20)
    before = {p: p.stat().st_mtime_ns for p in Path(out).glob("cell=*/*.txt")}
    for k in (1, 2):
        written = jobs.add_lines(spark, definition, str(tmp_path / f"d{k}.csv"), out, "ra", "decl")
    rows = written.collect()
    assert sorted(r.data for r in rows) == sorted(lines)
    df = spark.createDataFrame([(line, *p) for line, p in zip(lines, points)], "data string, x double, y double")
    whole = build_quadtree(df, "x", "y", threshold, 20, box=Box(0.0, 1.0, 0.0, 1.0)).assign(df, "x", "y")
    assert {r.data: r.cell for r in rows} == {r.data: r.cell for r in whole.collect()}
    stored = load_tree(spark, f"{out}/_split")
    assert {r.cell: r.n for r in stored.counts().collect()} == Counter(r.cell for r in rows if r.cell)
    # Files of leaves that were not cut again are those written first.
    kept = [p for p in before if p.exists()]
    assert all(p.stat().st_mtime_ns == before[p] for p in kept)
    assert {p.parent.name for p in before if not p.exists()}.isdisjoint({f"cell={r.cell}" for r in rows})


def test_jobs_leave_nothing_in_the_shared_folder(spark, source):
    shared = Path(session.shared_folder(spark).removeprefix("file:"))
    held = lambda: {p for p in shared.rglob("*") if p.is_file()}
    before = held()
    definition, files, out, x, y = source
    jobs.partition_quadtree(spark, definition, files, out + "1", x, y, 7)
    jobs.add_lines(spark, definition, files, out + "1", x, y)
    jobs.partition_merged(spark, definition, files, out + "2", x, y, 5, 7)
    jobs.cluster_catalogue(spark, definition, files, x, y, k=3, starts=4)
    assert held() == before
    # Outside of a scope checkpoints go where they went before.
    assert session.cut_lineage(spark.range(3)).count() == 3 and held() - before


def test_a_delivery_lists_only_the_directories_that_are_cut(spark, tmp_path, monkeypatch):
    """Many leaves, one of them too heavy after the delivery, and one that was empty before."""
    (tmp_path / "t.sql").write_text("CREATE TABLE t (\n  ra FLOAT (24),\n  decl FLOAT (24),\n  name char(9)\n);")
    grid = [(a / 8 + 0.01, b / 8 + 0.01) for a in range(8) for b in range(8) if (a, b) != (3, 3)] + [(0.0, 0.0), (1.0, 1.0)]
    first = [f"{x},{y},a{k}" for k, (x, y) in enumerate(grid)]
    more = [f"{0.51 + k / 1000},{0.51 + k / 900},b{k}" for k in range(5)] + [f"{0.40 + k / 100},{0.41 + k / 90},c{k}" for k in range(5)]
    for name, lines in (("first", first), ("more", more)):
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    definition, out = str(tmp_path / "t.sql"), str(tmp_path / "out")
    jobs.partition_quadtree(spark, definition, str(tmp_path / "first.csv"), out, "ra", "decl", 2)
    read, removed = [], []
    kept_read, kept_remove = jobs.read_lines, session.remove
    monkeypatch.setattr(jobs, "read_lines", lambda *a, **k: read.append(kept_read(*a, **k)) or read[-1])
    monkeypatch.setattr(session, "remove", lambda spark, *p: removed.extend(p) or kept_remove(spark, *p))
    written = jobs.add_lines(spark, definition, str(tmp_path / "more.csv"), out, "ra", "decl")
    cut = [p for p in removed if "/cell=" in p]
    assert len(read) == 2 and len(cut) == 1
    assert {Path(f.removeprefix("file:")).parent for f in read[0].inputFiles()} == {Path(p) for p in cut}
    assert sorted(r.data for r in written.collect()) == sorted(first + more)
    assert not any(Path(p).exists() for p in cut)
    assert spark.conf.get(session.LISTING_TASKS) == "10000"
