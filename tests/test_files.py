import random
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import session
from starloom.functions.geometry import Box
from starloom.functions.text import csv_line
from starloom.operators.quadtree import build_quadtree
from starloom.operators.summary import count_per_cell, rows_of_cell
from starloom.sinks import cells as K
from starloom.sources import catalogue, ddl

DEFINITION = """CREATE TABLE Ship (
  hull BIGINT NOT NULL,
  berth NUMBER(3, 0) NOT NULL,
  owner NUMBER(12, 0) DEFAULT NULL,
  lon FLOAT (24) NOT NULL,
  lat DOUBLE NOT NULL,
  crew INT DEFAULT NULL,
  built DATE DEFAULT NULL,
  seen TIMESTAMP DEFAULT NULL,
  fee DECIMAL(8, 2),
  label varchar(20),
  shape GEOMETRY
);
"""
LINES = [
    '9007199254740993,3,NULL,-12.25,71.5,0,1988-02-29,2001-05-06 07:08:09,12.50,"a",x',
    "42,7,123456789012,0.1,-0.2,NULL,NULL,NULL,NULL,b c,NULL",
]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "schema").write_text(DEFINITION)
    (tmp_path / "rows-1.csv").write_text(LINES[0] + "\n\nx,y\n")
    (tmp_path / "rows-2.csv").write_text(LINES[1] + "\n")
    return tmp_path


def test_definition(spark, folder):
    columns = ddl.read_ddl(spark, str(folder / "schema")).orderBy("ordinal").collect()
    assert [(c.ordinal, c.name) for c in columns][:4] == [(0, "hull"), (1, "berth"), (2, "owner"), (3, "lon")]
    assert [c.not_null for c in columns] == [True, True, False, True, True] + [False] * 6
    assert columns[3].ddl_type == "FLOAT (24)" and len(columns) == 11


def test_repeated_lines_and_names(spark, tmp_path):
    path = tmp_path / "odd"
    path.write_text("(\n  a float,\n  b float,\n(\n\n  a float,\n  c float\n);\n")
    columns = ddl.read_ddl(spark, str(path))
    assert ddl.column_positions(columns) == {"a": 0, "b": 1, "c": 3}
    (tmp_path / "rows").write_text("1,2,3,4.5\n\n10,20,30,40.5\n")
    rows = catalogue.read_catalogue(spark, str(tmp_path / "rows"), ddl.ddl_schema(columns)).collect()
    assert sorted(map(tuple, rows)) == [(1.0, 2.0, 4.5), (10.0, 20.0, 40.5)] and rows[0].asDict().keys() == {"a", "b", "c"}
    lines = catalogue.read_lines(spark, str(tmp_path / "rows"), ddl.column_positions(columns), "a", "c")
    assert sorted((r.x, r.y) for r in lines.collect()) == [(1.0, 4.5), (10.0, 40.5)]


def test_types(spark, folder):
    schema = ddl.ddl_schema(ddl.read_ddl(spark, str(folder / "schema")))
    long, double, text = T.LongType(), T.DoubleType(), T.StringType()
    assert [f.dataType for f in schema] == [
        long, T.ShortType(), long, double, double, T.IntegerType(), T.DateType(), T.TimestampNTZType(),
        T.DecimalType(8, 2), text, text,
    ]
    assert ddl.spark_type("NUMBER(19, 0)", strict=True) == T.DecimalType(19, 0)
    assert ddl.spark_type("NUMBER(7, 2)") == T.DecimalType(7, 2)
    assert ddl.spark_type("BLOB") == ddl.spark_type("odd type") == text


def test_typed_rows_of_a_glob(spark, folder):
    schema = ddl.ddl_schema(ddl.read_ddl(spark, str(folder / "schema")))
    rows = catalogue.read_catalogue(spark, str(folder / "rows-*.csv"), schema)
    rows = rows.orderBy("hull").collect()
    assert tuple(rows[0]) == (42, 7, 123456789012, 0.1, -0.2, None, None, None, None, "b c", None)
    assert tuple(rows[1]) == (
        9007199254740993, 3, None, -12.25, 71.5, 0, date(1988, 2, 29), datetime(2001, 5, 6, 7, 8, 9),
        Decimal("12.50"), '"a"', "x",
    )
    assert len(rows) == 2  # neither the blank line nor the broken one


def test_raw_fields_and_short_rows(spark, folder):
    raw = catalogue.read_fields(spark, str(folder / "rows-1.csv"))
    assert sorted(r.n for r in raw.select(F.size("fields").alias("n")).collect()) == [1, 2, 11]
    kept = catalogue.drop_short_rows(raw).collect()
    assert len(kept) == 1 and ",".join(kept[0].fields) == LINES[0]


def test_lines_keep_their_spelling(spark, folder):
    positions = ddl.column_positions(ddl.read_ddl(spark, str(folder / "schema")))
    (folder / "rows-3.csv").write_text("1,2,NULL,NULL,0.0000440547,x\n1,2,3\n")
    rows = catalogue.read_lines(spark, str(folder / "rows-*.csv"), positions, "lon", "lat")
    got = {r.data: (r.x, r.y) for r in rows.collect()}
    assert got == {
        LINES[0]: (-12.25, 71.5),
        LINES[1]: (0.1, -0.2),
        "1,2,NULL,NULL,0.0000440547,x": (None, 0.0000440547),
        "1,2,3": (None, None),
    }


def test_only_needed_columns_are_read(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(5).select(*[F.col("id").cast("double").alias(f"c{k}") for k in range(40)]).write.parquet(path)
    from starloom.operators.bbox import bounding_box

    plan = bounding_box(spark.read.parquet(path), "c3", "c7")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c3:double,c7:double>" in plan


def tagged(spark):
    """2,000 rows; one cell holds most of them, half of those equal."""
    rows = [("00", 7)] * 700 + [("00", k) for k in range(700)] + [("_1", k) for k in range(500)] + [("9", k) for k in range(99)]
    return spark.createDataFrame([*rows, (None, 5)], "cell string, k int").repartition(5)


def files_of(path):
    return Counter(f.parent.name for f in Path(path).rglob("part-*"))


def contents(df):
    return Counter((r.cell, r.k) for r in df.select("cell", "k").collect())


def test_write_cells(spark, tmp_path):
    df, path = tagged(spark), str(tmp_path / "out")
    K.write_cells(df, path, 300)
    files = files_of(path)
    assert files["cell=00"] >= 5 and files["cell=_1"] == 2 and files["cell=9"] == 1
    back = K.read_cells(spark, path, df.schema)
    assert dict(back.dtypes)["cell"] == "string" and contents(back) == contents(df)
    one = rows_of_cell(back, "00")
    assert one.count() == 1400
    assert "PartitionFilters: [isnotnull(cell" in one._jdf.queryExecution().executedPlan().toString()


def test_hot_cell_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(0, 600_000, numPartitions=8).select(
        F.lit("hot").alias("cell"), F.md5(F.col("id").cast("string")).alias("k")
    )
    df = df.unionByName(spark.range(100).select(F.concat(F.lit("c"), F.col("id") % 9).alias("cell"), F.lit("x").alias("k")))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        K.write_cells(df, str(tmp_path / "hot"), 10_000_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert files_of(tmp_path / "hot")["cell=hot"] > 2
    assert spark.read.parquet(str(tmp_path / "hot")).count() == 600_100


def test_file_per_cell(spark, tmp_path):
    df, path = tagged(spark), str(tmp_path / "out")
    K.write_file_per_cell(df, path, count_per_cell(df.dropna()), 500)
    files = files_of(path)
    assert files["cell=_1"] == 1 and files["cell=9"] == 1 and files["cell=00"] >= 3
    assert contents(K.read_cells(spark, path, df.schema)) == contents(df)


def test_many_cells_need_no_more_tasks(spark, tmp_path):
    df = spark.range(6000).select(F.concat(F.lit("c"), F.col("id") % 600).alias("cell"), F.col("id").cast("int").alias("k"))
    path = str(tmp_path / "many")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("many", "cells")
    K.write_file_per_cell(df, path, count_per_cell(df), 500)
    stages = {s for j in tracker.getJobIdsForGroup("many") for s in tracker.getJobInfo(j).stageIds}
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(info.numTasks for s in stages if (info := tracker.getStageInfo(s))) <= 16
    files = files_of(path)
    assert len(files) == 600 and set(files.values()) == {1}
    assert contents(K.read_cells(spark, path, df.schema)) == contents(df)


def test_write_text(spark, tmp_path):
    df, path = tagged(spark).withColumn("s", F.lit(None).cast("string")), str(tmp_path / "out")
    K.write_text(df, path, 1000, csv_line(["k", "s"]))
    lines = (Path(path) / "cell=9").glob("part-*")
    assert sorted(line for f in lines for line in f.read_text().split()) == sorted(f"{k},NULL" for k in range(99))


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_folder(spark) == named
    assert session.fresh_path(spark, "x").startswith(named)
    assert session.fresh_path(spark, "x") != session.fresh_path(spark, "x")


def test_broadcasts_are_bounded_by_measured_bytes(spark, monkeypatch):
    cells = spark.createDataFrame([("_0" * 50, 1), ("_1", 2), (None, 3)], "cell string, n long")
    size = cells.agg(F.sum(session.row_bytes(cells)).alias("size")).first().size
    assert size == 3 * (session.ROW_BYTES + 2 * session.COLUMN_BYTES) + 100 + 2
    rows = spark.createDataFrame([("_1", "a"), ("_2", "b")], "cell string, v string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for limit, join in ((size, "BroadcastHashJoin"), (size - 1, "SortMergeJoin")):
            monkeypatch.setattr(session, "BROADCAST_BYTES", limit)
            joined = session.join_cell_table(rows, cells, "cell", "left")
            assert join in joined._jdf.queryExecution().executedPlan().toString()
            assert sorted((r.v, r.n) for r in joined.collect()) == [("a", 2), ("b", None)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stored_tables_come_back(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("x"))
    back = session.stored(df, "points")
    assert sorted(r.x for r in back.collect()) == [float(k) for k in range(10)]
    assert session.shared_folder(spark) in back.inputFiles()[0]


def test_scratch_tables_are_removed(spark):
    with session.scratch(spark) as store:
        back = store(spark.range(5).toDF("k"), "some")
        path = Path(back.inputFiles()[0].removeprefix("file:")).parent
        assert back.count() == 5 and path.exists()
    assert not path.exists()


def test_cells_are_dealt_by_size(spark):
    """Cells of very different sizes: no task gets more than twice the median."""
    rng = random.Random(7)
    counts = [(f"_{k:06}", int(rng.paretovariate(0.8)) + 1) for k in range(5000)] + [(None, 9)]
    dealt = K.deal_cells(spark.createDataFrame(counts, "cell string, n long"), 64, 400).collect()
    assert {r.cell: r.n for r in dealt} == {c: n for c, n in counts if c and n <= 400}
    tasks = Counter()
    for r in dealt:
        tasks[r.task] += r.n
    sizes = sorted(tasks.values())
    assert 10 < len(sizes) <= 64 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert K.deal_cells(spark.createDataFrame([], "cell string, n long"), 8, 10).collect() == []


def test_a_region_reads_its_directories_only(spark, tmp_path):
    rng = random.Random(4)
    points = [(rng.random() ** 2, rng.random()) for _ in range(4000)] + [(0.5, 0.5), (0.25, 0.25), (None, 0.3)]
    df = spark.createDataFrame(points, "x double, y double")
    tree = build_quadtree(df, "x", "y", 60)
    path = str(tmp_path / "cells")
    K.write_cells(tree.assign(df, "x", "y"), path, 1000)
    written = K.read_cells(spark, path, df.schema)
    for region in (Box(0.2, 0.3, 0.6, 0.7), Box(0.25, 0.25, 0.25, 0.25), Box(0.5, 2.0, -1.0, 0.1), Box(5.0, 6.0, 0.0, 1.0)):
        got = K.read_region(written, region, tree.box, "x", "y")
        want = [p for p in points if p[0] is not None and region.x0 <= p[0] <= region.x1 and region.y0 <= p[1] <= region.y1]
        assert sorted((r.x, r.y) for r in got.collect()) == sorted(want)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(cell" in plan or not want
    assert K.read_region(written, Box(0.0, 1.0, 0.0, 1.0), None, "x", "y").collect() == []
    # The condition holds for few directories.
    near = K.region_cells(Box(0.2, 0.3, 0.6, 0.7), tree.box)
    leaves = [r.cell for r in tree.counts().collect()]
    touched = [c for c in leaves if any(c.startswith(n) or n.startswith(c) for n in near)]
    assert len(touched) < len(leaves) / 5 and len(near) <= K.REGION_CELLS


def test_lines_say_where_they_came_from(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"part-{k}.csv").write_text("".join(f"{k},{i}.5,2,x\n" for i in range(4)) + "\n1,2\n")
    at = {"id": 0, "x": 1, "y": 2}
    rows = catalogue.read_lines(spark, str(tmp_path / "part-*.csv"), at, "x", "y", sources=True).collect()
    assert len(rows) == 12 and all(r.file.endswith(f"part-{r.data[0]}.csv") and r.block == 0 for r in rows)
    plain = catalogue.read_lines(spark, str(tmp_path / "part-*.csv"), at, "x", "y")
    assert plain.columns == ["data", "x", "y"] and plain.count() == 12


def test_rejected_lines_are_counted_on_the_way(spark, tmp_path):
    lines = ["1,2.0,3.0", "", "7", "1,2", "1,two,3", "1,,3", "1,2,NaN", "1,inf,4", "1,2,3,4,5", "1,2,x"]
    (tmp_path / "rows.csv").write_text("\n".join(lines) + "\n")
    judged = catalogue.judged_lines(spark, str(tmp_path / "rows.csv"), {"id": 0, "x": 1, "y": 2}, "x", "y")
    assert {r.data: r.reason for r in judged.collect()} == {
        "1,2.0,3.0": None, "": "short", "7": "short", "1,2": "short", "1,two,3": "x", "1,,3": "x", "1,2,NaN": "y",
        "1,inf,4": "x", "1,2,3,4,5": None, "1,2,x": "y",
    }
    counted, seen = catalogue.counted_lines(judged)
    counted.filter("reason is null").write.parquet(str(tmp_path / "good"))
    assert seen.get == {"lines": 10, "short": 3, "bad_x": 3, "bad_y": 2}
    assert spark.read.parquet(str(tmp_path / "good")).count() == 2


def test_written_files_are_listed(spark, tmp_path):
    df = spark.createDataFrame([("00", "ab"), ("00", "é"), ("11", "x" * 50)], "cell string, data string")
    K.write_text(df, str(tmp_path / "out"), 1, F.col("data"))
    files = K.written_files(spark, str(tmp_path / "out")).collect()
    assert Counter(r.cell for r in files) == {"00": 2, "11": 1}
    rows = {r.cell: (r.files, r.bytes, r.n, r.text_bytes) for r in K.written_balance(spark, str(tmp_path / "out")).collect()}
    assert rows == {"00": (2, 6, 2, 4), "11": (1, 51, 1, 50)}
    plan = K.written_files(spark, str(tmp_path / "out"))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]
