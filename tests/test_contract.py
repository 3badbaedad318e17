"""Every registered query against its SQL counterpart on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import compare  # noqa: E402

import __spark_entry__ as contract  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return compare.views(FOLDER)


@pytest.mark.parametrize("name", contract.queries())
def test_query(spark, con, name):
    got = contract.queries()[name](spark, FOLDER).toPandas()
    assert len(got) > 0 or name in ("unfinished_rows", "unwritten_rows", "written_cell")
    if name in contract.oracle_sql():
        assert compare.difference(got, con.execute(contract.oracle_sql()[name]).fetch_df()) == ""


def test_every_sql_has_its_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_fitted_clusters_hold_all_rows(spark):
    sizes = contract.queries()["cluster_fit"](spark, FOLDER).toPandas()
    rows = spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()
    assert sizes["n"].sum() == rows and list(sizes["n"]) == sorted(sizes["n"])
