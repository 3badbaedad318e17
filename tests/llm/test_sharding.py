"""Permutation, row numbers, shards and slots."""

import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from starloom.llm import queries
from starloom.llm.sharding import Permutation, feistel_shards, number_rows

from cases import EMPTY, SCHEMA, case_rows

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("n", [1, 2, 3, 5, 24, 1000, 4096, 4097])
def test_permutation(n):
    permutation = Permutation(n, 7)
    places = permutation.places(np.arange(n))
    assert sorted(places) == list(range(n))
    assert (permutation.places(places, backwards=True) == np.arange(n)).all()
    assert (places == Permutation(n, 7).places(np.arange(n))).all()
    if n >= 1000:
        assert (places != Permutation(n, 8).places(np.arange(n))).any()
        assert abs(np.corrcoef(np.arange(n), places)[0, 1]) < 0.15


def check(rows, n_rows, shards):
    counts = Counter(r.shard for r in rows)
    sizes = [counts[s] for s in range(shards)]
    assert sum(sizes) == n_rows and max(sizes) - min(sizes) <= 1
    for shard in range(shards):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(counts[shard]))
    assert sorted(r.row_number for r in rows) == list(range(n_rows))
    permutation = Permutation(n_rows)
    for row in rows:  # shard and slot can be computed from the number alone
        place = int(permutation.places(np.array([row.row_number]))[0])
        assert (row.shard, row.slot) == (place % shards, place // shards)


def test_shards(spark):
    df = spark.range(0, 1000, 1, 7).selectExpr("(id * 37) % 1000 AS doc_id", "'x' AS shard")
    rows = feistel_shards(df, 24, ["doc_id"]).collect()
    check(rows, 1000, 24)
    assert all(r.row_number == r.doc_id for r in rows)
    again = feistel_shards(df.repartition(3), 24, ["doc_id"]).collect()
    assert {tuple(r) for r in rows} == {tuple(r) for r in again}


def test_hot_key_and_awkward_rows(spark):
    hot = spark.createDataFrame([(5 if k % 3 == 0 else k, "t") for k in range(3000)], "doc_id bigint, text string")
    numbered, n = number_rows(hot, ["doc_id"])
    rows = numbered.collect()
    assert n == 3000 and sorted(r.row_number for r in rows) == list(range(3000))
    order = sorted(rows, key=lambda r: r.row_number)
    assert [r.doc_id for r in order] == sorted(r.doc_id for r in rows)
    # The rows of the hot key do not meet in one partition.
    spread = Counter(r.p for r in numbered.filter("doc_id = 5").selectExpr("spark_partition_id() AS p").collect())
    assert len(spread) > 1

    awkward = feistel_shards(spark.createDataFrame(case_rows(), SCHEMA), 4, ["doc_id", "text"]).collect()
    check(awkward, len(case_rows()), 4)
    assert [r.doc_id for r in sorted(awkward, key=lambda r: r.row_number)][:2] == [None, None]
    assert feistel_shards(spark.createDataFrame([], EMPTY), 4, ["doc_id"]).count() == 0


def place_by_hand(number, n, seed=20_240):
    """The network with plain integers, walked until the number is below n."""
    word = (1 << 64) - 1

    def mix(v):
        v &= word
        v = (v ^ v >> 30) * 0xBF58476D1CE4E5B9 & word
        v = (v ^ v >> 27) * 0x94D049BB133111EB & word
        return v ^ v >> 31

    bits = 1
    while 1 << 2 * bits < n:
        bits += 1
    while True:
        left, right = number >> bits, number & (1 << bits) - 1
        for k in range(1, 7):
            left, right = right, left ^ mix(right ^ mix(seed + n + k)) & (1 << bits) - 1
        number = left << bits | right
        if number < n:
            return number


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
def test_the_query(spark):
    """Sizes, checksums, the law and the places of all documents, none of them by the code under test."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.op2_feistel_sharding(spark, FOLDER).collect()
    assert len(rows) == len(docs)
    content = lambda text: (text or "").encode()
    got = Counter((r.doc_id, r.size, r.text_crc32) for r in rows)
    assert got == Counter((d.doc_id, len(content(d.text)) + 8, zlib.crc32(content(d.text))) for d in docs)
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
    order = sorted(rows, key=lambda r: r.row_number)
    assert [r.doc_id for r in order] == sorted(d.doc_id for d in docs)
    for row in rows:
        place = place_by_hand(row.row_number, len(docs))
        assert (row.shard, row.slot) == (place % 24, place // 24)
