"""Shards by a keyed permutation of row numbers.

A Feistel network permutes the numbers 0 to 2^w - 1, and cycle walking narrows that to the
numbers of rows: a result that is too large is permuted again until it is not. The
place of a row in the shuffled order is computed from its row number alone, the shard and
the slot follow from the place, and the inverse gives the row at any place. Nothing of
the order has to be stored, and the same rows and seed give the same shards again.

The row number is the rank of a row in the order of its key. Rows are sorted by ranges of
the key, and each row adds the number of rows in the ranges before its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.words import mixed
from starloom.session import cut_lineage

ROUNDS = 6
SEED = 20_240


class Permutation:
    """A keyed permutation of the numbers below ``n``."""

    def __init__(self, n: int, seed: int = SEED) -> None:
        self.n = n
        # Bits of each half: both together hold every number.
        self.bits = np.uint64(max(1, -(-max(n - 1, 1).bit_length() // 2)))
        self.mask = (np.uint64(1) << self.bits) - np.uint64(1)
        self.keys = mixed(np.uint64(seed) + np.uint64(n) + np.arange(1, ROUNDS + 1, dtype=np.uint64))

    def _network(self, numbers: np.ndarray, backwards: bool) -> np.ndarray:
        left, right = numbers >> self.bits, numbers & self.mask
        if backwards:
            for key in self.keys[::-1]:
                left, right = right ^ (mixed(left ^ key) & self.mask), left
        else:
            for key in self.keys:
                left, right = right, left ^ (mixed(right ^ key) & self.mask)
        return left << self.bits | right

    def places(self, numbers: np.ndarray, backwards: bool = False) -> np.ndarray:
        """Where row numbers come in the shuffled order; ``backwards`` the rows at those places."""
        found = self._network(numbers.astype(np.uint64), backwards)
        while len(outside := np.flatnonzero(found >= np.uint64(self.n))):
            found[outside] = self._network(found[outside], backwards)
        return found.astype(np.int64)


def number_rows(df: DataFrame, order: list[str], number: str = "row_number") -> tuple[DataFrame, int]:
    """Add the rank of every row, from 0 and without gaps, in the order of some columns; and count them.

    Nulls come first. Rows that are equal in those columns are told apart by where they
    were read, so that a mass of them still spreads over several ranges. The sorted rows are
    checkpointed: ranges drawn anew by a retried task could not be numbered.
    """
    part, read = "_number_part", "_number_read"
    keys = [F.col(f"`{name}`").asc_nulls_first() for name in order] + [F.col(read)]
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.drop(number).withColumn(read, F.monotonically_increasing_id())
    ranges = rows.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys).drop(read)
    stored = cut_lineage(ranges.withColumn(part, F.spark_partition_id()))
    # One count per partition of the shuffle.
    firsts, total = {}, 0
    for row in stored.groupBy(part).count().orderBy(part).collect():
        firsts[row[part]] = total
        total += row["count"]
    out = T.StructType([*stored.schema.fields[:-1], T.StructField(number, T.LongType(), False)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = None
        for batch in batches:
            if batch.num_rows:
                done = firsts[batch.column(batch.num_columns - 1)[0].as_py()] if done is None else done
                numbers = pa.array(np.arange(done, done + batch.num_rows))
                done += batch.num_rows
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], numbers], out.names)

    return stored.mapInArrow(count, out), total


def feistel_shards(
    df: DataFrame, n_shards: int, order: list[str], seed: int = SEED, number: str = "row_number"
) -> DataFrame:
    """Add the row number, ``shard`` and ``slot`` of every row; shard sizes differ by one at most.

    Row number i stands at place p of the shuffled order; its shard is p modulo
    ``n_shards``, its slot the quotient, so slots have no gaps. Null keys come first,
    equal rows are interchangeable, an empty table stays empty, and columns named as the
    new ones are replaced. Whole rows are sorted, so leave out columns that are not needed.
    """
    numbered, n = number_rows(df.drop("shard", "slot"), order, number)
    out = T.StructType([*numbered.schema.fields, *T._parse_datatype_string("shard int, slot bigint").fields])
    at = numbered.columns.index(number)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        permutation = Permutation(n, seed)
        for batch in batches:
            slot, shard = np.divmod(permutation.places(np.asarray(batch.column(at), np.int64)), n_shards)
            added = [pa.array(shard.astype(np.int32)), pa.array(slot)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], out.names)

    return numbered.mapInArrow(place, out)
