"""What the library needs from the session: a shared folder and checked broadcasts."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest table to send to every executor, and what a row takes there beyond its text:
# the header, the key and the pointers, and a slot per column.
BROADCAST_BYTES = 128 << 20
ROW_BYTES, COLUMN_BYTES = 64, 16

# Folders that are deleted at the same time.
REMOVERS = 16
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

# Folders of the scopes that are open, the innermost one last.
_SCOPES: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and every executor can reach.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local session,
    where everything runs on one machine, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="starloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder, or in that of the innermost scope, that nothing has been written to yet."""
    folder = _SCOPES[-1] if _SCOPES else f"{shared_folder(spark).rstrip('/')}/starloom"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint a derived table so that later jobs read it instead of computing it again."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a derived table to the shared folder and read it from there."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Like :func:`stored`, for tables that are removed at the end of the block."""
    paths: list[str] = []

    def store(df: DataFrame, name: str) -> DataFrame:
        paths.append(fresh_path(spark, name))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield store
    finally:
        for path in paths:
            remove(spark, path)


@contextlib.contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Checkpoints and stored tables made within the block are removed at its end.

    What the block computes lazily must be written or collected within it.
    """
    context = spark.sparkContext
    shared_folder(spark)
    scala = context._jsc.sc()
    before = scala.checkpointDir()
    own = fresh_path(spark, "scope")
    _SCOPES.append(own)
    context.setCheckpointDir(own)
    try:
        yield
    finally:
        # The folder of the session again, as it was: setting it by name would make another one.
        getattr(scala, "checkpointDir_$eq")(before)
        _SCOPES.remove(own)
        remove(spark, own)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete files or folders, if they are there; many of them some at a time."""
    conf, hadoop = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs

    def delete(path: str) -> None:
        place = hadoop.Path(path)
        place.getFileSystem(conf).delete(place, True)

    with ThreadPoolExecutor(REMOVERS) as pool:
        list(pool.map(delete, paths))


@contextlib.contextmanager
def listing_in_few_tasks(spark: SparkSession) -> Iterator[None]:
    """Within the block many directories are listed by some tasks per core; otherwise each has a task of its own."""
    before = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(LISTING_TASKS, before)


def row_bytes(table: DataFrame) -> Column:
    """Upper bound of what a row takes in a broadcast table."""
    texts = [F.coalesce(F.octet_length(name), F.lit(0)) for name, kind in table.dtypes if kind == "string"]
    fixed = F.lit(ROW_BYTES + COLUMN_BYTES * len(table.columns)).cast("long")
    return sum(texts, fixed)


def join_cell_table(df: DataFrame, cells: DataFrame, on, how: str, size: int | None = None) -> DataFrame:
    """Join rows to a table of cells, broadcasting the cells only if they are small enough.

    ``size`` is the size of the table in bytes, measured if it is not known. Above the
    limit the join carries no hint: Spark shuffles both sides and adaptive execution
    splits the hot keys.
    """
    if size is None:
        size = cells.agg(F.sum(row_bytes(cells)).alias("size")).first().size or 0
    return df.join(F.broadcast(cells) if size <= BROADCAST_BYTES else cells, on, how)
