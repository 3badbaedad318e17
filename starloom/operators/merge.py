"""Merge small neighbouring cells until every group holds a minimum of rows.

A group is a run of cells that follow each other in id order, so its first cell names it. Nothing
grows with the members of a group except the explicit calls for its members or its whole id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom import session
from starloom.operators.ranks import with_rank

# Cells that one task walks over in a row, and members on a page of a group's id.
CHUNK_CELLS, PAGE_MEMBERS = 16_384, 1000
# Names for the groups that a chunk finds at its beginning, no cell ids.
OPEN, CLOSED = "\0open", "\0closed"


class Walk(NamedTuple):
    """Where the walk stands: rows of the last closed group, if any, and of the open one, and their first cells."""

    closed: int | None = None
    closed_head: str | None = None
    open: int = 0
    open_head: str | None = None

    @property
    def sizes(self) -> tuple[int | None, int, bool]:
        """All that the walk's further decisions depend on."""
        return self.closed, self.open, self.open_head is not None


def merge_cells(cells: DataFrame, minimum: int) -> DataFrame:
    """Group cells ``cell, n`` along their id order; ``part, cell, n, idx`` per cell.

    The first cell below the minimum joins the one on its right. Any later one joins its
    left neighbour if that is strictly smaller than the right one, else it absorbs the
    right one, and so on until the group is large enough; the last cell can only join
    the left. ``part`` is the first cell of the group, ``idx`` the cell's place among all.

    The list is walked in chunks at the same time. What a chunk does depends on two numbers only: the rows
    of the group that was closed last and of the one that is open where it begins. Chunks are
    first walked from a guess of them, and again where the chunk before ended otherwise, until the seams
    fit. Most chunks end the same way whatever they began with.
    """
    ranked = with_rank(cells.select("cell", "n"))
    chunked = ranked.withColumn("chunk", F.floor(F.col("idx") / CHUNK_CELLS))
    ordered = session.cut_lineage(chunked.repartition("chunk").sortWithinPartitions("chunk", "cell"))
    starts = _fitting_starts(ordered, minimum)
    rows = ordered.mapInPandas(
        _tell(minimum, starts, len(starts) - 1), "cell string, n bigint, idx bigint, run string, heir string"
    )
    walked = session.cut_lineage(rows)
    # A run of cells that went to the group on its left bears that one's name.
    gone = walked.filter("heir is not null").select("run", "heir")
    told = session.join_cell_table(walked.filter("cell is not null").drop("heir"), gone, "run", "left")
    return told.select(F.coalesce("heir", "run").alias("part"), "cell", "n", "idx")


def _fitting_starts(ordered: DataFrame, minimum: int) -> list[Walk]:
    """How the walk stands at the beginning of every chunk; one row per chunk comes to the driver."""
    sums = F.sum("n").alias("rows"), F.max("n").alias("most"), F.min("cell").alias("first")
    about = {r["chunk"]: r for r in ordered.groupBy("chunk").agg(*sums).collect()}
    ends: dict[int, dict[tuple, Walk]] = {chunk: {} for chunk in about}
    while True:
        state, starts, asked = Walk(), [], {}
        for chunk in range(len(about)):
            starts.append(state)
            known = ends[chunk]
            if state.sizes in known:
                state = _renamed(known[state.sizes], state)
            elif state.open + about[chunk]["rows"] < minimum and (
                state.closed is None or state.closed >= about[chunk]["most"]
            ):  # every cell joins the open group, which stays open
                rows = state.open + about[chunk]["rows"]
                state = Walk(state.closed, state.closed_head, rows, state.open_head or about[chunk]["first"])
            else:
                asked[chunk] = state
                state = _renamed(next(iter(known.values()), Walk()), state)
        if not asked or len(about) == 1:
            return starts
        wanted = {chunk: at.sizes for chunk, at in asked.items()}
        here = ordered.filter(F.col("chunk").isin(list(wanted))) if len(wanted) * 2 < len(about) else ordered
        for r in here.mapInPandas(
            _finish(minimum, wanted), "chunk bigint, closed bigint, closed_head string, open bigint, open_head string"
        ).collect():
            ends[r["chunk"]][wanted[r["chunk"]]] = Walk(r["closed"], r["closed_head"], r["open"], r["open_head"])


def _renamed(end: Walk, start: Walk) -> Walk:
    """The end of a chunk with the cells that head the groups it found at its beginning."""
    names = {OPEN: start.open_head, CLOSED: start.closed_head}
    return end._replace(
        closed_head=names.get(end.closed_head, end.closed_head), open_head=names.get(end.open_head, end.open_head)
    )


def _steps() -> Callable:
    """The rule, cell by cell. What is sent to the executors refers to nothing in this package."""

    def steps(sizes, closed, closed_head, rows, head, cells, minimum):
        """Yield, per cell, the first cell of its run, and the run that ended there with the group it joined."""
        for cell, n in zip(cells, sizes, strict=True):
            ended = None
            if head is not None and rows >= minimum:
                closed, closed_head, rows, head = rows, head, 0, None
            elif head is not None and closed is not None and closed < n:
                ended = (head, closed_head)
                closed, rows, head = closed + rows, 0, None
            head = cell if head is None else head
            rows += n
            yield head, ended, (closed, closed_head, rows, head)

    return steps


def _finish(minimum: int, wanted: dict[int, tuple]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """How the walk ends in every chunk that it is wanted for, from the sizes given for its beginning."""
    steps, open_name, closed_name = _steps(), OPEN, CLOSED

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = {}
        for batch in batches:
            for chunk, part in batch.groupby("chunk", sort=False):
                if chunk not in wanted:
                    continue
                closed, rows, is_open = wanted[chunk]
                state = at.get(chunk) or (closed, closed_name if closed is not None else None, rows, open_name if is_open else None)
                for _, _, state in steps(part["n"].tolist(), *state, part["cell"], minimum):
                    pass
                at[chunk] = state
        rows = [(chunk, *state) for chunk, state in at.items()]
        frame = pd.DataFrame(rows, columns=["chunk", "closed", "closed_head", "open", "open_head"])
        yield frame.astype({"closed": "Int64"})

    return finish


def _tell(minimum: int, starts: list, last: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The run of every cell, and a row without a cell for each run that joined a group on its left."""
    steps, states = _steps(), [tuple(start) for start in starts]

    def tell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, before = None, None
        for batch in batches:
            for chunk, part in batch.groupby("chunk", sort=False):
                state = states[chunk] if chunk != before else state
                before, runs, gone = chunk, [], []
                for run, ended, state in steps(part["n"].tolist(), *state, part["cell"], minimum):
                    runs.append(run)
                    if ended:
                        gone.append(ended)
                yield part[["cell", "n", "idx"]].assign(run=runs, heir=None)
                if gone:
                    yield pd.DataFrame(
                        {"cell": None, "n": 0, "idx": 0, "run": [g[0] for g in gone], "heir": [g[1] for g in gone]}
                    )
        if before == last:  # what is left open at the end of the list
            closed, closed_head, rows, head = state
            if rows < minimum and closed is not None:
                yield pd.DataFrame({"cell": [None], "n": 0, "idx": 0, "run": [head], "heir": [closed_head]})

    return tell


def group_runs(merged: DataFrame) -> DataFrame:
    """The groups as runs of cells: ``part, last, start, members, group_n``; ``part`` is the first cell."""
    return merged.groupBy("part").agg(
        F.max("cell").alias("last"),
        F.min("idx").alias("start"),
        F.count("*").alias("members"),
        F.sum("n").alias("group_n"),
    )


def id_pages(merged: DataFrame, page_members: int = PAGE_MEMBERS) -> DataFrame:
    """The ids of the groups, their cell ids in a row, in pages of so many members: ``part, page, ids``."""
    starts = session.cut_lineage(merged.groupBy("part").agg(F.min("idx").alias("start")))
    page = F.floor((F.col("idx") - F.col("start")) / page_members)
    paged = session.join_cell_table(merged, starts, "part", "inner").withColumn("page", page)
    return paged.groupBy("part", "page").agg(F.array_join(F.sort_array(F.collect_list("cell")), "").alias("ids"))


def whole_ids(merged: DataFrame) -> DataFrame:
    """``part, id_part``: the whole id of every group, as long as all its members together."""
    pages = F.sort_array(F.collect_list(F.struct("page", "ids")))
    joined = F.array_join(F.transform(pages, lambda p: p["ids"]), "")
    return id_pages(merged).groupBy("part").agg(joined.alias("id_part"))


def find_runs(cells: DataFrame, runs: DataFrame, cell: str = "cell") -> DataFrame:
    """Add ``part`` to a table of cell ids: the run whose first cell is the last one up to it in id order.

    This finds a group also for a cell that held no rows when the groups were made; one
    before all runs belongs to the first of them. Each range of ids looks the runs up in order.
    """
    spark = cells.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = cells.select(F.col(cell).alias("_id"), F.lit(None).cast("string").alias("_head")).distinct()
    heads = runs.select(F.col("part").alias("_id"), F.col("part").alias("_head"))
    both = ids.unionByName(heads).repartitionByRange(n, "_id").sortWithinPartitions("_id", F.desc_nulls_last("_head"))
    both = session.cut_lineage(both.withColumn("_range", F.spark_partition_id()))
    # What a range inherits from the ones before it; one row per range.
    lasts = {r["_range"]: r["last"] for r in both.groupBy("_range").agg(F.max("_head").alias("last")).collect()}
    first = runs.agg(F.min("part")).first()[0]
    inherited, at = [], first
    for k in range(max(lasts, default=-1) + 1):
        inherited.append(at)
        at = lasts.get(k) or at

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head, here = None, None
        for batch in batches:
            found = []
            for one, own, number in zip(batch["_id"], batch["_head"], batch["_range"], strict=True):
                if number != here:
                    head, here = inherited[number], number
                head = own if own is not None else head
                found.append((one, head) if own is None else None)
            yield pd.DataFrame([f for f in found if f], columns=["_id", "part"])

    known = session.cut_lineage(both.mapInPandas(look_up, "_id string, part string"))
    return session.join_cell_table(cells, known.withColumnRenamed("_id", cell), cell, "left")


def retag(df: DataFrame, merged: DataFrame, cell: str = "cell") -> DataFrame:
    """Replace the leaf id of tagged rows by the name of its merged group, ``part``."""
    names = merged.select(F.col("cell").alias(cell), "part")
    return session.join_cell_table(df, names, cell, "left").drop(cell)
