"""Hard-negative mining by slots of scores.

The score of a row is its integer inner product with an anchor. The upper limits of an
anchor's windows, one for each of its positives, split the scores into disjoint slots. Every task keeps
the best rows of each slot, so does the shuffle, and a window is answered by
what is left of its own slot and the lower ones, merged from the highest score down.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import cut_lineage

# Anchors are sent to all tasks in groups of at most so many bytes, and scored in blocks of so
# many anchors by so many rows.
GROUP_BYTES, BLOCK_ANCHORS, BLOCK_ROWS = 16 << 20, 128, 8192
SCALE = 256
# Up to here sums of doubles that are whole numbers are exact.
EXACT = float(1 << 53)
MOST = (1 << 63) - 1
FOUND = "anchor bigint, slot int, score bigint, key bigint, itself boolean"


def usable_vectors(df: DataFrame, is_anchor: Column, key: str, label: str, vector: str) -> DataFrame:
    """Rows that take part, as ``key, label, vector, is_anchor``."""
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    rows = df.select(
        F.col(f"`{key}`").cast("long").alias("key"),
        F.col(f"`{label}`").cast("long").alias("label"),
        F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double") * SCALE).alias("vector"),
        is_anchor.alias("is_anchor"),
    )
    return rows.filter(F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Whole components, one row per vector; shorter vectors are filled up with zeros."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(np.asarray(vectors.offsets, np.int64))
    values = np.floor(np.asarray(vectors.flatten(), np.float64))
    out = np.zeros((len(sizes), max(width, int(sizes.max(initial=0)))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = values
    return out


def _widened(a: np.ndarray, width: int) -> np.ndarray:
    return np.pad(a, ((0, 0), (0, max(0, width - a.shape[1]))))


def _products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact; beyond 64 bits the outermost number of them."""
    scores = anchors @ rows.T
    bound = np.abs(anchors).max(initial=0) * np.abs(rows).max(axis=1, initial=0) * rows.shape[1]
    large = np.flatnonzero(bound >= EXACT)
    with np.errstate(invalid="ignore"):
        out = scores.astype(np.int64)
    if len(large):
        whole = np.frompyfunc(int, 1, 1)
        exact = whole(anchors).astype(object) @ whole(rows[large]).astype(object).T
        out[:, large] = np.clip(exact, -MOST, MOST).astype(np.int64)
    return out


def _best(anchor, slot, score, null, key, itself, most: int) -> tuple[np.ndarray, ...]:
    """The first rows of every anchor and slot, by score from the top, then by key, null keys last."""
    order = np.lexsort((key, null, -score, slot, anchor))
    columns = [a[order] for a in (anchor, slot, score, null, key, itself)]
    new = np.flatnonzero((np.diff(columns[0], prepend=-1) != 0) | (np.diff(columns[1], prepend=-1) != 0))
    nth = np.arange(len(order)) - np.repeat(new, np.diff(new, append=len(order)))
    return tuple(a[nth < most] for a in columns)


def _search(sent, same_label: bool, most: int):
    """Best rows per anchor and slot among the rows of a task; ``sent`` holds a group of anchors."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, anchor_keys, no_key, labels, anchors, uppers, lowest = sent.value
        own_scores = np.concatenate([_products(a[None], a[None])[0] for a in anchors])
        none = tuple(np.zeros(0, kind) for kind in (np.int64, np.int64, np.int64, bool, np.int64, bool))
        blocks = [slice(at, at + BLOCK_ANCHORS) for at in range(0, len(anchors), BLOCK_ANCHORS)]
        held = [none] * len(blocks)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                nulls, keys = np.asarray(part.column(0).is_null()), np.asarray(part.column(0).fill_null(0))
                row_labels = np.asarray(part.column(1))
                rows = _matrix(part.column(2), anchors.shape[1])
                own = np.pad(anchors, ((0, 0), (0, rows.shape[1] - anchors.shape[1])))
                for k, block in enumerate(blocks):
                    scores = _products(own[block], rows)
                    fits = (labels[block][:, None] == row_labels) == same_label
                    fits &= (scores <= uppers[block, :1]) & (scores >= lowest[block][:, None])
                    a, r = np.nonzero(fits)
                    score, a = scores[a, r], a + block.start
                    # A score lies in the slot of the least upper limit that is not below it.
                    slot = (uppers[a] >= score[:, None]).sum(axis=1) - 1
                    itself = (score == own_scores[a]) & (keys[r] == anchor_keys[a]) & (nulls[r] == no_key[a])
                    fresh = (number[a], slot, score, nulls[r], keys[r], itself)
                    held[k] = _best(*[np.concatenate(both) for both in zip(held[k], fresh, strict=True)], most)
        anchor, slot, score, null, key, itself = [np.concatenate(parts) for parts in zip(none, *held, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchor), pa.array(slot.astype(np.int32)), pa.array(score), pa.array(key, mask=null), pa.array(itself)],
            ["anchor", "slot", "score", "key", "itself"],
        )

    return search


def _found(rows: DataFrame, anchors: DataFrame, same_label: bool, most: int) -> DataFrame:
    """Per anchor its best rows, highest score first: ``anchor, best`` with ``down, none, key, slot, itself``.

    ``anchors``: ``group, number, key, label, vector`` and, if they have windows, ``uppers`` and ``lowest``.
    The rows are scanned once for each group of anchors. What the tasks keep is cut again before the
    shuffle and after it, to ``most`` rows for each slot.
    """
    out = rows.sparkSession.createDataFrame([], FOUND)
    groups = anchors.agg(F.max("group")).first()[0]
    for group in range(0 if groups is None else groups + 1):
        here = anchors.filter(F.col("group") == group).toArrow()
        if not here.num_rows:
            continue
        uppers, lowest = np.full((here.num_rows, 1), MOST), np.full(here.num_rows, -MOST)
        if "uppers" in here.column_names:
            uppers = np.array(here["uppers"].to_pylist(), np.int64)
            lowest = here["lowest"].to_numpy()
        keys = here["key"].combine_chunks()
        about = (here["number"].to_numpy(), np.asarray(keys.fill_null(0)), np.asarray(keys.is_null()), here["label"].to_numpy())
        sent = rows.sparkSession.sparkContext.broadcast((*about, _matrix(here["vector"], 0), uppers, lowest))
        out = out.unionByName(rows.mapInArrow(_search(sent, same_label, most), FOUND))
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    first = out.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= most)
    entry = F.struct((-F.col("score")).alias("down"), F.col("key").isNull().alias("none"), "key", "slot", "itself")
    return first.groupBy("anchor").agg(F.sort_array(F.collect_list(entry)).alias("best"))


def _grouped(anchors: DataFrame) -> DataFrame:
    """Number the anchors and cut them into groups of bounded size, without ordering them in one task."""
    size = F.lit(64).cast("long") + 8 * F.size("vector")
    numbers = {"number": F.monotonically_increasing_id(), "task": F.spark_partition_id(), "size": size}
    stored = cut_lineage(anchors.withColumns(numbers))
    sizes = stored.groupBy("task").agg(F.sum("size").alias("bytes"))
    # One row per task, so this ordering without a key stays small.
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("task", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("task").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    placed = stored.join(starts, "task").withColumn("group", F.floor(at / GROUP_BYTES))
    return cut_lineage(placed.select("group", "number", "key", "label", "vector", "copies"))


def _limit(score: Column, percent: int, up: bool) -> Column:
    """The whole number at or beside ``percent`` of a score, as a long."""
    share = score.cast("decimal(20,0)") * percent / F.lit(100).cast("decimal(3,0)")
    whole = F.ceil(share) if up else F.floor(share)
    return F.least(F.greatest(whole.cast("decimal(38,0)"), F.lit(-MOST)), F.lit(MOST)).cast("long")


def mine_hard_negatives(
    df: DataFrame,
    is_anchor: Column,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
    window: tuple[int, int] = (80, 100),
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows for which ``is_anchor`` holds. An anchor's positives are its best
    other rows of the same label; for each of them the best rows of other labels are returned
    whose score is between the two percentages of ``window`` (at most 100) of the positive's.
    Scores are inner products of ``floor(256 * x)``; on a tie the smaller key comes first,
    a null key last.

    Rows without label or vector, or with a component that is null or not finite, take no part. A shorter
    vector counts as filled up with zeros. Scores are exact; beyond 64 bits they are the outermost
    64-bit number. A repeated row is another row: as an anchor it is answered each time, and is
    among its own positives. Other columns play no part; an empty table gives no rows.
    """
    low, high = window
    if not 0 <= low <= high <= 100:
        raise ValueError("the window lies between 0 and 100 percent of the positive's score")
    rows = usable_vectors(df, is_anchor, key, label, vector)
    chosen = rows.filter("is_anchor").groupBy("key", "label", "vector").agg(F.count("*").alias("copies"))
    anchors, rows = _grouped(chosen), rows.drop("is_anchor")
    # An anchor is among the best of its label, or others fill the list: its first entry that has its
    # key and its score with itself is taken out.
    listed = anchors.join(_found(rows, anchors, True, positives + 1), F.col("number") == F.col("anchor"))
    place = F.array_position(F.transform("best", lambda b: b["itself"]), True)
    listed = listed.withColumn("place", place)
    others = F.filter("best", lambda b, i: i != F.col("place") - 1)
    listed = listed.withColumn("positives", F.slice(others, 1, positives)).filter(F.size("positives") > 0)
    uppers = F.transform("positives", lambda b: _limit(-b["down"], high, up=False))
    # Fewer positives leave slots that no score falls into.
    filled = F.concat(uppers, F.array_repeat(F.lit(-MOST - 1).cast("long"), F.lit(positives) - F.size(uppers)))
    lowest = F.array_min(F.transform("positives", lambda b: _limit(-b["down"], low, up=True)))
    windows = cut_lineage(listed.drop("anchor", "best", "place").withColumns({"uppers": filled, "lowest": lowest}))

    # At most ``positives * negatives`` rows per anchor are left to merge.
    best = _found(rows, windows.drop("positives", "copies"), False, negatives)
    asked = windows.select("number", F.col("key").alias("anchor_id"), "copies", F.posexplode("positives").alias("at", "positive"))
    joined = asked.join(best, F.col("number") == F.col("anchor"))
    merged = F.slice(F.filter("best", lambda b: b["slot"] >= F.col("at")), 1, negatives)
    score = -F.col("positive.down")
    answer = F.filter(merged, lambda b: -b["down"] >= _limit(score, low, up=True))
    out = joined.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        "anchor_id",
        F.col("positive.key").alias("positive_id"),
        score.alias("positive_score"),
        F.posexplode(answer).alias("place", "negative"),
    )
    return out.select(
        "anchor_id",
        "positive_id",
        (F.col("place") + 1).alias("rank"),
        F.col("negative.key").alias("negative_id"),
        "positive_score",
        (-F.col("negative.down")).alias("negative_score"),
    )
