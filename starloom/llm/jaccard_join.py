"""Similarity join on word n-grams: MinHash candidates, Bayesian pruning, exact verification.

1. Every text becomes the set of its word 5-grams, a MinHash signature and hashes of the
   signature's bands. Texts with equal sets are one class from here on.
2. Classes that share a band are candidates. Their signatures are compared step by step; a
   pair is dropped as soon as the posterior probability that its similarity reaches the
   threshold, given the agreements so far and a uniform prior, falls below a tolerance.
3. What is left ties classes to groups. Inside a group the similarity of every pair is computed
   exactly from the sets, so groups hold all links, also between texts that never shared
   a band.

No step emits pairs. Buckets and groups of any size are cut into blocks, and a task that
sees two blocks returns a row per class: its links, and a spanning tree of them.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.batches import slices, texts_of
from starloom.llm.components import connected_components
from starloom.llm.words import WINDOW_WORDS, find_words, hash_rows, mixed, windows, word_hashes
from starloom.session import cut_lineage, join_cell_table

THRESHOLD = 0.8
# Pairs below this probability of reaching the threshold are dropped.
TOLERANCE = 1e-5
# A pair at the threshold shares no band with probability (1 - 0.8**4)**24, some 3e-6.
BANDS, BAND_ROWS = 24, 4
HASHES = 128
# Signature values that are compared before the next decision.
STEP = 16
# A value is kept as one byte, so two different ones agree with this probability.
ACCIDENT = 1 / 256
# Most classes of a block, and n-grams of a block.
BLOCK_ROWS, BLOCK_GRAMS = 2048, 4_000_000
# Pairs compared at once, and cells of the matrix that is multiplied at once.
PAIRS_AT_ONCE, CELLS_AT_ONCE = 1 << 19, 1 << 24


# ---------------------------------------------------------------- sets and signatures


def gram_sets(texts: pa.Array, size: int = WINDOW_WORDS) -> list[np.ndarray]:
    """Sorted hashes of the distinct word n-grams of every text; all words if there are fewer."""
    words = find_words(texts)
    hashes = word_hashes(words)
    grams, firsts = windows(hashes, words, size)
    starts = np.searchsorted(firsts, words.starts)
    short = hash_rows(hashes, words.starts[:-1], np.where(words.per_text < size, words.per_text, 0))
    sets = []
    for row, n in enumerate(words.per_text):
        own = grams[starts[row] : starts[row + 1]] if n >= size else short[row : row + 1] if n else short[:0]
        sets.append(np.unique(own))
    return sets


def set_hash(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values of sets that are not empty, a row each."""
    out = np.zeros((len(sets), HASHES), np.uint32)
    if not sets:
        return out
    values = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    keys = mixed(np.arange(1, 2 * HASHES + 1, dtype=np.uint64))
    turn, scale = keys[:HASHES].astype(np.uint32), keys[HASHES:].astype(np.uint32) | np.uint32(1)
    work = np.empty_like(values)
    for k in range(HASHES):
        np.bitwise_xor(values, turn[k], out=work)
        np.multiply(work, scale[k], out=work)
        np.bitwise_xor(work, work >> np.uint32(15), out=work)
        out[:, k] = np.minimum.reduceat(work, starts)
    return out


def band_hashes(values: np.ndarray) -> np.ndarray:
    """One 64-bit hash per band and row of signatures."""
    parts = values[:, : BANDS * BAND_ROWS].reshape(len(values), BANDS, BAND_ROWS).astype(np.uint64)
    found = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2])
    for k in range(BAND_ROWS):
        found = mixed(found * np.uint64(3) + parts[:, :, k])
    return found.view(np.int64)


@functools.lru_cache(16)
def least_agreements(threshold: float, tolerance: float) -> tuple[int, ...]:
    """Fewest agreements among the first STEP, 2 STEP, ... values that keep a pair.

    With similarity s, a value agrees with probability s + (1 - s) / 256. The posterior
    of s under a uniform prior is integrated on a grid.
    """
    s = (np.arange(4000) + 0.5) / 4000
    agree = s + (1 - s) * ACCIDENT
    found = []
    for n in range(STEP, HASHES + 1, STEP):
        m = np.arange(n + 1)[:, None]
        weight = m * np.log(agree) + (n - m) * np.log1p(-agree)
        weight = np.exp(weight - weight.max(1, keepdims=True))
        chance = weight[:, s >= threshold].sum(1) / weight.sum(1)
        found.append(int(np.argmax(chance >= tolerance)))
    return tuple(found)


def surviving(values: np.ndarray, left: np.ndarray, right: np.ndarray, least: tuple[int, ...]) -> np.ndarray:
    """Which pairs of rows are left after all steps of the pruning."""
    alive = np.arange(len(left))
    agreed = np.zeros(len(left), np.int32)
    for step, fewest in enumerate(least):
        part = slice(step * STEP, (step + 1) * STEP)
        agreed = agreed + (values[left[alive], part] == values[right[alive], part]).sum(1)
        ok = agreed >= fewest
        alive, agreed = alive[ok], agreed[ok]
    return alive


def least_linked(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of n rows the least row it is tied to, by any chain of links."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if (label == before).all():
            break
    return label


# ---------------------------------------------------------------- runs of sorted rows


def whole_runs(batches: Iterator[pa.RecordBatch], keys: int, rows: int) -> Iterator[pa.Table]:
    """Tables that hold whole runs of rows with equal leading columns, of about so many rows."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count >= rows:
            table = pa.Table.from_batches(held)
            starts = run_starts(table, keys)
            last = int(starts[-2])
            if last:
                yield table.slice(0, last)
            held, count = table.slice(last).combine_chunks().to_batches(), table.num_rows - last
            rows = max(rows, 2 * count)
    if held:
        yield pa.Table.from_batches(held)


def run_starts(table: pa.Table, keys: int) -> np.ndarray:
    """Where runs of rows with equal leading columns begin, with the end at last."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for k in range(keys):
        column = table.column(k).combine_chunks()
        column = column.dictionary_encode().indices if pa.types.is_binary(column.type) else column
        values = np.asarray(column)
        new[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)


def with_block_pairs(rows: DataFrame, blocks: str, block: str) -> DataFrame:
    """A row for every pair of blocks that its own block belongs to: ``low, high``."""
    other = F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    return (
        rows.withColumn("_other", other)
        .withColumn("low", F.least(block, "_other"))
        .withColumn("high", F.greatest(block, "_other"))
        .drop("_other")
    )


# ---------------------------------------------------------------- steps


def _signed(docs: DataFrame, size: int) -> DataFrame:
    """``key, row_hash, grams_hash, n_grams, signature, bands`` per document."""
    out = T.StructType([
        docs.schema["key"], docs.schema["row_hash"],
        *T._parse_datatype_string("grams_hash binary, n_grams int, signature binary, bands array<bigint>").fields,
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(2))
            for begin, end in slices(texts):
                sets = gram_sets(texts_of(texts.slice(begin, end - begin)), size)
                some = [k for k, grams in enumerate(sets) if len(grams)]
                values = signatures([sets[k] for k in some])
                short = [b""] * len(sets)
                bands: list[np.ndarray | list] = [[]] * len(sets)
                for k, row, keys in zip(some, values.astype(np.uint8), band_hashes(values), strict=True):
                    short[k], bands[k] = row.tobytes(), keys
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, end - begin),
                        batch.column(1).slice(begin, end - begin),
                        pa.array([set_hash(grams) for grams in sets], pa.binary()),
                        pa.array([len(grams) for grams in sets], pa.int32()),
                        pa.array(short, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    out.names,
                )

    return docs.select("key", "row_hash", "text").mapInArrow(run, out)


def _pruned(least: tuple[int, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Ties ``a, b`` from rows ``band, low, high, grams_hash, signature``, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, 3, 50_000):
            starts = run_starts(table, 3)
            names = table.column(3).combine_chunks()
            values = np.frombuffer(b"".join(table.column(4).to_pylist()), np.uint8).reshape(-1, HASHES)
            n = len(names)
            ends = np.repeat(starts[1:], np.diff(starts))
            partners = ends - np.arange(n) - 1
            upto = np.concatenate([[0], np.cumsum(partners)])
            lefts, rights = [], []
            row = 0
            while row < n:
                last = max(row + 1, int(np.searchsorted(upto, upto[row] + PAIRS_AT_ONCE, "right")) - 1)
                count = partners[row:last]
                left = np.repeat(np.arange(row, last), count)
                right = left + 1 + np.arange(len(left)) - np.repeat(upto[row:last] - upto[row], count)
                alive = surviving(values, left, right, least)
                lefts.append(left[alive])
                rights.append(right[alive])
                row = last
            label = least_linked(n, np.concatenate(lefts), np.concatenate(rights))
            tied = np.flatnonzero(label != np.arange(n))
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(tied)), names.take(pa.array(label[tied]))], ["a", "b"]
            )

    return run


def shared_grams(sets: list[np.ndarray], first: int) -> np.ndarray:
    """How many n-grams each of the first sets shares with every set."""
    grams, column = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    often = np.bincount(column, minlength=len(grams)) > 1
    place = np.cumsum(often) - 1
    use = often[column]
    column, owner = place[column[use]], owner[use]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    shared = np.zeros((first, len(sets)), np.float64)
    width = max(1, CELLS_AT_ONCE // len(sets))
    for begin in range(0, int(often.sum()), width):
        low, high = np.searchsorted(column, (begin, begin + width))
        cells = np.zeros((len(sets), min(width, int(often.sum()) - begin)), np.float32)
        cells[owner[low:high], column[low:high] - begin] = 1
        shared += cells[:first] @ cells.T
    return shared


def _verified(share: Fraction) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``grams_hash, n_links, tied_to`` from rows ``group, low, high, block, grams_hash, copies, grams``, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, 3, 2000):
            starts = run_starts(table, 3)
            names = table.column(4).combine_chunks()
            links, tied = np.zeros(len(names), np.int64), np.arange(len(names))
            for begin, end in zip(starts[:-1], starts[1:], strict=True):
                part = table.slice(begin, end - begin)
                low, high = part.column(1)[0].as_py(), part.column(2)[0].as_py()
                block = np.asarray(part.column(3))
                # Rows of the lower block first; inside one block every pair counts.
                order = np.argsort(block, kind="stable")
                first = int((block == low).sum())
                contents = part.column(6).to_pylist()
                sets = [np.frombuffer(contents[k], np.uint64) for k in order]
                copies = np.asarray(part.column(5), np.int64)[order]
                sizes = np.array([len(s) for s in sets])
                if len(sets) < 2 or not first:
                    continue
                shared = shared_grams(sets, first).astype(np.int64)
                either = sizes[:first, None] + sizes - shared
                linked = shared * share.denominator >= either * share.numerator
                if low == high:
                    np.fill_diagonal(linked, False)
                    own = linked @ copies
                else:
                    linked[:, :first] = False
                    own = linked @ copies
                    own = np.concatenate([own, linked[:, first:].T @ copies[:first]])
                links[begin + order[: len(own)]] = own
                left, right = np.nonzero(linked)
                label = least_linked(len(sets), left, right)
                tied[begin + order] = begin + order[label]
            yield pa.RecordBatch.from_arrays([names, pa.array(links), names.take(pa.array(tied))],
                                             ["grams_hash", "n_links", "tied_to"])

    return run


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    size: int = WINDOW_WORDS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Classes and links of documents whose word n-gram sets are similar, a row per document.

    ``key``; ``row_hash``, of key and text; ``copy_id``, the least key among texts with the
    same set; ``class_id``, the least key that any chain of links leads to; ``n_links``, the
    other documents of at least the similarity ``threshold``, copies included; ``kept``, true
    for one document of each class (and for rows equal to it in key and text).

    A text of fewer words than ``size`` has the set of all its words in a row. Texts without
    words, null or empty, have the empty set and are copies of each other. Null keys come
    after all others. Repeated rows count each. Other columns are left out.
    """
    share = Fraction(str(threshold))
    docs = df.select(
        F.col(f"`{key}`").alias("key"),
        F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("row_hash"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    signed = cut_lineage(_signed(docs, size))
    place = F.struct(F.col("key").isNull().alias("none"), "key", "row_hash")
    classes = cut_lineage(
        signed.groupBy("grams_hash").agg(
            F.min(place).alias("first"),
            F.count("*").alias("copies"),
            F.first("n_grams").alias("n_grams"),
            F.first("signature").alias("signature"),
            F.first("bands").alias("bands"),
        )
    )

    # Candidates: classes that share a band, block by block.
    banded = classes.select("grams_hash", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK_ROWS).cast("int")
    placed = banded.join(shared, "band").select("band", "grams_hash", blocks.alias("blocks"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("grams_hash"), F.col("blocks").cast("long")).cast("int"))
    placed = with_block_pairs(placed, "blocks", "block").join(classes.select("grams_hash", "signature"), "grams_hash")
    ordered = placed.select("band", "low", "high", "grams_hash", "signature")
    ordered = ordered.repartition("band", "low", "high").sortWithinPartitions("band", "low", "high")
    ties = ordered.mapInArrow(_pruned(least_agreements(threshold, tolerance)), "a binary, b binary")
    groups = cut_lineage(connected_components(ties))

    # Groups: every pair of a group exactly, block by block.
    members = groups.join(classes, F.col("node") == F.col("grams_hash")).select(
        "component", "grams_hash", "copies", "n_grams", F.col("first.row_hash").alias("row_hash")
    )
    sums = members.groupBy("component").agg(F.count("*").alias("n"), F.sum("n_grams").alias("grams"))
    count = F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("int")
    members = members.join(sums.select("component", count.alias("blocks")), "component")
    members = cut_lineage(members.withColumn(
        "block", F.pmod(F.xxhash64("grams_hash"), F.col("blocks").cast("long")).cast("int")))
    wanted = members.select("row_hash", "component", "block", "blocks", "grams_hash", "copies")
    bytes_ = 128 * members.count()
    texts = join_cell_table(docs.select("row_hash", "text"), wanted, "row_hash", "inner", bytes_)
    # A repeated row is as many texts of one hash; its class enters its block once, as ``copies``.
    sets = _sets_of(texts, size).dropDuplicates(["grams_hash"])
    paired = with_block_pairs(sets, "blocks", "block").select(
        "component", "low", "high", "block", "grams_hash", "copies", "grams", "blocks"
    )
    paired = paired.repartition("component", "low", "high").sortWithinPartitions("component", "low", "high")
    checked = cut_lineage(
        paired.drop("blocks").mapInArrow(_verified(share), "grams_hash binary, n_links bigint, tied_to binary")
    )
    links = checked.groupBy("grams_hash").agg(F.sum("n_links").alias("n_links"))
    ends = connected_components(checked.select(F.col("grams_hash").alias("a"), F.col("tied_to").alias("b")))

    found = (
        classes.select("grams_hash", "first", "copies")
        .join(links, "grams_hash", "left")
        .join(ends.select(F.col("node").alias("grams_hash"), "component"), "grams_hash", "left")
        .withColumn("component", F.coalesce("component", "grams_hash"))
    )
    found = cut_lineage(found)
    least = found.groupBy("component").agg(F.min("first").alias("kept"))
    found = found.join(least, "component").select(
        "grams_hash",
        F.col("first.key").alias("copy_id"),
        F.col("kept.key").alias("class_id"),
        F.col("kept.row_hash").alias("kept_hash"),
        (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    return signed.select("key", "row_hash", "grams_hash").join(found, "grams_hash").select(
        F.col("key").alias(key),
        "row_hash",
        "copy_id",
        "class_id",
        "n_links",
        (F.col("row_hash") == F.col("kept_hash")).alias("kept"),
    )


def _sets_of(texts: DataFrame, size: int) -> DataFrame:
    """The n-gram sets of chosen documents, a row for each repeat of a document."""
    out = T.StructType([
        *[texts.schema[name] for name in ("component", "block", "blocks", "grams_hash", "copies")],
        T.StructField("grams", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents, names = texts_of(batch.column(0)), batch.column(4).to_pylist()
            for begin, end in slices(contents):
                sets = gram_sets(texts_of(contents.slice(begin, end - begin)), size)
                # Another document may have the same hash of key and text.
                right = [k for k, grams in enumerate(sets) if set_hash(grams) == names[begin + k]]
                rows = pa.array([begin + k for k in right], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(rows) for c in range(1, 6)],
                     pa.array([sets[k].tobytes() for k in right], pa.binary())], out.names)

    chosen = texts.select("text", "component", "block", "blocks", "grams_hash", "copies")
    return chosen.mapInArrow(run, out)
