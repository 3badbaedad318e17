"""Tokenised documents packed into sequences of a fixed length by best fit.

Documents and gaps are sorted by size and matched in supersteps. Each superstep takes
the longest documents that are left and sweeps along the gaps from their length upwards:
every gap takes as many of them as fit, the smallest sufficient gap first, and those that
find none open new sequences. Then the gaps are updated and the next length follows.
Documents of one length are interchangeable, and so are sequences with one gap. A
superstep therefore works on runs (a length and how many documents have it, a gap and
which stretch of sequences has it); their number depends on the sequence length alone,
not on the number of documents. Which document of a run goes to which gap is settled by its
rank among the documents of its length. Spark counts the lengths, ranks the documents and
places them; the rows are shuffled once.
"""

from __future__ import annotations

import base64
import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.batches import WORD_SLICE_BYTES, kept_in_worker, slices, texts_of
from starloom.llm.units import joined, split_at_spaces
from starloom.session import cut_lineage

SEQUENCE_TOKENS = 2048
END_ID = 0
# Rows of one length are ranked in groups of about this many, so that a length that many
# documents have is no group of its own.
RANK_ROWS = 1000
# A space beside white space, or at the end of a text: there a cut at spaces would split
# a run of white space that the tokenizer sees as a whole.
SPACE = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
IRREGULAR = rf"[{SPACE}] | [{SPACE}]|^ | $|<\|endoftext\|>"


class ByteTokenizer:
    """Ids as ``tokenizers`` gives them for ``byte_bpe_50k.json``, from the same vocabulary as ranks.

    The pattern of the tokenizer begins a new pre-token at every single space. So the
    distinct words of a block are encoded once, in a row, and their ids are strung together.
    """

    def __init__(self, ranks_path: str, pattern: str, special: dict[str, int]) -> None:
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.id_bytes = np.zeros(max([*ranks.values(), *special.values()]) + 1, np.int64)
        for piece, number in [*ranks.items(), *((s.encode(), n) for s, n in special.items())]:
            self.id_bytes[number] = len(piece)

    def spaced_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every word after a space, and where each word begins."""
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        line = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")
        ids = self.encoding.encode_to_numpy(" " + line[0].as_py(), disallowed_special=())
        ends = np.cumsum(np.asarray(pc.binary_length(words), np.int64) + 1)
        borders = np.concatenate([[0], np.cumsum(self.id_bytes[ids])])
        return ids, np.searchsorted(borders, np.concatenate([[0], ends]))

    def whole_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every text by itself, and where each begins."""
        lists = [self.encoding.encode_to_numpy(text, allowed_special="all") for text in texts]
        starts = np.concatenate([[0], np.cumsum([len(ids) for ids in lists])]).astype(np.int64)
        return np.concatenate([*lists, np.zeros(0, np.uint32)]), starts

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text begins (with the end at last)."""
        irregular = np.asarray(pc.match_substring_regex(texts, IRREGULAR).to_numpy(zero_copy_only=False))
        regular, odd = np.flatnonzero(~irregular), np.flatnonzero(irregular)
        units = split_at_spaces(texts.take(pa.array(regular)))
        # Codes in the order of the texts; the first unit of a text has no space before it.
        first = np.zeros(len(units.codes) + 1, bool)
        first[units.starts[:-1]] = True
        first = first[:-1]
        spaced = np.zeros(len(units.words), bool)
        spaced[units.codes[~first]] = True
        numbers = np.cumsum(spaced) - 1
        n_spaced = int(spaced.sum())
        ids, starts = self.spaced_ids(units.words.filter(pa.array(spaced)))
        alone = units.words.take(pa.array(units.codes[first])).to_pylist() + texts.take(pa.array(odd)).to_pylist()
        more, more_starts = self.whole_ids(alone)
        values, starts = np.concatenate([ids, more]), np.concatenate([starts[:-1], len(ids) + more_starts])
        codes = numbers[units.codes]
        codes[first] = n_spaced + np.arange(len(regular))
        # An irregular text is a unit of its own, put in at its place.
        places = np.searchsorted(regular, odd)
        codes = np.insert(codes, units.starts[places], n_spaced + len(regular) + np.arange(len(odd)))
        sizes = np.ones(len(texts), np.int64)
        sizes[regular] = np.diff(units.starts)
        found, ends = joined(values, starts, codes)
        return found, ends[np.concatenate([[0], np.cumsum(sizes)])]


def token_pieces(
    df: DataFrame,
    ranks_path: str,
    pattern: str,
    special: dict[str, int],
    sequence_tokens: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """Documents as pieces of at most ``sequence_tokens`` ids: ``key, piece, start, length, ids_crc32``.

    The ids of a document are followed by ``end_id``, so a null or empty text has one.
    Longer documents are cut into full pieces after a first one that holds the remainder.
    """
    kind = df.schema[key].dataType
    out = T.StructType([T.StructField(key, kind), *T._parse_datatype_string(
        "piece int, start bigint, length bigint, ids_crc32 bigint").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = kept_in_worker(
            ("ranks", ranks_path), lambda: ByteTokenizer(ranks_path, pattern, special)
        )
        for batch in batches:
            texts, keys = texts_of(batch.column(1)), batch.column(0)
            for begin, end in slices(texts, WORD_SLICE_BYTES):
                ids, starts = tokenizer.ids(texts_of(texts.slice(begin, end - begin)))
                rows = [[], [], [], [], []]
                for row in range(end - begin):
                    own = np.append(ids[starts[row] : starts[row + 1]], end_id).astype("<u4")
                    cuts = [0, *range(len(own) % sequence_tokens or sequence_tokens, len(own) + 1, sequence_tokens)]
                    for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        for column, value in zip(
                            rows, (begin + row, piece, a, b - a, zlib.crc32(own[a:b].tobytes())), strict=True
                        ):
                            column.append(value)
                at, piece, start, length, crc = rows
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()),
                     *(pa.array(x, pa.int64()) for x in (start, length, crc))], out.names)

    return df.select(F.col(key), F.col(text).cast("string").alias("text")).mapInArrow(run, out)


def best_fit_plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Supersteps on runs; ``(length, first rank, first sequence, documents a sequence, offset)`` and the sequences.

    A record holds from its first rank up to the next record of the same length.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}  # of each gap: stretches (first sequence, how many)
    sizes: list[int] = []  # the gaps in order
    records, sequences = [], 0

    def leave(gap: int, first: int, many: int) -> None:
        if gap and many:
            if gap not in gaps:
                bisect.insort(sizes, gap)
            gaps.setdefault(gap, []).append((first, many))

    for length in sorted(counts, reverse=True):
        left, rank, freed = counts[length], 0, []
        at = bisect.bisect_left(sizes, length)
        while left:
            if at < len(sizes):
                gap = sizes[at]
                first, many = gaps[gap].pop()
            else:
                gap, many = capacity, -(-left // (capacity // length))
                first, sequences = sequences, sequences + many
            each = gap // length
            full = min(many, left // each)
            used = min(full * each + (left - full * each if full < many else 0), left)
            records.append((length, rank, first, each, capacity - gap))
            rest = used - full * each
            freed += [(gap - each * length, first, full), (gap - rest * length, first + full, int(rest > 0))]
            freed.append((gap, first + full + (rest > 0), many - full - (rest > 0)))
            left, rank = left - used, rank + used
            if at < len(sizes) and sizes[at] == gap and not gaps[gap]:
                del gaps[gap], sizes[at]
        for stretch in freed:
            leave(*stretch)
    return records, sequences


def pack_best_fit(
    pieces: DataFrame, capacity: int = SEQUENCE_TOKENS, length: str = "length", tie: tuple[str, ...] = ()
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``.

    No two rows overlap, a sequence has no gap before its last row, and longer rows are
    placed first, each into the smallest gap that is left for it. Rows of one length are
    ranked by a hash of the columns ``tie`` (all columns unless given) and then by those
    columns; equal rows are interchangeable. Columns named as the new ones are replaced. An
    empty table stays empty; a null length or one out of bounds is an error.
    """
    rows = cut_lineage(pieces.drop("sequence_id", "offset"))
    tie = tie or tuple(rows.columns)
    counted = rows.groupBy(F.col(length).cast("int").alias("length")).count().limit(capacity + 2).collect()
    counts = {row["length"]: row["count"] for row in counted}
    if any(size is None or not 0 < size <= capacity for size in counts):
        raise ValueError(f"every length must lie between 1 and {capacity}")
    records, _ = best_fit_plan(counts, capacity)
    # Groups of every length, by the length: an array as long as a sequence, in one literal.
    many = ",".join(str(max(1, counts.get(k, 0) // RANK_ROWS)) for k in range(capacity + 1))
    groups = F.split(F.lit(many), ",").cast("array<bigint>")

    size, group, rank = "_pack_size", "_pack_group", "_pack_rank"
    ties = [F.col(f"`{name}`") for name in tie]
    grouped = rows.withColumn(size, F.col(length).cast("int"))
    grouped = grouped.withColumn(group, F.pmod(F.xxhash64(*ties), F.get(groups, F.col(size))))
    before = Window.partitionBy(size).orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    firsts = grouped.groupBy(size, group).agg(F.count("*").alias("_pack_n")).select(
        size, group, F.coalesce(F.sum("_pack_n").over(before), F.lit(0)).alias("_pack_first")
    )
    within = F.row_number().over(Window.partitionBy(size, group).orderBy(*ties))
    ranked = grouped.withColumn(rank, within - 1).join(firsts, [size, group])
    ranked = ranked.select(*rows.columns, size, (F.col(rank) + F.col("_pack_first")).alias(rank))

    # The plan has a few records per length: its size is bounded by the capacity.
    table = np.array(sorted(records) or [(1, 0, 0, 1, 0)], np.int64)
    out = T.StructType([*rows.schema.fields, *T._parse_datatype_string("sequence_id bigint, offset bigint").fields])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan_size, plan_rank, first, each, offset = table.T
        spans = np.int64(1) << 48
        for batch in batches:
            sizes = np.asarray(batch.column(batch.num_columns - 2), np.int64)
            ranks = np.asarray(batch.column(batch.num_columns - 1), np.int64)
            at = np.searchsorted(plan_size * spans + plan_rank, sizes * spans + ranks, "right") - 1
            turn, nth = np.divmod(ranks - plan_rank[at], each[at])
            placed = [pa.array(first[at] + turn), pa.array(offset[at] + nth * sizes)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *placed], out.names)

    return ranked.mapInArrow(place, out)
