"""Token counts without token ids: pieces are counted once per distinct pre-token.

The pieces of a SentencePiece model that was trained with whitespace splitting have a
space at their beginning only, so nothing is ever merged across the border between a
character and a following space. A text is therefore cut there, the distinct pre-tokens
of a block of documents are handed to the library once, and their counts are joined to
the pre-token frequencies of each document and summed.

A block of documents sends each of its distinct pre-tokens to a bucket, by its hash and as text, so nothing
can be mistaken for another. A bucket counts the pieces of every distinct pre-token of the corpus once and
sends the counts back to the blocks, where they are joined to the pre-token frequencies of each document. What travels
is packed: a block's pre-tokens in order, numbers by their differences.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.batches import slices, text_bytes, texts_of
from starloom.llm.phrase_mining import _packed, _packed_steps, _unpacked, _unpacked_steps
from starloom.llm.units import split_at_spaces
from starloom.llm.words import hash_stretches
from starloom.session import cut_lineage

# Bytes of text in a block of documents.
BLOCK_BYTES = 8 << 20
# Pre-tokens kept between blocks, and the longest one that is kept.
KEPT_UNITS, KEPT_CHARS = 200_000, 64
# Buckets of pre-tokens for every shuffle partition.
BUCKETS_PER_TASK = 4
SPACE = "▁"
RUNS = re.compile(r" *[^ ]+| +$")


class PieceCounter:
    """Counts of pieces per text, by the model file at ``path``."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.known: dict[str, int] = {}
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        if any(SPACE in piece.lstrip(SPACE) for piece in pieces):
            raise ValueError("this model has pieces that reach across a space")

    def count_units(self, units: list[str]) -> np.ndarray:
        """Pieces of distinct pre-tokens, each given without the first of its spaces."""
        new = [unit for unit in units if unit not in self.known]
        if len(self.known) + len(new) > KEPT_UNITS:
            self.known.clear()
            new = units
        found = dict(zip(new, map(len, self.model.encode(new, num_threads=1)), strict=True)) if new else {}
        if "" in found:
            found[""] = 1  # a lone space
        counts = [found[u] if u in found else self.known[u] for u in units]
        room = KEPT_UNITS - len(self.known)
        self.known.update([(u, n) for u, n in found.items() if len(u) <= KEPT_CHARS][:room])
        return np.array(counts, np.int64)

    def count(self, texts: pa.Array) -> np.ndarray:
        """Pieces of every text. An empty text has none."""
        texts = pc.replace_substring(texts, SPACE, " ")  # the model takes the mark for a space
        totals = np.zeros(len(texts), np.int64)
        irregular = np.asarray(pc.match_substring_regex(texts, "^$|^ | $|  ").to_numpy(zero_copy_only=False))
        plain, odd = np.flatnonzero(~irregular), np.flatnonzero(irregular)
        if len(plain):
            units = split_at_spaces(texts.take(pa.array(plain)))
            owner = np.repeat(np.arange(len(plain)), np.diff(units.starts))
            pairs, frequency = np.unique(owner * len(units.words) + units.codes, return_counts=True)
            counts = self.count_units(units.words.to_pylist())
            weighed = counts[pairs % len(units.words)] * frequency
            totals[plain] = np.bincount(pairs // len(units.words), weighed, len(plain)).astype(np.int64)
        for row in odd:
            if text := texts[row].as_py():
                runs = RUNS.findall(" " + text)
                words, frequency = np.unique(np.array(runs, object), return_counts=True)
                totals[row] = (self.count_units([word[1:] for word in words]) * frequency).sum()
        return totals


def distinct_units(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct pre-tokens of some texts; which one each occurrence is, and whose text it is in."""
    texts = pc.replace_substring(texts, SPACE, " ")
    irregular = np.asarray(pc.match_substring_regex(texts, "^$|^ | $|  ").to_numpy(zero_copy_only=False))
    plain, odd = np.flatnonzero(~irregular), np.flatnonzero(irregular)
    units = split_at_spaces(texts.take(pa.array(plain)))
    runs = [[run[1:] for run in RUNS.findall(" " + text)] if (text := texts[row].as_py()) else [] for row in odd]
    others = pa.array([unit for own in runs for unit in own], pa.string())
    coded = pa.concat_arrays([units.words.cast(pa.string()), others]).dictionary_encode()
    places = np.asarray(coded.indices, np.int64)
    owner = [np.repeat(plain, np.diff(units.starts)), np.repeat(odd, [len(own) for own in runs]).astype(np.int64)]
    codes = np.concatenate([places[: len(units.words)][units.codes], places[len(units.words) :]])
    return coded.dictionary, codes, np.concatenate(owner)


def _pack_words(words: pa.Array) -> bytes:
    """Texts in a row: how long each is, then all their bytes."""
    content, bounds = text_bytes(texts_of(words))
    sizes = _packed(np.diff(bounds).astype(np.uint32))
    return len(sizes).to_bytes(4, "little") + sizes + _packed(content)


def _unpack_words(held: pa.Buffer) -> pa.Array:
    cut = 4 + int.from_bytes(held.slice(0, 4).to_pybytes(), "little")
    sizes, content = _unpacked(held.slice(4, cut - 4), np.uint32), _unpacked(held.slice(cut), np.uint8)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(content))


def count_tokens(df: DataFrame, model_path: str, text: str = "text", n_tokens: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of every whole text, as the library gives it for this model.

    Without begin and end tokens; special strings inside a text are ordinary text. A null
    or empty text has 0 tokens. A column of the name of the new one is replaced, an empty
    table stays empty, and repeated rows are counted each.

    The other columns of a row travel with it to where the counts of its block arrive, a text among them too: without
    ``text`` in the columns asked for (:func:`count_text_tokens`) it stays where it is read.
    """
    return count_text_tokens(df.withColumn("_count_text", F.col(f"`{text}`")), model_path, "_count_text", n_tokens)


def count_text_tokens(df: DataFrame, model_path: str, text: str, n_tokens: str = "n_tokens") -> DataFrame:
    """The columns of ``df`` but ``text``, with the number of tokens of that text."""
    kept = [name for name in df.columns if name not in (text, n_tokens)]
    row = F.struct(*[F.col(f"`{name}`") for name in kept] or [F.lit(0).alias("none")])
    narrow = df.select(F.col(f"`{text}`").cast("string").alias("text"), row.alias("row"))
    buckets = BUCKETS_PER_TASK * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row_kind = T.StructField("row", narrow.schema["row"].dataType)  # none beside pre-tokens and counts
    sent = T.StructType([*T._parse_datatype_string("block bigint, bucket int, held binary").fields, row_kind])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts, rows = texts_of(batch.column(0)), batch.column(1)
            for begin, end in slices(texts, BLOCK_BYTES):
                words, codes, owner = distinct_units(texts_of(texts.slice(begin, end - begin)))
                content, bounds = text_bytes(texts_of(words))
                bucket = (hash_stretches(content, bounds[:-1], bounds[1:]) % np.uint64(buckets)).astype(np.int32)
                order = pc.sort_indices(
                    pa.table({"bucket": bucket, "word": words}), [("bucket", "ascending"), ("word", "ascending")]
                ).to_numpy()
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                bucket, words = bucket[order], words.take(pa.array(order))
                firsts = np.flatnonzero(np.diff(bucket, prepend=-1))
                ends = np.append(firsts, len(bucket))[1:]
                parts = [words.slice(b, e - b) for b, e in zip(firsts, ends, strict=True)]
                pairs, often = np.unique(owner * max(len(words), 1) + rank[codes], return_counts=True)
                own, pairs = np.divmod(pairs, max(len(words), 1))
                starts = np.searchsorted(own, np.arange(end - begin + 1))
                held = [_pack_words(part) for part in parts]
                for b, e in zip(starts, starts[1:], strict=False):
                    steps = _packed_steps(pairs[b:e].astype(np.uint32))
                    held.append(len(steps).to_bytes(4, "little") + steps + _packed(often[b:e].astype(np.uint32)))
                size = len(held)
                no_rows = pa.nulls(len(parts), rows.type)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(size, number)),
                        pa.array(np.concatenate([bucket[firsts], np.full(end - begin, buckets, np.int32)]), pa.int32()),
                        pa.array(held, pa.binary()),
                        pa.concat_arrays([no_rows, rows.slice(begin, end - begin)]),
                    ],
                    ["block", "bucket", "held", "row"],
                )
                number += 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, here, blocks, words = PieceCounter(model_path), None, [], []

        def counted() -> pa.RecordBatch:
            coded = pa.concat_arrays(words).dictionary_encode()
            found = counter.count_units(coded.dictionary.to_pylist()).astype(np.uint32)[np.asarray(coded.indices)]
            cuts = np.cumsum([len(w) for w in words])[:-1]
            packed = [_packed(part) for part in np.split(found, cuts)]
            return pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int64()), pa.array([here] * len(blocks), pa.int32()), pa.array(packed, pa.binary())],
                ["block", "bucket", "held"],
            )

        for batch in batches:
            for block, bucket, held in zip(*batch.columns, strict=True):
                if bucket.as_py() != here and words:
                    yield counted()
                    blocks, words = [], []
                here = bucket.as_py()
                blocks.append(block.as_py())
                words.append(_unpack_words(held.as_buffer()))
        if words:
            yield counted()

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, parts, counts = None, [], None
        for batch in batches:
            totals, places = [], []
            for place, (block, bucket, held) in enumerate(zip(*batch.columns[:3], strict=True)):
                if block.as_py() != here:
                    here, parts, counts = block.as_py(), [], None
                if bucket.as_py() < buckets:
                    parts.append(_unpacked(held.as_buffer(), np.uint32))
                    continue
                if counts is None:
                    counts = np.concatenate([*parts, np.zeros(0, np.uint32)]).astype(np.int64)
                raw = held.as_buffer()
                cut = 4 + int.from_bytes(raw.slice(0, 4).to_pybytes(), "little")
                codes, often = _unpacked_steps(raw.slice(4, cut - 4)), _unpacked(raw.slice(cut), np.uint32)
                totals.append(int((counts[codes] * often).sum()))
                places.append(place)
            rows = batch.column(3).take(pa.array(places, pa.int64()))
            yield pa.RecordBatch.from_arrays([rows, pa.array(totals, pa.int64())], ["row", "n"])

    stored = cut_lineage(narrow.mapInArrow(read, sent))
    asked = stored.filter(F.col("bucket") < buckets).select("block", "bucket", "held")
    answers = asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(count, "block bigint, bucket int, held binary")
    told = answers.withColumn("row", F.lit(None).cast(row_kind.dataType))
    both = told.unionByName(stored.filter(F.col("bucket") == buckets))
    met = both.repartition("block").sortWithinPartitions("block", "bucket")
    done = met.mapInArrow(add_up, T.StructType([row_kind, T.StructField("n", T.LongType())]))
    place = {name: F.col(f"row.`{name}`") for name in kept} | {n_tokens: F.col("n")}
    names = [name for name in df.columns if name in place] + [n_tokens] * (n_tokens not in df.columns)
    return done.select(*[place[name].alias(name) for name in names])
