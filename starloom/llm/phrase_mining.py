"""Phrase collocation mining with an FM-index per shard of the texts.

A shard is some 6 MB of text. Its words are numbered, its pieces are laid in a row with
barriers between them, and the interval extension of the index lists the phrases in it
with their counts, which are summed over the shards. A phrase can only be frequent if all of its parts
are, so words that are rare in the whole language become barriers, and only phrases made
of frequent pairs grow beyond two words.

Most phrases are rare, so their words do not travel: the shards send packed hashes with counts first, and
then the words of those phrases alone whose hash is frequent. What is frequent goes to the shards as a
bit table of bounded size. Hashes that meet and tables that fill up let rare phrases through to the exact
sums, and lose none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.fm_index import Phrases, WordIndex, last_column
from starloom.llm.words import BASE, BYTE_VALUES, Stretches, mixed
from starloom.session import cut_lineage

# Most words of a phrase.
DEPTH = 4
SHARD_BYTES = 6 << 20
# Rows that a task hands on at a time.
ROWS = 1 << 16
# A bit for each frequent phrase, times this, and at most so many bits (16 MB).
BITS_EACH, MOST_BITS = 64, 1 << 27
# Hashes that a task packs at a time, and words for each of the buckets they are dealt to.
PACKED, BUCKET_WORDS, LEAST_BUCKETS = 1 << 21, 1 << 22, 64
UNKNOWN = "und"

BARRIER = re.compile(rb"[.,;:!?\x0a-\x0d]")
BARRIER_BYTES = b".,;:!?\x0a\x0b\x0c\x0d"
COUNTED = "lang string, phrase string, f bigint"


def _lowered() -> tuple[np.ndarray, np.ndarray]:
    """Lower case of every byte, and what it is: 0 part of a word, 1 between words, 2 between pieces."""
    lower, kind = np.arange(256, dtype=np.uint8), np.zeros(256, np.uint8)
    lower[65:91] += 32
    kind[[0x20, 0x09]] = 1
    kind[list(BARRIER_BYTES)] = 2
    return lower, kind


LOWER, KIND = _lowered()


@dataclass
class Shard:
    """Numbered words: ``text`` holds 0 for a barrier and 1 + the place in ``words`` and ``langs``."""

    text: np.ndarray
    words: pa.Array
    langs: pa.Array

    def hashes(self) -> np.ndarray:
        """64 bits for every number, by word and language; 0 for the barrier."""
        return np.append(np.zeros(1, np.uint64), mixed(_hash_texts(self.words) * np.uint64(BASE) + _hash_texts(self.langs)))


def _hash_texts(texts: pa.Array) -> np.ndarray:
    if not len(texts):
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64)
    content = np.frombuffer(texts.buffers()[2], np.uint8)[: offsets[-1]] if offsets[-1] else np.zeros(0, np.uint8)
    return Stretches(BYTE_VALUES[content]).hashes(offsets[:-1], offsets[1:])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """Language and bytes of every text; one above the size of a shard comes in parts, cut between pieces."""
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            content = text.as_buffer().to_pybytes() if text.is_valid else b""
            while len(content) > SHARD_BYTES:
                found = max(content.rfind(bytes([b]), 0, SHARD_BYTES) for b in BARRIER_BYTES)
                if found < 0:  # a piece that is longer
                    at = BARRIER.search(content, SHARD_BYTES)
                    found = at.start() if at else len(content) - 1
                yield lang, content[: found + 1]
                content = content[found + 1 :]
            yield lang, content


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    """Texts ``lang, text`` in shards of bounded size."""
    held, size = [], 0
    for part in _parts(batches):
        if held and size + len(part[1]) > SHARD_BYTES:
            yield read_shard(held)
            held, size = [], 0
        held.append(part)
        size += len(part[1])
    if held:
        yield read_shard(held)


def read_shard(parts: list[tuple[str, bytes]]) -> Shard:
    names = pa.array([lang for lang, _ in parts], pa.string()).dictionary_encode()
    content = LOWER[np.frombuffer(b"\n".join(text for _, text in parts) + b"\n", np.uint8)]
    ends_of_parts = np.cumsum([len(text) + 1 for _, text in parts])
    kind = KIND[content]
    inside = np.concatenate([[False], kind == 0, [False]])
    change = np.flatnonzero(inside[1:] != inside[:-1])
    begins, ends = change[0::2], change[1::2]
    if not len(begins):
        return Shard(np.zeros(1, np.int64), pa.array([], pa.string()), pa.array([], pa.string()))
    offsets = np.concatenate([[0], np.cumsum(ends - begins)]).astype(np.int32)
    kept = content[kind == 0]
    listed = pa.StringArray.from_buffers(len(begins), pa.py_buffer(offsets), pa.py_buffer(kept)).dictionary_encode()
    lang = np.asarray(names.indices, np.int64)[np.searchsorted(ends_of_parts, begins, "right")]
    pair = np.asarray(listed.indices, np.int64) * len(names.dictionary) + lang
    known = np.flatnonzero(np.bincount(pair))
    number = np.zeros(int(known[-1]) + 1, np.int64)
    number[known] = np.arange(len(known)) + 1
    # A barrier before every word that has one between it and the word before.
    walls = np.concatenate([[0], np.cumsum(kind == 2)])[begins]
    apart = np.flatnonzero(np.diff(walls, prepend=-1))
    text = np.insert(number[pair], apart, 0)
    word, tongue = np.divmod(known, len(names.dictionary))
    return Shard(text, listed.dictionary.take(word), names.dictionary.take(tongue))


def _joined(words: pa.Array, phrases: np.ndarray) -> pa.Array:
    """Phrases of numbers as words with a space between them."""
    columns = [words.take(pa.array(phrases[:, k] - 1)) for k in range(phrases.shape[1])]
    return pc.binary_join_element_wise(*columns, " ") if len(columns) > 1 else columns[0]


def _rows(words: pa.Array, langs: pa.Array, found: Phrases) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(found.counts), ROWS):
        phrases, counts = found.words[at : at + ROWS], found.counts[at : at + ROWS]
        columns = [langs.take(pa.array(phrases[:, 0] - 1)), _joined(words, phrases), pa.array(counts.astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "f"])


def _pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mixed(left * np.uint64(BASE) + right)


LOW = np.uint64(0xFFFFFFFF)


def _cut_hash(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of a hash, its first bits, and the 32 bits after them."""
    shift = 64 - buckets.bit_length() + 1
    return hashes >> np.uint64(shift), (hashes >> np.uint64(shift - 32)) & LOW


def _bucket_hash(bucket: int | np.ndarray, low: np.ndarray) -> np.ndarray:
    """One number for a bucket and the low bits of a hash in it."""
    return mixed((np.asarray(bucket, np.uint64) << np.uint64(32)) | low.astype(np.uint64))


def _packed(numbers: np.ndarray) -> bytes:
    """An array of numbers, compressed."""
    raw = numbers.tobytes()
    return len(raw).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(held: pa.Buffer, kind: str | type) -> np.ndarray:
    size = int.from_bytes(held.slice(0, 4).to_pybytes(), "little")
    return np.frombuffer(pa.decompress(held.slice(4), size, codec="zstd"), kind)


def _packed_steps(rising: np.ndarray) -> bytes:
    """Rising numbers by their differences, all first bytes before all second ones."""
    return _packed(np.diff(rising, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.copy())


def _unpacked_steps(held: pa.Buffer) -> np.ndarray:
    return np.cumsum(_unpacked(held, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel(), dtype=np.uint32)


@dataclass
class Known:
    """A bit for each hash that may belong to a frequent phrase."""

    bits: np.ndarray
    shift: int
    # Of packed hashes only so many buckets and the low bits are known; 0 for whole ones.
    buckets: int = 0

    @property
    def parts(self) -> tuple:
        """What is sent to the executors, which need not have this package."""
        return self.bits, self.shift, self.buckets

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        if self.buckets:
            hashes = _bucket_hash(*_cut_hash(hashes, self.buckets))
        at = hashes >> np.uint64(self.shift)
        return (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def _hashed(words: DataFrame) -> DataFrame:
    """The hash ``h`` of every word ``lang, phrase``, as the shards compute it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = Shard(np.zeros(0, np.int64), batch.column(1), batch.column(0)).hashes()[1:]
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], ["h"])

    return words.select("lang", "phrase").mapInArrow(run, "h bigint")


def known_hashes(hashed: DataFrame, buckets: int = 0) -> Known:
    """The bit table of hashes ``h``, put together by Spark; the driver gets at most 16 MB."""
    n = hashed.count()
    bits = min(MOST_BITS, max(64, 1 << (n * BITS_EACH - 1).bit_length()))
    shift = 64 - bits.bit_length() + 1
    slot = F.shiftrightunsigned(F.shiftrightunsigned("h", shift), 6)
    one = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {shift}) & 63 as int))")
    table = np.zeros(bits // 64, np.uint64)
    words = hashed.groupBy(slot.alias("slot")).agg(F.bit_or(one).alias("bits")).toArrow()
    if words.num_rows:
        table[words["slot"].to_numpy()] = words["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return Known(table, shift, buckets)


def _summed(counted: DataFrame, least: int) -> DataFrame:
    """Frequent phrases of the whole table, ``lang, phrase, f``, stored."""
    total = counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return cut_lineage(total.filter(F.col("f") >= least))


def index_shards(docs: DataFrame, words: Known) -> DataFrame:
    """One row per shard: its frequent words and both transforms, stored for the searches to come."""
    sent = docs.sparkSession.sparkContext.broadcast(words.parts)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = Known(*sent.value)
        for shard in shards(batches):
            kept = common(shard.hashes())
            kept[0] = False
            number = np.where(kept, np.cumsum(kept), 0).astype(np.int32)
            text = number[shard.text]
            # Barriers in a row are one, and a word between two of them is in no phrase.
            text = np.concatenate([[0], text, [0]]).astype(np.int32)
            lone = (text[1:-1] > 0) & (text[:-2] == 0) & (text[2:] == 0)
            text[1:-1][lone] = 0
            text = text[np.append(True, (text[1:] > 0) | (text[:-1] > 0))]
            which = pa.array(np.flatnonzero(kept) - 1)
            width = np.dtype(np.uint16 if len(which) < 1 << 16 else np.uint32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard.words.take(which).to_pylist()], pa.list_(pa.string())),
                    pa.array([shard.langs.take(which).to_pylist()], pa.list_(pa.string())),
                    pa.array([_packed(last_column(text, DEPTH - 1).astype(width))], pa.binary()),
                    pa.array([_packed(last_column(text[::-1], DEPTH - 1).astype(width))], pa.binary()),
                    pa.array([width.itemsize], pa.int32()),
                ],
                ["words", "langs", "forward", "backward", "width"],
            )

    kinds = "words array<string>, langs array<string>, forward binary, backward binary, width int"
    return cut_lineage(docs.mapInArrow(build, kinds))


def count_words(docs: DataFrame) -> DataFrame:
    """How often each word occurs in each shard: ``lang, phrase, f``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches):
            found = Phrases(np.arange(1, len(shard.words) + 1)[:, None], None, None, np.bincount(shard.text)[1:])
            yield from _rows(shard.words, shard.langs, found)

    return docs.mapInArrow(count, COUNTED)


def _grown(batches: Iterator[pa.RecordBatch], pairs: Known | None, longer: bool) -> Iterator[tuple]:
    """The phrases of each index, ``words, langs, phrases, hashes``.

    These are its pairs of words, the likely ones if those are known, and, if asked for, what grows of them: triples,
    to the right by a word, and from those phrases of four, to the left by another.
    """
    for batch in batches:
        for row in range(batch.num_rows):
            words, langs = (batch.column(k)[row].values for k in (0, 1))
            width = f"u{batch.column(4)[row].as_py()}"
            forward, backward = (_unpacked(batch.column(k)[row].as_buffer(), width) for k in (2, 3))
            index = WordIndex(forward, backward)
            hashes = Shard(forward, words, langs).hashes()

            def hashed(found: Phrases, first: int = 0, last: int | None = None) -> np.ndarray:
                columns = found.words[:, first:last].T  # noqa: B023
                out = hashes[columns[0]]  # noqa: B023
                for column in columns[1:]:
                    out = _pair_hash(out, hashes[column])  # noqa: B023
                return out

            found = index.extend_right(index.single_words())
            marks = hashed(found)
            if pairs is not None:
                likely = pairs(marks)
                found, marks = found[likely], marks[likely]
            yield words, langs, found, marks
            if longer:
                found = index.extend_right(found)
                found = found[pairs(hashed(found, 1))]
                yield words, langs, found, hashed(found)
                found = index.extend_left(found)
                found = found[pairs(hashed(found, 0, 2))]
                yield words, langs, found, hashed(found)


def likely_phrases(indexes: DataFrame, least: int, buckets: int, pairs: Known | None = None) -> DataFrame:
    """Hashes ``h`` of phrases that may occur ``least`` times: of pairs, or, with those known, of longer phrases.

    A task packs the hashes of its shards by bucket; a bucket's hashes are summed together.
    """
    sent = indexes.sparkSession.sparkContext.broadcast(pairs.parts if pairs else None)

    def summed(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        keys, place = np.unique(np.concatenate(hashes), return_inverse=True)
        return keys, np.bincount(place, np.concatenate(counts), len(keys)).astype(np.int64)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(*sent.value) if sent.value else None
        held, counts, size = [], [], 0

        def packed() -> pa.RecordBatch:
            keys, n = summed(held, counts)
            bucket, below = _cut_hash(keys, buckets)
            bucket, below, few = bucket.astype(np.int64), below.astype(np.uint32), np.minimum(n, 1 << 31).astype(np.uint32)
            starts = np.flatnonzero(np.diff(bucket, prepend=-1))
            parts = list(zip(starts, np.append(starts[1:], len(keys)), strict=True))
            columns = [[_packed_steps(below[b:e]) for b, e in parts], [_packed(few[b:e]) for b, e in parts]]
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket[starts]), *[pa.array(c, pa.binary()) for c in columns]], ["bucket", "hashes", "counts"]
            )

        for at, (_, _, found, marks) in enumerate(_grown(batches, known, known is not None)):
            if known is not None and at % 3 == 0:  # the pairs themselves
                continue
            held.append(marks)
            counts.append(found.counts)
            size += len(marks)
            if size >= PACKED:
                yield packed()
                held, counts, size = [], [], 0
        if size:
            yield packed()

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, counts, size = None, [], [], 0

        def frequent() -> pa.RecordBatch:
            keys, n = summed(held, counts)
            return pa.RecordBatch.from_arrays([pa.array(_bucket_hash(here, keys[n >= least]).view(np.int64))], ["h"])

        for batch in batches:
            for bucket, hashes, few in zip(*batch.columns, strict=True):
                if bucket.as_py() != here and held:
                    yield frequent()
                    held, counts, size = [], [], 0
                here = bucket.as_py()
                held.append(_unpacked_steps(hashes.as_buffer()))
                counts.append(_unpacked(few.as_buffer(), np.uint32))
                size += len(held[-1])
                if size >= PACKED:  # what has met so far is summed
                    keys, n = summed(held, counts)
                    held, counts, size = [keys], [n], 0
        if held:
            yield frequent()

    dealt = indexes.mapInArrow(pack, "bucket long, hashes binary, counts binary")
    return cut_lineage(dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(unpack, "h bigint"))


def count_phrases(indexes: DataFrame, pairs: Known, longer: Known) -> DataFrame:
    """The likely phrases of each index with their words: ``lang, phrase, f``."""
    sent = indexes.sparkSession.sparkContext.broadcast((pairs.parts, longer.parts))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, wanted = (Known(*parts) for parts in sent.value)
        for at, (words, langs, found, marks) in enumerate(_grown(batches, known, True)):
            yield from _rows(words, langs, found[wanted(marks)] if at % 3 else found)

    return indexes.mapInArrow(count, COUNTED)


def _part(phrase: Column, first: Column | int, size: Column | int) -> Column:
    """``size`` words of a phrase from the ``first`` one on, counted from 0."""
    return F.array_join(F.slice(F.split(phrase, " "), F.lit(first) + 1, size), " ")


def mine_phrases(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = 30,
    top: int | None = 2000,
    scale: int = 2_000_000,
    covered: tuple[int, int] = (80, 100),
) -> DataFrame:
    """Phrases of two to four words that hold together: ``lang, rank, phrase, a, l, r, n, score``.

    Per language (null: ``und``), over all its texts (null: empty): ``n`` words in all, ``a`` occurrences of
    the phrase, at least ``least``. It is cut into a first part with ``l`` and a rest with
    ``r`` occurrences where ``scale * a / (l + r)``, rounded down, is least (on a tie after the fewest words).
    A phrase goes if a longer one that holds it has at least ``covered`` of its occurrences. The ``top``
    phrases of a language by score, occurrences and bytes stay; all with ``None``. Repeated rows count as often as they
    occur, other columns play no part, an empty table gives no rows.
    """
    narrow = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    # Rare words are only summed: what they add to the words in all, per language.
    words = count_words(narrow).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    common = F.col("f") >= least
    words = words.groupBy("lang", F.when(common, F.col("phrase")).alias("phrase")).agg(F.sum("f").alias("f"))
    words = cut_lineage(words)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    common = words.filter(F.col("phrase").isNotNull())
    indexes = index_shards(narrow, known_hashes(_hashed(common)))
    n_words = totals.agg(F.sum("n")).first()[0] or 0
    buckets = max(LEAST_BUCKETS, 1 << (n_words // BUCKET_WORDS).bit_length())
    pairs = known_hashes(likely_phrases(indexes, least, buckets), buckets)
    longer = known_hashes(likely_phrases(indexes, least, buckets, pairs), buckets)
    phrases = _summed(count_phrases(indexes, pairs, longer), least)

    found = phrases.withColumnRenamed("f", "a").withColumn("size", F.size(F.split("phrase", " ")))
    # A longer phrase takes the place of a shorter one only if one with a single word more does.
    ends = F.array(_part(F.col("phrase"), 0, F.col("size") - 1), _part(F.col("phrase"), 1, F.col("size") - 1))
    grown = found.filter("size > 2").select("lang", F.explode(ends).alias("phrase"), "a")
    grown = grown.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    share, of = covered
    wide = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("decimal(20,0)")
    own = found.join(grown, ["lang", "phrase"], "left")
    own = own.filter(F.col("longer").isNull() | (wide("longer") * of < wide("a") * share)).drop("longer")

    counts = common.unionByName(phrases)
    cut = own.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cut = cut.withColumns(
        {
            "first": _part(F.col("phrase"), 0, F.col("k")),
            "rest": _part(F.col("phrase"), F.col("k"), F.col("size") - F.col("k")),
        }
    )
    for part, name in (("first", "l"), ("rest", "r")):
        known = counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
        cut = cut.join(known, ["lang", part])
    cut = cut.withColumn(
        "score",
        F.expr(f"(cast(a as decimal(20,0)) * {scale}) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"),
    )
    scored = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("at"))
    scored = scored.select("lang", "phrase", "a", "at.l", "at.r", "at.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
