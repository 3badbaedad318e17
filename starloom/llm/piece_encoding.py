"""SentencePiece encoding and decoding by suffix arrays.

The distinct pre-tokens of a block of documents are put in a row and indexed by a suffix
array, sorted as deep as the longest piece. Binary search finds for every piece of the
vocabulary the range of suffixes that begin with it, all pieces at once. Each occurrence is
an edge over the text, from where it begins to where it ends. The edges are sorted by
position and then relaxed: for a unigram model from left to right, keeping the best way to
each position; for a BPE model by score, joining two neighbouring symbols wherever an edge
spans both. Characters that no piece covers fall back to bytes.

A pre-token begins at a space, where the pieces of the supported models begin too.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.batches import add_text_columns, kept_in_worker
from starloom.llm.units import joined, split_at_spaces

SPACE = "▁"
RUNS = re.compile(r" *[^ ]+| +$")
# Longest pre-token that is relaxed together with others; longer ones go one by one.
LOCKSTEP_CHARS = 32
# Characters that are indexed in one go, so that the table of edges stays small.
INDEX_CHARS = 1 << 19
# Bytes of text in a block.
BLOCK_BYTES = 4 << 20


class Vocabulary:
    """Pieces, scores and byte pieces of a model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as model_format

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = model_format.ModelProto()
        proto.ParseFromString(model.serialized_model_proto())
        self._read(proto)

    def _read(self, proto) -> None:
        normal, unused = 1, 5
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models without normalisation are supported")
        self.prefix = spec.add_dummy_prefix
        self.unigram = proto.trainer_spec.model_type == 1
        self.texts = [piece.piece for piece in proto.pieces]
        self.kinds = np.array([piece.type for piece in proto.pieces])
        self.scores = np.array([piece.score for piece in proto.pieces], np.float64)
        if any(SPACE in text.lstrip(SPACE) for text, kind in zip(self.texts, self.kinds, strict=True) if kind == normal):
            raise ValueError("this model has pieces that reach across a space")
        if 4 in self.kinds or unused in self.kinds:
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.normal = np.flatnonzero(self.kinds == normal)
        self.unknown = int(np.flatnonzero(self.kinds == 2)[0])
        self.bytes = np.full(256, -1)
        for number in np.flatnonzero(self.kinds == 6):
            self.bytes[int(self.texts[number][3:5], 16)] = number
        self.falls_back = bool((self.bytes >= 0).all())
        self.lengths = np.array([len(text) for text in self.texts])
        self.longest = int(self.lengths[self.normal].max())
        # Every piece as code points, one row each, the rest zero.
        self.points = np.zeros((len(self.texts), self.longest), np.uint32)
        for number in self.normal:
            self.points[number, : self.lengths[number]] = np.frombuffer(
                self.texts[number].encode("utf-32-le"), np.uint32
            )
        # What a piece decodes to; byte pieces are joined before they are decoded.
        self.surfaces = [
            b"" if kind == 3 else " ⁇ ".encode() if kind == 2 else bytes([int(text[3:5], 16)]) if kind == 6
            else text.replace(SPACE, " ").encode()
            for text, kind in zip(self.texts, self.kinds, strict=True)
        ]


def suffix_array(points: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, int]:
    """Positions in the order of the text that follows them, as far as ``depth`` characters.

    Also the sorted keys (a list of 64-bit words per suffix, several characters in each),
    the alphabet, and the bits of a character.
    """
    alphabet, codes = np.unique(points, return_inverse=True)
    bits = int(len(alphabet) + 1).bit_length()
    each = 64 // bits
    padded = np.zeros(len(points) + depth + each, np.uint64)
    padded[: len(points)] = codes.astype(np.uint64) + np.uint64(1)
    keys = []
    for begin in range(0, depth, each):
        key = np.zeros(len(points), np.uint64)
        for k in range(begin, begin + each):
            key <<= np.uint64(bits)
            if k < depth:
                key |= padded[k : k + len(points)]
        keys.append(key)
    order = np.lexsort(keys[::-1])
    return order, [key[order] for key in keys], alphabet, bits


def occurrence_ranges(
    vocabulary: Vocabulary, keys: list[np.ndarray], alphabet: np.ndarray, bits: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the pieces that can occur, and the range of suffixes that begin with each."""
    depth, each = vocabulary.longest, 64 // bits
    points, sizes = vocabulary.points[vocabulary.normal], vocabulary.lengths[vocabulary.normal]
    at = np.minimum(np.searchsorted(alphabet, points), len(alphabet) - 1)
    used = np.arange(depth) < sizes[:, None]
    present = ((alphabet[at] == points) | ~used).all(1)
    at, used, numbers = at[present], used[present], vocabulary.normal[present]
    ends = []
    for filler in (0, (1 << bits) - 1):
        codes = np.where(used, at + 1, filler).astype(np.uint64)
        wanted = []
        for begin in range(0, depth, each):
            word = np.zeros(len(codes), np.uint64)
            for k in range(begin, begin + each):
                word <<= np.uint64(bits)
                if k < depth:
                    word |= codes[:, k]
            wanted.append(word)
        low, high = np.zeros(len(codes), np.int64), np.full(len(codes), len(keys[0]))
        while (open_ := low < high).any():
            middle = np.minimum((low + high) // 2, len(keys[0]) - 1)
            before, tied = np.zeros(len(codes), bool), np.ones(len(codes), bool)
            for key, word in zip(keys, wanted, strict=True):
                own = key[middle]
                before |= tied & (own < word)
                tied &= own == word
            # Upper ends: a suffix equal to the filled-up key still begins with the piece.
            before |= tied & (filler > 0)
            low = np.where(open_ & before, middle + 1, low)
            high = np.where(open_ & ~before, middle, high)
        ends.append(low)
    return numbers, ends[0], ends[1]


def edges_by_position(vocabulary: Vocabulary, points: np.ndarray, unit_ends: np.ndarray) -> np.ndarray:
    """``table[i, n - 1]``: the piece of n characters that begins at position i, or -1.

    Every occurrence is put at its position, which sorts the edges; those that reach out
    of their pre-token are left out.
    """
    order, keys, alphabet, bits = suffix_array(points, vocabulary.longest)
    numbers, first, last = occurrence_ranges(vocabulary, keys, alphabet, bits)
    starts = np.concatenate([[0], np.cumsum(last - first)])
    ranks = np.arange(starts[-1]) + np.repeat(first - starts[:-1], last - first)
    positions, pieces = order[ranks], np.repeat(numbers, last - first)
    sizes = vocabulary.lengths[pieces]
    own_end = np.repeat(unit_ends, np.diff(np.concatenate([[0], unit_ends])))
    inside = positions + sizes <= own_end[positions]
    table = np.full((len(points), vocabulary.longest), -1, np.int32)
    table[positions[inside], sizes[inside] - 1] = pieces[inside]
    return table


def relax_left_to_right(vocabulary: Vocabulary, table: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Unigram: for every position the size of the piece that begins there on the best way, or 0.

    All pre-tokens advance together, a character a step. A character without a piece of
    its own is passed at a score below all others, as the library does.
    """
    n, depth = len(table), vocabulary.longest
    least = vocabulary.scores[vocabulary.normal].min() - 10.0
    sizes = np.diff(starts)
    order = np.argsort(-sizes, kind="stable")
    best, back = np.full(n + len(sizes), -np.inf), np.zeros(n + len(sizes), np.int32)
    base = starts[:-1] + np.arange(len(sizes))  # each pre-token has one more place than characters
    best[base] = 0.0
    for step in range(1, int(sizes.max(initial=0)) + 1):
        active = order[: np.searchsorted(-sizes[order], -step, "right")]
        place, end = base[active] + step, starts[active] + step
        for size in range(min(step, depth), 0, -1):  # of equals, the longest last piece
            piece = table[end - size, size - 1]
            worth = np.where(piece >= 0, vocabulary.scores[piece], least if size == 1 else -np.inf)
            worth = best[place - size] + worth
            better = worth > best[place]
            best[place[better]] = worth[better]
            back[place[better]] = size
    chosen = np.zeros(n, np.int32)
    at = sizes.copy()
    while (active := np.flatnonzero(at > 0)).size:
        size = back[base[active] + at[active]]
        at[active] -= size
        chosen[starts[active] + at[active]] = size
    return chosen


def relax_by_score(vocabulary: Vocabulary, table: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """BPE: for every position the size of the symbol that begins there at the end, or 0.

    In every pre-token the best edge that spans two neighbouring symbols joins them, the
    leftmost of equals, until none is left. Pre-tokens of similar length advance together.
    """
    chosen = np.zeros(len(table), np.int32)
    sizes = np.diff(starts)
    for low, high in ((0, 8), (8, 16), (16, LOCKSTEP_CHARS)):
        units = np.flatnonzero((sizes > low) & (sizes <= high))
        if len(units):
            _join_in_lockstep(vocabulary, table, starts[units], sizes[units], chosen)
    for unit in np.flatnonzero(sizes > LOCKSTEP_CHARS):
        _join_one(vocabulary, table, int(starts[unit]), int(sizes[unit]), chosen)
    return chosen


def _join_in_lockstep(
    vocabulary: Vocabulary, table: np.ndarray, first: np.ndarray, sizes: np.ndarray, chosen: np.ndarray
) -> None:
    width, depth = int(sizes.max()), vocabulary.longest
    # Borders of the symbols of every pre-token, the rest of the row at its end.
    borders = np.minimum(np.arange(width + 2), sizes[:, None]).astype(np.int32)

    def worth(rows: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        span = right - left
        fits = (span > 1) & (span <= depth)
        piece = np.where(fits, table[np.where(fits, first[rows] + left, 0), np.where(fits, span - 1, 0)], -1)
        return np.where(piece >= 0, vocabulary.scores[piece], -np.inf)

    everyone = np.arange(len(sizes))
    scores = np.stack([worth(everyone, borders[:, k], borders[:, k + 2]) for k in range(width)], 1)
    # A last symbol has no right neighbour: its span would be its own size.
    scores[borders[:, 1:-1] >= sizes[:, None]] = -np.inf
    live = everyone
    while len(live):
        at = scores[live].argmax(1)
        found = scores[live, at] > -np.inf
        live, at = live[found], at[found]
        if not len(live):
            break
        shift = np.arange(width + 2) + (np.arange(width + 2) > at[:, None])
        own = np.take_along_axis(borders[live], np.minimum(shift, width + 1), 1)
        borders[live] = own
        moved = np.take_along_axis(scores[live], np.minimum(shift[:, :width], width - 1), 1)
        moved[:, -1] = -np.inf
        for step in (-1, 0):
            k = at + step
            ok = np.flatnonzero(k >= 0)
            left, inner, right = own[ok, k[ok]], own[ok, k[ok] + 1], own[ok, np.minimum(k[ok] + 2, width + 1)]
            value = worth(live[ok], left, right)
            moved[ok, k[ok]] = np.where(inner < sizes[live[ok]], value, -np.inf)
        scores[live] = moved
    begins = first[:, None] + borders[:, :-1]
    spans = np.diff(borders, axis=1)
    real = spans > 0
    chosen[begins[real]] = spans[real]


def _join_one(vocabulary: Vocabulary, table: np.ndarray, first: int, size: int, chosen: np.ndarray) -> None:
    """The same for a long pre-token, by a queue of the edges that span two symbols."""
    after = list(range(1, size + 1))  # end of the symbol that begins here
    before = list(range(-1, size - 1))  # begin of the symbol in front
    alive = [True] * size
    queue: list[tuple[float, int, int]] = []

    def offer(left: int) -> None:
        middle = after[left]
        if middle < size and after[middle] - left <= vocabulary.longest:
            piece = table[first + left, after[middle] - left - 1]
            if piece >= 0:
                heapq.heappush(queue, (-vocabulary.scores[piece], left, after[middle]))

    for left in range(size):
        offer(left)
    while queue:
        _, left, end = heapq.heappop(queue)
        if not alive[left] or after[left] >= size or after[after[left]] != end or after[left] == end:
            continue
        middle = after[left]
        alive[middle] = False
        after[left] = end
        if end < size:
            before[end] = left
            offer(left)
        if before[left] >= 0:
            offer(before[left])
    for left in range(size):
        if alive[left]:
            chosen[first + left] = after[left] - left


class PieceCodec:
    """Ids of texts and texts of ids, by a vocabulary."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        sizes = np.array([len(surface) for surface in vocabulary.surfaces], np.int64)
        self.surface_starts = np.concatenate([[0], np.cumsum(sizes)])
        self.surface_bytes = np.frombuffer(b"".join(vocabulary.surfaces), np.uint8)

    def segment(self, points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens, given as code points in a row, and where each begins."""
        ends = np.cumsum(sizes)
        lists, counts, begin = [], [], 0
        while begin < len(sizes):
            first = ends[begin] - sizes[begin]
            end = max(begin + 1, int(np.searchsorted(ends, first + INDEX_CHARS, "right")))
            ids, starts = self._segment(points[first : ends[end - 1]], ends[begin:end] - first)
            lists.append(ids)
            counts.append(np.diff(starts))
            begin = end
        starts = np.concatenate([[0], np.cumsum(np.concatenate([*counts, np.zeros(0, np.int64)]))])
        return np.concatenate([*lists, np.zeros(0, np.int64)]), starts

    def _segment(self, points: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        vocabulary = self.vocabulary
        starts = np.concatenate([[0], ends])
        table = edges_by_position(vocabulary, points, ends)
        relax = relax_left_to_right if vocabulary.unigram else relax_by_score
        sizes = relax(vocabulary, table, starts)
        begins = np.flatnonzero(sizes)
        pieces = table[begins, sizes[begins] - 1].astype(np.int64)
        first = np.searchsorted(begins, starts)
        missing = np.flatnonzero(pieces < 0)
        if not len(missing):
            return pieces, first
        # A character without a piece becomes its bytes, or the unknown piece.
        spelled = []
        for point in points[begins[missing]].tolist():
            raw = chr(point).encode("utf-8", "replace")
            spelled.append(vocabulary.bytes[list(raw)] if vocabulary.falls_back else np.array([vocabulary.unknown]))
        count = np.ones(len(pieces), np.int64)
        count[missing] = [len(ids) for ids in spelled]
        out_starts = np.concatenate([[0], np.cumsum(count)])
        out = np.zeros(out_starts[-1], np.int64)
        plain = np.flatnonzero(pieces >= 0)
        out[out_starts[plain]] = pieces[plain]
        for at, ids in zip(out_starts[missing], spelled, strict=True):
            out[at : at + len(ids)] = ids
        return out, out_starts[first]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text begins (with the end at last)."""
        if not self.vocabulary.prefix:
            raise ValueError("only models that put a space in front are supported")
        texts = pc.replace_substring(texts, SPACE, " ")  # the model takes the mark for a space
        irregular = np.asarray(pc.match_substring_regex(texts, "^$|^ | $|  ").to_numpy(zero_copy_only=False))
        regular = np.flatnonzero(~irregular)
        units = split_at_spaces(texts.take(pa.array(regular)))
        words, codes = units.words, units.codes
        sizes = np.zeros(len(texts), np.int64)
        sizes[regular] = np.diff(units.starts)
        # Pre-tokens of texts with several spaces in a row are cut one text at a time.
        extra: dict[str, int] = {}
        parts, last = [], 0
        for row in np.flatnonzero(irregular):
            upto = units.starts[np.searchsorted(regular, row)]
            text = texts[int(row)].as_py()
            runs = [run.replace(" ", SPACE) for run in RUNS.findall(" " + text)] if text else []
            numbers = [len(words) + extra.setdefault(run, len(extra)) for run in runs]
            parts += [codes[last:upto], np.array(numbers, np.int64)]
            last, sizes[row] = upto, len(runs)
        codes = np.concatenate([*parts, codes[last:]])
        line = ""
        if len(words):
            whole = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
            line = SPACE + pc.binary_join(whole, SPACE)[0].as_py()
        points = np.frombuffer((line + "".join(extra)).encode("utf-32-le"), np.uint32)
        lengths = np.concatenate([np.asarray(pc.utf8_length(words), np.int64) + 1, [len(run) for run in extra]])
        values, starts = self.segment(points, lengths.astype(np.int64))
        ids, ends = joined(values, starts, codes)
        return ids, ends[np.concatenate([[0], np.cumsum(sizes)])]

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> pa.Array:
        """Texts of ids; bytes that are no UTF-8 become replacement characters."""
        content, ends = joined(self.surface_bytes, self.surface_starts, ids)
        bounds = ends[starts]
        # The space that encoding puts in front is left out.
        blank = np.flatnonzero(np.diff(bounds))
        blank = blank[content[bounds[blank]] == 32]
        kept = np.ones(len(content), bool)
        kept[bounds[blank]] = False
        bounds = bounds - np.concatenate([[0], np.cumsum(~kept)])[bounds]
        content = content[kept]
        raw, inner = content.tobytes(), bounds[bounds < len(content)]
        try:
            if ((content[inner] & 0xC0) == 0x80).any():  # a character cut in two
                raise UnicodeDecodeError("utf-8", raw, 0, 1, "a text begins inside a character")
            raw.decode()
            offsets = pa.py_buffer(bounds.astype(np.int64).tobytes())
            buffers = [None, offsets, pa.py_buffer(raw)]
            return pa.Array.from_buffers(pa.large_string(), len(starts) - 1, buffers).cast(pa.string())
        except UnicodeDecodeError:
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            return pa.array(texts, pa.string())


def codec_of(path: str) -> PieceCodec:
    return kept_in_worker(("codec", path), lambda: PieceCodec(Vocabulary(path)))


def encode_pieces(df: DataFrame, model_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of every whole text, as the library gives them for this model, without begin and end.

    A null or empty text has no ids. A column of the name of the new one is replaced, an
    empty table stays empty, and repeated rows are encoded each.
    """

    def make():
        codec = codec_of(model_path)

        def work(texts: pa.Array):
            found, starts = codec.encode(texts)
            return {ids: pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(found, pa.int32()))}

        return work

    return add_text_columns(df, text, f"`{ids}` array<int>", make, BLOCK_BYTES)


def decode_pieces(df: DataFrame, model_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of every array of ids; null and empty arrays give an empty text.

    Ids outside the vocabulary are an error. Columns that the input has are kept, but one
    of the name of the new one is replaced.
    """
    kept = [name for name in df.columns if name != text]
    rows = df.select(F.col(f"`{ids}`").cast("array<int>").alias("ids"), F.struct(*[F.col(f"`{name}`") for name in kept]).alias("row"))
    out = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("_new", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model_path)
        for batch in batches:
            lists = pa.concat_arrays([batch.column(0)])
            numbers = np.asarray(lists.flatten(), np.int64)
            starts = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists).fill_null(0), np.int64))])
            yield pa.RecordBatch.from_arrays([batch.column(1), codec.decode(numbers, starts)], out.names)

    done = rows.mapInArrow(run, out)
    return done.select(*[F.col(f"row.`{name}`").alias(name) for name in kept], F.col("_new").alias(text))


def check_pieces(df: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """Add what encoding and decoding give, without keeping the ids: ``n_pieces, ids_crc32, round_trip``.

    The checksum is that of the ids as little-endian unsigned 32-bit numbers. The round
    trip holds if the decoded text is the text; the mark for spaces, written out in a
    text, is the one thing that does not come back.
    """

    def make():
        codec = codec_of(model_path)

        def work(texts: pa.Array):
            found, starts = codec.encode(texts)
            raw = found.astype("<u4")
            sums = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(starts[:-1], starts[1:], strict=True)]
            return {
                "n_pieces": np.diff(starts),
                "ids_crc32": np.array(sums, np.int64),
                "round_trip": pc.equal(codec.decode(found, starts), texts),
            }

        return work

    return add_text_columns(df, text, "n_pieces bigint, ids_crc32 bigint, round_trip boolean", make, BLOCK_BYTES)
