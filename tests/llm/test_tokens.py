"""Counts, ids and pieces against the libraries."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as model_format
from tokenizers import Tokenizer

from starloom.llm import queries
from starloom.llm.packing import ByteTokenizer, token_pieces
from starloom.llm.piece_encoding import (
    PieceCodec,
    Vocabulary,
    check_pieces,
    decode_pieces,
    encode_pieces,
    occurrence_ranges,
    suffix_array,
)
from starloom.llm.token_counts import PieceCounter, count_tokens

from cases import EMPTY, SCHEMA, TEXTS, case_rows

MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def random_texts(n: int, longest: int = 60) -> list[str]:
    rng = random.Random(4)
    letters = "the ing  an\n\t\r.'é#ß%$ 日1<|X  "
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, longest))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    return [text or "" for text in TEXTS] + random_texts(1500)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_counts_are_the_library_s(texts, library):
    got = PieceCounter(MODEL).count(pa.array(texts))
    assert got.tolist() == [len(ids) for ids in library.encode(texts)]


def test_counts_with_few_kept_units(texts, library, monkeypatch):
    monkeypatch.setattr("starloom.llm.token_counts.KEPT_UNITS", 20)
    counter = PieceCounter(MODEL)
    for begin in range(0, 300, 50):
        part = texts[begin : begin + 50]
        assert counter.count(pa.array(part)).tolist() == [len(ids) for ids in library.encode(part)]


def test_pieces_are_the_library_s(texts, library):
    codec = PieceCodec(Vocabulary(MODEL))
    for _ in range(2):  # the second time from what is kept
        ids, starts = codec.encode(pa.array(texts))
        got = [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:], strict=True)]
        assert got == library.encode(texts)
    assert codec.decode(ids, starts).to_pylist() == library.decode(got)


def test_bytes_that_are_no_text(library):
    vocabulary = Vocabulary(MODEL)
    two = [int(vocabulary.bytes[b]) for b in "é".encode()]
    for lists in ([[two[0]], [two[1]]], [two, [two[0], 29871], []]):
        starts = np.concatenate([[0], np.cumsum([len(ids) for ids in lists])])
        got = PieceCodec(vocabulary).decode(np.array(sum(lists, []), np.int64), starts).to_pylist()
        assert got == [library.decode(ids) for ids in lists]


def test_small_blocks_and_long_units(texts, library, monkeypatch):
    monkeypatch.setattr("starloom.llm.piece_encoding.INDEX_CHARS", 200)
    monkeypatch.setattr("starloom.llm.piece_encoding.LOCKSTEP_CHARS", 16)
    ids, starts = PieceCodec(Vocabulary(MODEL)).encode(pa.array(texts[:400]))
    assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:], strict=True)] == library.encode(texts[:400])


def test_occurrences_are_found():
    vocabulary = Vocabulary(MODEL)
    text = "▁the▁thing▁that▁then▁is▁the"
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    order, keys, alphabet, bits = suffix_array(points, vocabulary.longest)
    numbers, first, last = occurrence_ranges(vocabulary, keys, alphabet, bits)
    found = {vocabulary.texts[n]: sorted(order[a:b].tolist()) for n, a, b in zip(numbers, first, last, strict=True) if a < b}
    for piece in {vocabulary.texts[n] for n in vocabulary.normal}:
        places = [k for k in range(len(text)) if text.startswith(piece, k)]
        assert found.get(piece, []) == places


def test_unigram_takes_the_best_way():
    proto = model_format.ModelProto()
    with open(MODEL, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    vocabulary = Vocabulary.__new__(Vocabulary)
    vocabulary._read(proto)
    scores = {vocabulary.texts[n]: vocabulary.scores[n] for n in vocabulary.normal}
    least = min(scores.values()) - 10
    samples = ["hello there", "internationalisation of things", "xyz日 q"] + random_texts(100, 20)
    ids, starts = PieceCodec(vocabulary).encode(pa.array(samples))
    for text, a, b in zip(samples, starts[:-1], starts[1:], strict=True):
        if not text:
            continue
        line = "▁" + text.replace(" ", "▁")
        best = [0.0] + [-np.inf] * len(line)
        for end in range(1, len(line) + 1):
            for begin in range(max(0, end - 16), end):
                worth = scores.get(line[begin:end], least if end - begin == 1 else -np.inf)
                best[end] = max(best[end], best[begin] + worth)
        own, run = 0.0, b""
        for number in ids[a:b].tolist():
            if vocabulary.kinds[number] == 6:
                run += vocabulary.surfaces[number]
                try:
                    run.decode()
                except UnicodeDecodeError:
                    continue
                own, run = own + least, b""
            else:
                own += vocabulary.scores[number]
        assert own == pytest.approx(best[-1])


def test_byte_ids_are_the_library_s(texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer = ByteTokenizer(RANKS, public_tokenizers.PATTERN, {"<|endoftext|>": 50256})
    ids, starts = tokenizer.ids(pa.array(texts))
    got = [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:], strict=True)]
    assert got == [library.encode(text, add_special_tokens=False).ids for text in texts]
    none, starts = tokenizer.ids(pa.array([], pa.string()))
    assert len(none) == 0 and starts.tolist() == [0]


def test_columns_on_awkward_rows(spark, library):
    rows = case_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    counted = count_tokens(df, MODEL, n_tokens="n_words").collect()
    assert counted[0].asDict().keys() == {"doc_id", "text", "source", "row", "n_words"}
    want = Counter((r[0], r[1], len(library.encode(r[1] or ""))) for r in rows)
    assert Counter((r.doc_id, r.text, r.n_words) for r in counted) == want
    encoded = decode_pieces(encode_pieces(df, MODEL, ids="row"), MODEL, "row", "n_words")
    for row in encoded.collect():
        assert row["row"] == library.encode(row.text or "") and row.n_words == library.decode(row["row"])
    for row in check_pieces(df, MODEL).collect():
        ids = np.array(library.encode(row.text or ""), "<u4")
        assert (row.n_pieces, row.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))
        assert row.round_trip == (library.decode(ids.tolist()) == (row.text or ""))


def test_empty_tables(spark):
    none = spark.createDataFrame([], EMPTY)
    assert count_tokens(none, MODEL).count() == encode_pieces(none, MODEL).count() == 0
    assert queries.document_pieces(none).count() == 0


def test_pieces_of_documents(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    df = spark.createDataFrame(case_rows(), SCHEMA).dropDuplicates(["doc_id"])
    got = token_pieces(df, RANKS, public_tokenizers.PATTERN, {"<|endoftext|>": 50256}, 512).collect()
    want = set()
    for row in df.collect():
        ids = np.array(library.encode(row.text or "", add_special_tokens=False).ids + [0], "<u4")
        first = len(ids) % 512 or 512
        cuts = [0, *range(first, len(ids) + 1, 512)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.add((row.doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    assert {tuple(row) for row in got} == want and len(got) == len(want)


def test_counts_join_across_blocks(spark, texts, library, monkeypatch):
    """Small blocks, many buckets, texts of all shapes: each distinct pre-token is counted once for the table."""
    from starloom.llm import token_counts

    monkeypatch.setattr(token_counts, "BLOCK_BYTES", 300)
    rows = [(k, text, k % 3) for k, text in enumerate([*texts[:400], None, "", " ", "a" * 5000, "b  c ", "▁x ▁"])]
    df = spark.createDataFrame([*rows, rows[5], rows[5]], "doc_id long, text string, held int").repartition(6)
    want = Counter((r[0], len(library.encode(r[1] or ""))) for r in [*rows, rows[5], rows[5]])
    got = token_counts.count_text_tokens(df, MODEL, "text")
    assert got.columns == ["doc_id", "held", "n_tokens"]
    assert Counter((r.doc_id, r.n_tokens) for r in got.collect()) == want


def test_distinct_units_cover_the_texts(texts):
    from starloom.llm.token_counts import _pack_words, _unpack_words, distinct_units

    words, codes, owner = distinct_units(pa.array(texts))
    assert len(words) == len(set(words.to_pylist())) and (np.bincount(codes, minlength=len(words)) > 0).all()
    assert _unpack_words(pa.py_buffer(_pack_words(words))).to_pylist() == words.to_pylist()
    assert _unpack_words(pa.py_buffer(_pack_words(words.slice(0, 0)))).to_pylist() == []
    assert set(owner.tolist()) <= set(range(len(texts)))
