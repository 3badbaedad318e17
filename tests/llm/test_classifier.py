"""Held-out accuracy of the quality classifier, and its odd inputs."""

import zlib
from functools import partial
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm import quality_classifier as quality
from starloom.llm import queries, stages

from cases import EMPTY, SCHEMA, case_rows

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.op1_quality_classifier(spark, FOLDER).collect()}
    assert len(got) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    for key, row in got.items():
        assert row.held_out == (zlib.crc32(str(key).encode()) % 4 == 2)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.7)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    held = [(got[r.doc_id].predicted, r.quality) for r in labels if got[r.doc_id].held_out]
    assert len(held) > 50
    assert sum(a == b for a, b in held) / len(held) >= 0.97


def by_hand(text, model):
    """Average of the logits over words, neighbours and n-grams, found one by one."""
    found = [f for family, _ in quality.features(pa.array([text])) for f in family]
    mean = sum(float(model.logits[f]) for f in found) / max(1, len(found))
    return 1 / (1 + np.exp(-mean - model.bias)), len(found)


def test_scores_do_not_depend_on_neighbours():
    rng = np.random.default_rng(1)
    model = quality.Model(rng.normal(0, 5, 1 << quality.BUCKET_BITS).astype(np.float32), 0.3)
    texts = ["", " ", "a", "one two two three", "é ß 日本語", "x" * 300, "\n\nb c\n", "one two two three"]
    got = quality.score(pa.array(texts), model)
    assert got == pytest.approx([by_hand(text, model)[0] for text in texts])
    assert got[3] == got[7]


def test_features_are_words_pairs_and_grams():
    # "ab cd": two words, a pair, and n-grams of "ab " and " cd" with the space between them.
    sizes = [len(family) for family, _ in quality.features(pa.array(["ab cd"]))]
    assert sizes == [2, 1, 2, 0, 0]
    repeated, other = (list(quality.features(pa.array([t])))[1][0] for t in ("x x", "yy yy"))
    assert repeated[0] == other[0]  # a word said twice, whatever the word


def test_without_labels_and_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string, label int")
    model = quality.train_classifier(none)
    rows = spark.createDataFrame(case_rows(), SCHEMA)
    scored = quality.add_quality_score(rows, model, score_name="n_words").collect()
    assert len(scored) == len(case_rows()) and {r.n_words for r in scored} == {0.5}
    assert quality.add_quality_score(spark.createDataFrame([], EMPTY), model).count() == 0
    assert stages.keep_by_score(rows, model).count() == 0


def test_sample_is_bounded(spark):
    labels = spark.createDataFrame([(k, k % 2) for k in range(500)], "doc_id bigint, label int")
    first, again = (sorted(quality.sample_rows(labels, rows=40).collect()) for _ in range(2))
    assert first == again and len(first) == 40
    words = (("good", "fine"), ("bad", "poor"))
    rows = [(k, " ".join(words[k % 2]) + f" w{k}", 1 - k % 2) for k in range(60)] + [(None, "x", 1), (90, None, 1), (91, "y", None)]
    model = quality.train_classifier(spark.createDataFrame(rows, "doc_id bigint, text string, label int"))
    good, bad = quality.score(pa.array(["good fine thing", "bad poor thing"]), model)
    assert good > 0.5 > bad


def test_a_large_text_does_not_displace_the_others(spark):
    words = (("good", "fine"), ("bad", "poor"))
    rows = [(k, " ".join(words[k % 2]) + f" w{k}", 1 - k % 2) for k in range(60)]
    labelled = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    first = quality.sample_rows(labelled, rows=1).first().doc_id
    rows[first] = (first, "long " * 2000, 1)
    labelled = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    model = quality.train_classifier(labelled, most_bytes=4000)
    good, bad = quality.score(pa.array(["good fine thing", "bad poor thing"]), model)
    assert good > 0.5 > bad


def test_labels_of_missing_documents_take_no_place(spark, monkeypatch, tmp_path):
    labels = spark.createDataFrame([(k, k % 2) for k in range(600)], "doc_id bigint, quality int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(60)], "doc_id bigint, text string")
    monkeypatch.setattr(quality, "sample_rows", partial(quality.sample_rows, rows=30))
    monkeypatch.setattr(quality, "train_classifier", lambda labelled: labelled.count())
    assert queries.quality_model(spark, docs, str(tmp_path)) == 30


def test_repeats_of_a_document_count_once(spark):
    """One document that holds nearly all rows: no task gets more than one copy of its text."""
    words = (("good", "fine"), ("bad", "poor"))
    rows = [(k, " ".join(words[k % 2]) + f" w{k}", 1 - k % 2) for k in range(60)]
    once = quality.train_classifier(spark.createDataFrame(rows, "doc_id bigint, text string, label int"))
    many = spark.createDataFrame(rows + [rows[7]] * 3000 + [(7, rows[7][1] + " and longer", 1)], "doc_id bigint, text string, label int")
    again = quality.train_classifier(many, most_bytes=4000)
    assert again.bias == once.bias and (again.logits == once.logits).all()
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (2, 1), (None, 1)], "doc_id bigint, label int")
    assert sorted(map(tuple, quality.sample_rows(labels).collect()), key=str) == [(1, 0), (2, 1), (None, 1)]
